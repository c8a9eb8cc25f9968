"""Tables written once between steps that use them more than once."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir).  Where it is unset and the master is local, one of our own, which
    goes with the process; on a cluster that is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="pagemill-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return f"file://{_LOCAL[app]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and reread: what follows starts from the table, also after an executor is lost."""
    path = f"{shared_dir(df.sparkSession)}/pagemill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
