"""Shared pieces of the training-data operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII blank, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL_SHARED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees: spark.checkpoint.dir, or a folder of our own where it is unset and the master is local."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        folder = tempfile.mkdtemp(prefix="pagemill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_SHARED[app] = f"file://{folder}"
    return _LOCAL_SHARED[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and reread it: cuts lineage, survives lost executors, computes once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagemill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote for a table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def attach(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Rows with the columns of a table that has one row for each key, and in `n` how many of the `total` rows hold it.  Keys of
    more than a thousandth of all rows, a thousand at most, go out as a broadcast; all others meet by a shuffle."""
    hot = table.where(F.col("n") * 1000 > total)
    often = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(F.col("n") * 1000 <= total), key, "left")
    return often.unionByName(rest).drop("n")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
