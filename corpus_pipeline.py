"""The corpus pipeline: language ID, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and
rereads it as the next one's docs, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm.common import materialize
from pagemill.llm.langid import stage_langid
from pagemill.llm.mixing import stage_mix
from pagemill.llm.packing import stage_pack
from pagemill.llm.pii import stage_pii
from pagemill.llm.simhash import stage_dedup

STAGES = [
    ("language_id", stage_langid),
    ("simhash_dedup", stage_dedup),
    ("pii", stage_pii),
    ("mixing", stage_mix),
    ("packing", stage_pack),
]

#: Expectation-maximisation, XXH64 fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
