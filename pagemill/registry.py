"""All queries over the test tables, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plans import artifact_queries, layout_queries, page_queries, record_queries, rewrite_queries, table_queries, text_queries

FLAGSHIP = "document_profile"
_MODULES = (text_queries, table_queries, layout_queries, artifact_queries, page_queries, rewrite_queries, record_queries)


def _widened(query: Callable) -> Callable:
    """The same query with its int columns as bigint: one integer type at the boundary."""

    def run(spark, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select(*[F.col(f"`{c}`").cast("bigint").alias(c) if kind == "int" else F.col(f"`{c}`") for c, kind in df.dtypes])

    return run


def queries() -> dict[str, Callable]:
    return {name: _widened(getattr(m, name)) for m in _MODULES for name in m.NAMES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name in m.NAMES if (sql := getattr(m, f"{name}_sql", None))}
