"""Documents as files: listing, checks, digests and page ranges; and the results written back."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """(doc_id, path, bytes, sha256) of all files of a suffix under a folder or glob.  The digest is the document's id: a file
    that is there twice is one document under two paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path)
    digest = F.sha2("content", 256)
    return files.select(digest.alias("doc_id"), "path", F.col("length").alias("bytes"), digest.alias("sha256"))


def check_path(path: str, suffix: str = ".pdf") -> str:
    """The path, if its suffix fits; whether it is there shows when it is read."""
    if PurePosixPath(path).suffix.lower() != suffix:
        raise ValueError(f"not a {suffix} file: {path}")
    return path


def page_range(count: int, start: int = 1, end: int = 0) -> range:
    """Pages from start to end, both included; end 0 is the last page."""
    if start < 1 or start > count:
        raise ValueError(f"start page {start} is not in 1 to {count}")
    if end and end < start:
        raise ValueError(f"end page {end} comes before start page {start}")
    return range(start, min(end or count, count) + 1)


def select_pages(pages: DataFrame, start: int = 1, end: int = 0, column: str = "page") -> DataFrame:
    """Pages of a range, as a predicate that reaches the scan."""
    out = pages.where(F.col(column) >= start)
    return out.where(F.col(column) <= end) if end else out


def chunks(pages: DataFrame, size: int = 32) -> DataFrame:
    """(doc, chunk, first, last): runs of pages that one conversion takes."""
    chunk = F.floor((F.col("page") - 1) / size)
    return pages.groupBy("doc", chunk.alias("chunk")).agg(F.min("page").alias("first"), F.max("page").alias("last"))


def write_records(df: DataFrame, path: str, *, by: str | None = None) -> None:
    """Records as JSON lines, in a folder a value of `by`; a run that is repeated replaces what it wrote."""
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by else out).json(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Page texts as Parquet, a folder a document."""
    pages.write.mode("overwrite").partitionBy("doc").parquet(path)


def resume(done: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted pages (doc, page) that have no completed state."""
    return wanted.join(done.where("status = 'completed'").select("doc", "page").distinct(), ["doc", "page"], "left_anti")
