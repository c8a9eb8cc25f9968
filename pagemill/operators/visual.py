"""Values that pictures and tagged text propose for table cells: normalised, placed, and trusted or not."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions import text as tx

#: Punctuation that compares as equal.
FOLD = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "′": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "″": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "­": "", "​": ""}


def fold(text: str | None) -> str | None:
    """Key for comparison: compatibility form, punctuation folded, quotes out, case folded, white space collapsed."""
    if text is None:
        return None
    plain = unicodedata.normalize("NFKC", text).translate(str.maketrans(FOLD))
    return " ".join(plain.replace("'", "").replace('"', "").casefold().split())


@F.pandas_udf(T.StringType())
def comparison_key(values: pd.Series) -> pd.Series:
    """`fold` by batch: compatibility forms and case folding have no built-in."""
    return values.map(fold, na_action="ignore")


def is_subsequence(needle: Column, haystack: Column) -> Column:
    """Whether all tokens occur in order: a fold that counts how many have been met."""
    met = F.aggregate(haystack, F.lit(0), lambda at, x: F.when((at < F.size(needle)) & (x == F.get(needle, at)), at + 1).otherwise(at))
    return met == F.size(needle)


def tokens_preserved(needle: Column, haystack: Column) -> Column:
    """A subsequence, or the same text cut differently."""
    return is_subsequence(needle, haystack) | ((F.size(needle) > 0) & (F.array_join(needle, "") == F.array_join(haystack, "")))


def assess(candidates: DataFrame) -> DataFrame:
    """Semantic, resolution and reason of each candidate: (tagged array<string> keys proposed by tagged text, pictures array<string>
    keys of coextensive pictures, existing key of the cell, codes array<string>, paint array<string>, placed boolean)."""
    many = F.size(F.array_distinct("tagged")) > 1
    against = (F.size("tagged") > 0) & (F.size("pictures") > 0) & (F.array_sort(F.array_distinct("tagged")) != F.array_sort(F.array_distinct("pictures")))
    same = F.get("tagged", F.lit(0)) == F.coalesce("existing", F.lit(""))
    sure = F.arrays_overlap("codes", F.array(F.lit("parent_tree_unique"), F.lit("owner_mcid_unique"))) & F.array_contains("codes", "structure_cell") & F.array_contains("paint", "visible") & F.col("placed")
    reason = (
        F.when(many, "conflicting_proposals").when(against, "conflicting_coextensive_picture_proposal").when(F.size("tagged") == 0, "no_usable_actual_text").when(same, "native_value_matches")
        .when(sure, "trusted_tagged_value").when(F.array_contains("paint", "not_visible"), "non_painting_tag").when(F.array_contains("paint", "unknown"), "unknown_paint").otherwise("insufficient_generic_evidence")
    )
    out = candidates.withColumn("reason", reason)
    resolution = F.when(F.startswith("reason", F.lit("conflicting")), "conflict").when(F.col("reason") == "native_value_matches", "already_present").when(F.col("reason") == "trusted_tagged_value", "trusted").otherwise("unresolved")
    return out.withColumn("resolution", resolution).withColumn("semantic", F.when(F.col("resolution").isin("already_present", "trusted"), "informational").otherwise("uncertain"))


def place(candidates: DataFrame, cells: DataFrame, grid: int = 16) -> DataFrame:
    """(page, id, table, record, col) where a candidate's centre lies in one cell only.  Candidates and cells meet by the grid
    square of the centre, so a page is not compared pair by pair."""
    at = lambda x: F.greatest(F.lit(0), F.least(F.lit(grid - 1), F.floor(x * grid).cast("int")))
    r = F.col("rect")
    points = candidates.select("page", "id", r.alias("own"), at(geo.centre_x(r)).alias("gx"), at(geo.centre_y(r)).alias("gy"))
    span = lambda lo, hi: F.sequence(at(lo - 0.002), F.greatest(at(lo - 0.002), at(hi + 0.002)))
    wide = cells.select("page", "table", "record", "col", r.alias("cell"), F.explode(span(r[0], r[2])).alias("gx"), span(r[1], r[3]).alias("ys"))
    wide = wide.select("page", "table", "record", "col", "cell", "gx", F.explode("ys").alias("gy"))
    met = points.join(wide, ["page", "gx", "gy"]).where(geo.contains_centre(F.col("cell"), F.col("own"))).select("page", "id", "table", "record", "col").distinct()
    return met.withColumn("n", F.count("*").over(Window.partitionBy("page", "id"))).where("n = 1").drop("n")


def monotonic(placed: DataFrame) -> DataFrame:
    """(page, table) whose placements rise with their structure rows: no record above one of an earlier row."""
    rows = placed.groupBy("page", "table", "struct_row").agg(F.min("record").alias("low"), F.max("record").alias("high"))
    before = F.max("high").over(Window.partitionBy("page", "table").orderBy("struct_row").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("ok", F.coalesce(F.col("low") >= before, F.lit(True))).groupBy("page", "table").agg(F.min("ok").alias("ok")).where("ok").select("page", "table")


def insert_values(cells: DataFrame, values: DataFrame) -> DataFrame:
    """Cells (table, record, col, text) with trusted values (table, record, col, value) put into blank ones: (…, text, inserted)."""
    met = cells.join(values, ["table", "record", "col"], "left")
    blank = tx.strip(F.coalesce("text", F.lit(""))) == ""
    put = blank & F.col("value").isNotNull()
    return met.select("table", "record", "col", F.when(put, F.col("value")).otherwise(F.col("text")).alias("text"), put.alias("inserted"))


def symbol_columns(symbols: DataFrame, bands: DataFrame) -> DataFrame:
    """(page, table, record, text): symbols whose centre lies in one record's band only, left to right, each once."""
    r = F.col("rect")
    met = symbols.join(bands, ["page", "table"]).where(geo.centre_y(r).between(F.col("top") - 0.006, F.col("bottom") + 0.006))
    one = met.withColumn("n", F.count("*").over(Window.partitionBy("page", "table", "id"))).where("n = 1")
    ordered = F.array_sort(F.collect_list(F.struct(geo.centre_x(r).alias("x"), "value")))
    return one.groupBy("page", "table", "record").agg(F.array_join(F.array_distinct(F.transform(ordered, lambda x: x["value"])), ", ").alias("text"))
