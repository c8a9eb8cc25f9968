"""Records of a run: usage totals, manifest, stale pages, replay, picture routes, symbol audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stages of a page in order, and picture thresholds.
STAGES = ("prepare", "picture_triage", "picture_extract", "table_detect", "table_extract", "page_refine", "page_repair", "finalize")
MIN_AREA, DECORATIVE_AREA, TRIAGE_SURE, PHOTO_SKIP = 0.01, 0.05, 0.65, 0.8


def token_usage(calls: DataFrame) -> DataFrame:
    """Totals by stage and over all (stage null) by a rollup: calls (page, stage, prompt_tokens, output_tokens, duration in ns)."""
    sums = calls.rollup("stage").agg(
        F.grouping("stage").alias("total"), F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.col("prompt_tokens") + F.col("output_tokens")).alias("total_tokens"), F.round(F.sum("duration") / 1e9, 1).alias("seconds"), F.countDistinct("page").alias("pages"),
    )
    return sums


def manifest(states: DataFrame) -> DataFrame:
    """A row for each page from its stage records (page, stage, status, seconds, warning): counts, kinds and last status.

    One aggregation; the last status is a max_by, not a window."""
    return states.groupBy("page").agg(
        F.count("*").alias("records"), F.count_if(F.col("status") == "fail").alias("failed"), F.array_join(F.array_sort(F.collect_set("stage")), ",").alias("stages"),
        F.max_by("status", "at").alias("last_status"), F.round(F.sum("seconds"), 3).alias("seconds"), F.count("warning").alias("warnings"),
    )


def fired_warnings(pages: DataFrame) -> DataFrame:
    """(category, pages) over maps of warnings: pages where the category is set."""
    fired = pages.select("page", F.explode("warnings").alias("category", "value")).where(F.col("value").isNotNull() & ~F.col("value").isin("", "0", "false", "[]"))
    return fired.groupBy("category").agg(F.countDistinct("page").alias("pages"))


def stale(existing: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Pages that exist and are not part of the run."""
    return existing.join(current.select(key).distinct(), key, "left_anti")


def stage_index(stage: Column) -> Column:
    """Place of a stage from 0; null for no stage."""
    at = F.array_position(F.lit(list(STAGES)), stage)
    return F.when(at > 0, at - 1)


def replay(records: DataFrame, start: DataFrame) -> DataFrame:
    """Stage records (page, stage_no, ...) that stay when each page restarts from its stage (page, from_stage)."""
    return records.join(start, "page", "left").where(F.col("from_stage").isNull() | (F.col("stage_no") < F.col("from_stage"))).drop("from_stage")


def triage_prefilter(embedded_in: Column, has_image: Column, area: Column, decorative: Column) -> Column:
    """Why a picture is, or is not, worth a model call."""
    return (
        F.when(embedded_in == "picture", "covered_by_parent").when(embedded_in == "table", "table_embedded").when(~has_image, "missing_image").when(area < MIN_AREA, "too_small")
        .when(decorative & (area < DECORATIVE_AREA), "decorative").otherwise("visual_candidate")
    )


def triage_route(kind: Column, confidence: Column) -> Column:
    """What to do with a classified picture: unsure ones go the generic way, sure photos and ornaments are skipped."""
    return (
        F.when(confidence < TRIAGE_SURE, "generic").when((kind == "photo") & (confidence >= PHOTO_SKIP), "skip").when(kind == "decorative", "skip")
        .when(kind.isin("photo", "unclear"), "generic").otherwise("specialist")
    )


def symbol_audit(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected symbols (scope, value, priority, id) beyond what was observed (scope, value, count): by value, the first by
    priority are taken as found."""
    nth = F.row_number().over(Window.partitionBy("scope", "value").orderBy("priority", "id"))
    left = expected.withColumn("nth", nth).join(observed, ["scope", "value"], "left")
    return left.where(F.col("nth") > F.coalesce("count", F.lit(0))).select("scope", "value", "id")


def resolve_targets(candidates: DataFrame) -> DataFrame:
    """Visual candidates (id, table, record, col, value, existing): conflict where one cell gets different values or holds
    another; already_present where it holds this one; else trusted."""
    cell = Window.partitionBy("table", "record", "col")
    many = F.size(F.collect_set(F.lower("value")).over(cell)) > 1
    has = F.coalesce("existing", F.lit("")) != ""
    same = F.lower("existing") == F.lower("value")
    return candidates.withColumn("resolution", F.when(many, "conflict").when(has & same, "already_present").when(has, "conflict").otherwise("trusted"))


def rule_boundaries(rules: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, y): rules of a page, joined within 0.4 % of the table's height, that cover half of its width.

    Rules (page, y, x0, x1) meet tables (page, table, rect) by page; overlapping pieces of one height are merged by a running
    maximum of ends, so covered width counts once."""
    r = F.col("rect")
    j = tables.join(rules, "page").withColumn("tol", (r[3] - r[1]) * 0.004).where((F.col("y") >= r[1] - F.col("tol")) & (F.col("y") <= r[3] + F.col("tol")))
    j = j.withColumn("x0", F.greatest("x0", r[0])).withColumn("x1", F.least("x1", r[2])).where("x1 > x0")
    by_y = Window.partitionBy("page", "table").orderBy("y")
    j = j.withColumn("line", F.sum(F.when(F.col("y") - F.lag("y").over(by_y) <= F.col("tol"), 0).otherwise(1)).over(by_y))
    along = Window.partitionBy("page", "table", "line").orderBy("x0", "x1").rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("reach", F.coalesce(F.max("x1").over(along), F.col("x0"))).withColumn("new", F.greatest(F.lit(0.0), F.col("x1") - F.greatest("x0", "reach")))
    sums = j.groupBy("page", "table", "line").agg(F.min("y").alias("y"), F.sum("new").alias("covered"), F.first(r[2] - r[0]).alias("width"))
    return sums.where("covered >= 0.5 * width - 1e-9").select("page", "table", "y")


def lines_to_grid(lines: DataFrame, columns: DataFrame, bounds: DataFrame) -> DataFrame:
    """Source lines (page, table, line, rect, text) as a grid: band from the rules above them, column from the largest overlap
    with a column's interval (half of the line's width at least; the first column wins ties), text in reading order."""
    r = F.col("rect")
    met = lines.join(columns, ["page", "table"]).withColumn("over", F.least(r[2], "right") - F.greatest(r[0], "left")).where((F.col("over") > 0) & (F.col("over") >= 0.5 * (r[2] - r[0])))
    best = met.withColumn("n", F.row_number().over(Window.partitionBy("page", "table", "line").orderBy(F.col("over").desc(), "col"))).where("n = 1")
    above = best.join(bounds, ["page", "table"], "left").groupBy("page", "table", "line", "col", "rect", "text").agg(F.count_if(F.col("y") <= (r[1] + r[3]) / 2).alias("band"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rect")[1].alias("top"), F.col("rect")[0].alias("left"), "line", "text")))
    return above.groupBy("page", "table", "band", "col").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))
