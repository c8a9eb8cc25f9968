"""Queries over whole pages: the Markdown plan, realigned columns, placed and trusted values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import furniture as fu
from ..operators import tables as tb
from ..operators import visual as vi
from ..sources import html
from . import layout_queries as lq
from . import postprocess as pp
from . import text_queries as tq


def postprocess(spark, d):
    """Web pages whose text lost every seventh item: what is lost comes back under its heading, furniture goes."""
    entries, pages = tq._entries(spark, d)
    raw = html.page_markdown(entries).withColumnRenamed("markdown", "raw")
    some = html.page_markdown(entries.where("pos % 7 != 5"))
    out = pp.postprocess(raw.join(some, ["doc", "page"]), fu.strip_texts(entries, pages))
    return out.select("doc", "page", F.length("final").alias("n_chars"), F.size("unplaced").alias("unplaced"))


def realign_columns(spark, d):
    """Suppliers as source rows of name, gap, key; written rows lack the gap."""
    s = spark.read.parquet(f"{d}/supplier.parquet")
    n = F.row_number().over(tb.Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    key = F.col("s_suppkey").cast("string")
    grid = s.select(F.col("s_nationkey").alias("t"), n.alias("g"), F.array("s_name", F.lit(""), key).alias("cells"))
    rows = s.select(F.col("s_nationkey").alias("t"), n.alias("r"), F.array("s_name", key).alias("cells"))
    return tb.realign(rows, grid, "t").select("t", "r", F.array_join("cells", "|").alias("cells"), "moved", "ambiguous")


realign_columns_sql = """WITH s AS (SELECT s_nationkey AS t, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS r, count(*) OVER (PARTITION BY s_nationkey) AS n, s_name, s_suppkey FROM supplier)
SELECT t::BIGINT AS t, r, s_name || CASE WHEN n >= 2 THEN '||' ELSE '|' END || s_suppkey AS cells, n >= 2 AS moved, n < 2 AS ambiguous FROM s"""


def visual_place(spark, d):
    """Small rectangles over larger ones as cells: candidates whose centre lies in one cell only."""
    r = lq._rects(spark, d).withColumn("page", F.concat_ws("-", "label", "page"))
    cells = r.where("idx % 4 = 0").select("page", F.lit(1).alias("table"), F.col("idx").alias("record"), F.lit(0).alias("col"), "rect")
    return vi.place(r.where("idx % 4 != 0").select("page", F.col("idx").alias("id"), "rect"), cells).select("id", "record")


visual_place_sql = f"""WITH {lq.RECTS}, p AS (SELECT x.idx AS id, y.idx AS record, count(*) OVER (PARTITION BY x.idx) AS n FROM q x JOIN q y ON x.label = y.label AND x.page = y.page AND x.idx % 4 <> 0 AND y.idx % 4 = 0
 AND (x.l + x.r) / 2 BETWEEN y.l - 0.002 AND y.r + 0.002 AND (x.t + x.b) / 2 BETWEEN y.t - 0.002 AND y.b + 0.002) SELECT id, record FROM p WHERE n = 1"""


def visual_assess(spark, d):
    """Events as proposals: the type is the tagged key, a third have pictures that differ, a fifth are there already."""
    e = spark.read.parquet(f"{d}/events.parquet")
    none, t, i = F.array().cast("array<string>"), F.col("event_type"), F.col("event_id")
    c = e.select(
        i.alias("id"), F.when(i % 7 == 0, none).otherwise(F.array(t)).alias("tagged"), F.when(i % 3 == 0, F.array(F.lit("view"))).otherwise(none).alias("pictures"), F.when(i % 5 == 0, t).alias("existing"),
        F.array(F.lit("parent_tree_unique"), F.lit("structure_cell")).alias("codes"), F.when(i % 2 == 0, F.array(F.lit("visible"))).otherwise(F.array(F.lit("not_visible"))).alias("paint"), (i % 11 != 0).alias("placed"),
    )
    return vi.assess(c).select("id", "resolution", "reason")


visual_assess_sql = """WITH c AS (SELECT event_id AS id, event_type AS t, CASE WHEN event_id % 3 = 0 AND event_id % 7 <> 0 AND event_type <> 'view' THEN 'conflicting_coextensive_picture_proposal' WHEN event_id % 7 = 0 THEN 'no_usable_actual_text'
 WHEN event_id % 5 = 0 THEN 'native_value_matches' WHEN event_id % 2 = 0 AND event_id % 11 <> 0 THEN 'trusted_tagged_value' WHEN event_id % 2 = 1 THEN 'non_painting_tag' ELSE 'insufficient_generic_evidence' END AS reason FROM events)
SELECT id, CASE WHEN starts_with(reason, 'conflicting') THEN 'conflict' WHEN reason = 'native_value_matches' THEN 'already_present' WHEN reason = 'trusted_tagged_value' THEN 'trusted' ELSE 'unresolved' END AS resolution, reason FROM c"""


def normalized_rects(spark, d):
    """Rectangles in points of a page with the origin at the bottom left, normalised."""
    r = F.col("rect")
    out = lq._rects(spark, d).select("idx", geo.from_points(r[0] * 600, F.lit(800.0) - r[1] * 800, r[2] * 600, F.lit(800.0) - r[3] * 800, F.lit(600.0), F.lit(800.0), F.lit(True)).alias("n"))
    return out.select("idx", *[F.col("n")[i].alias(c) for i, c in enumerate(("left", "top", "right", "bottom"))])


normalized_rects_sql = f"""WITH {lq.RECTS} SELECT idx, round(least(1, greatest(0, l * 600 / 600)), 3) AS "left", round(least(1, greatest(0, (800 - (800 - t * 800)) / 800)), 3) AS top, round(least(1, greatest(0, r * 600 / 600)), 3) AS "right",
round(least(1, greatest(0, (800 - (800 - b * 800)) / 800)), 3) AS bottom FROM q"""

NAMES = ("postprocess", "realign_columns", "visual_place", "visual_assess", "normalized_rects")
