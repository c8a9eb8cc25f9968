"""Queries over rectangles, made from the first four components of each vector, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import furniture as fu
from ..operators import layout as lo


def _rects(spark, d):
    """One rectangle a vector; a page is a label and a thousand ids."""
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    at = lambda i: F.least(F.lit(1.0), F.abs(F.col("embedding")[i].cast("double")) * 2)
    side = lambda i: F.abs(F.col("embedding")[i].cast("double")) + 0.01
    r = e.select("label", F.expr("vec_id div 1000").alias("page"), F.col("vec_id").cast("int").alias("idx"), at(0).alias("l"), at(1).alias("t"), side(2).alias("w"), side(3).alias("h"))
    return r.select("label", "page", "idx", F.array("l", "t", F.least(F.lit(1.0), F.col("l") + F.col("w")), F.least(F.lit(1.0), F.col("t") + F.col("h"))).alias("rect"))


RECTS = """e AS (SELECT label::BIGINT AS label, vec_id // 1000 AS page, vec_id AS idx, least(1.0::DOUBLE, abs(embedding[1]::DOUBLE) * 2) AS l, least(1.0::DOUBLE, abs(embedding[2]::DOUBLE) * 2) AS t, abs(embedding[3]::DOUBLE) + 0.01 AS w, abs(embedding[4]::DOUBLE) + 0.01 AS h FROM embeddings),
q AS (SELECT label, page, idx, l, t, least(1.0::DOUBLE, l + w) AS r, least(1.0::DOUBLE, t + h) AS b FROM e)"""


def rect_metrics(spark, d):
    r = F.col("rect")
    return _rects(spark, d).select(
        "idx", F.round(geo.area(r), 6).alias("area"), F.round(geo.aspect(r), 4).alias("aspect"), F.round(geo.distance(r, F.array(*[F.lit(x) for x in (0.0, 0.0, 1.0, 1.0)])), 6).alias("off_centre"), fu.band(r).alias("band")
    )


rect_metrics_sql = f"""WITH {RECTS} SELECT idx, round(greatest(0, r - l) * greatest(0, b - t), 6) AS area, round(greatest(0, r - l) / greatest(greatest(0, b - t), 0.001), 4) AS aspect,
round(sqrt(pow((l + r) / 2 - 0.5, 2) + pow((t + b) / 2 - 0.5, 2)), 6) AS off_centre, CASE WHEN t <= 0.08 THEN 'top' WHEN b >= 0.92 THEN 'bottom' WHEN l >= 0.92 THEN 'right' ELSE 'body' END AS band FROM q"""


def overlap_join(spark, d):
    """Rectangles with an even id that one with an odd id covers by half of the smaller, where it is the only one."""
    r = _rects(spark, d)
    pairs = lo.overlap_join(r.where("idx % 2 = 1"), r.where("idx % 2 = 0"), "label", "page")
    return lo.unique_owner(pairs, "label", "page").select("label", "a", "b", F.round("ratio", 6).alias("ratio"))


overlap_join_sql = f"""WITH {RECTS}, p AS (SELECT x.label, x.page, x.idx AS a, y.idx AS b, greatest(0, least(x.r, y.r) - greatest(x.l, y.l)) * greatest(0, least(x.b, y.b) - greatest(x.t, y.t)) / least((x.r - x.l) * (x.b - x.t), (y.r - y.l) * (y.b - y.t)) AS ratio
 FROM q x JOIN q y ON x.label = y.label AND x.page = y.page AND x.idx % 2 = 1 AND y.idx % 2 = 0 AND x.r > x.l AND x.b > x.t AND y.r > y.l AND y.b > y.t),
o AS (SELECT * FROM p WHERE ratio >= 0.5), c AS (SELECT *, count(*) OVER (PARTITION BY label, page, b) AS n FROM o) SELECT label, a, b, round(ratio, 6) AS ratio FROM c WHERE n = 1"""


def axis_gaps(spark, d):
    g = lo.axis_gaps(_rects(spark, d), 0, 0.01, "label", "page")
    return g.select("label", "page", F.round("gap", 6).alias("gap"))


axis_gaps_sql = f"""WITH {RECTS}, m AS (SELECT label, page, l, max(r) OVER (PARTITION BY label, page ORDER BY l, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM q)
SELECT label, page, round((m + l) / 2, 6) AS gap FROM m WHERE l - m >= 0.01"""


def timeline_clusters(spark, d):
    return lo.timeline(_rects(spark, d), 0.08, "label", "page").select("label", "idx", "near")


timeline_clusters_sql = f"""WITH {RECTS}, c AS (SELECT *, (l + r) / 2 AS cx, (t + b) / 2 AS cy FROM q),
n AS (SELECT label, idx, greatest(count(*) OVER (PARTITION BY label, page ORDER BY cx RANGE BETWEEN 0.08 PRECEDING AND 0.08 FOLLOWING), count(*) OVER (PARTITION BY label, page ORDER BY cy RANGE BETWEEN 0.08 PRECEDING AND 0.08 FOLLOWING)) AS near FROM c)
SELECT * FROM n WHERE near >= 3"""


def picture_embedding(spark, d):
    """Pictures and the larger ones that hold half of them: the largest by overlap, then the smaller id."""
    from pyspark.sql import Window

    r = _rects(spark, d)
    pairs = lo.overlap_join(r, r, "label", "page").where("a != b")
    sizes = r.select("label", "page", "idx", geo.area(F.col("rect")).alias("area"))
    big = sizes.select("label", "page", F.col("idx").alias("a"), F.col("area").alias("a_area"))
    small = sizes.select("label", "page", F.col("idx").alias("b"), F.col("area").alias("b_area"))
    p = pairs.join(big, ["label", "page", "a"]).join(small, ["label", "page", "b"]).where("a_area > b_area")
    best = Window.partitionBy("label", "page", "b").orderBy(F.round("ratio", 9).desc(), "a")
    return p.withColumn("n", F.row_number().over(best)).where("n = 1").select(F.col("b").alias("picture"), F.col("a").alias("inside"))


picture_embedding_sql = f"""WITH {RECTS}, z AS (SELECT *, (r - l) * (b - t) AS s FROM q WHERE r > l AND b > t), p AS (SELECT x.label, x.page, x.idx AS a, y.idx AS b, greatest(0, least(x.r, y.r) - greatest(x.l, y.l)) * greatest(0, least(x.b, y.b) - greatest(x.t, y.t)) / least(x.s, y.s) AS ratio
 FROM z x JOIN z y ON x.label = y.label AND x.page = y.page AND x.idx <> y.idx AND x.s > y.s), n AS (SELECT *, row_number() OVER (PARTITION BY label, page, b ORDER BY round(ratio, 9) DESC, a) AS k FROM p WHERE ratio >= 0.5)
SELECT b AS picture, a AS inside FROM n WHERE k = 1"""


def cluster_axis(spark, d):
    c = lo.axis_clusters(_rects(spark, d), 0, 0.02, "label", "page")
    return c.select("label", "page", F.size("clusters").alias("n"), F.round(F.element_at("clusters", 1), 6).alias("first"))


# a cluster is open while the next value lies within 0.02 of the running mean of its members
cluster_axis_sql = f"""WITH RECURSIVE {RECTS}, o AS (SELECT label, page, l, row_number() OVER (PARTITION BY label, page ORDER BY l) AS k FROM q),
c AS (SELECT label, page, k, 1 AS n, 1 AS members, l AS total, l AS first_sum, 1 AS first_n FROM o WHERE k = 1
 UNION ALL SELECT o.label, o.page, o.k, CASE WHEN abs(o.l - c.total / c.members) <= 0.02 THEN c.n ELSE c.n + 1 END, CASE WHEN abs(o.l - c.total / c.members) <= 0.02 THEN c.members + 1 ELSE 1 END,
  CASE WHEN abs(o.l - c.total / c.members) <= 0.02 THEN c.total + o.l ELSE o.l END, CASE WHEN c.n = 1 AND abs(o.l - c.total / c.members) <= 0.02 THEN c.first_sum + o.l ELSE c.first_sum END,
  CASE WHEN c.n = 1 AND abs(o.l - c.total / c.members) <= 0.02 THEN c.first_n + 1 ELSE c.first_n END FROM c JOIN o ON o.label = c.label AND o.page = c.page AND o.k = c.k + 1)
SELECT label, page, max(n)::BIGINT AS n, round(max_by(first_sum / first_n, k), 6) AS first FROM c GROUP BY label, page"""


def _cells(spark, d):
    return _rects(spark, d).withColumn("kind", F.when(F.col("idx") % 5 == 0, "list_item").otherwise("paragraph")).withColumn("is_heading", F.col("idx") % 17 == 0).withColumn("page", F.expr("idx div 40"))


def reading_order(spark, d):
    return lo.reading_order(_cells(spark, d), "page")


def region_score(spark, d):
    return lo.region_scores(_cells(spark, d).withColumn("text", F.col("idx").cast("string")), "page")


def panel_segments(spark, d):
    return lo.segment(_cells(spark, d), "page")


NAMES = ("rect_metrics", "overlap_join", "axis_gaps", "timeline_clusters", "picture_embedding", "cluster_axis", "reading_order", "region_score", "panel_segments")
