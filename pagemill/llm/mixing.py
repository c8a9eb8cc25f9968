"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is a sequence of equal blocks of BLOCK words.  Every block goes to the source with the highest quotient
target / (2 * blocks it has + 1); consecutive runs of the sequence are the shards of the mix, so each shard has an
integer quota of each source.  A source lays its documents out in a seeded random order as a stream of words; its
blocks are taken from that stream in order, from the start again after its end.  All of this is DataFrame operations.

Targets: sources by code point, null last, weigh 5, 2, 1 in turn and share TIMES of all words; a target stops at
REPEATS times its source's words and what is left over is shared by weight again.  That is the level at which
sum(min(cap, level * weight)) meets the total, found from running sums over sources by cap / weight.

The stream is ordered by the md5 of seed, doc_id and text.  Positions come from running sums over (source, bucket) with
bucket = three leading hex digits of that md5, and running totals of buckets, so a source with a third of all rows is
spread over 4096 windows.  Rows alike in doc_id and text share one md5: they enter those windows as one row for each part
of the table, with their number and words, and are numbered inside their part alone, so a third of all rows under one id (or
none) is no window of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, materialize, word_count

BLOCK, SHARDS, TIMES, REPEATS, WEIGHTS, SEED = 16, 8, 1.5, 2, (5, 2, 1), "mix-7"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(skey, source, source_size) -> the same with target.  A row for each source: small beside the documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    caps = sizes.withColumn("weight", F.array(*map(F.lit, weights))[nth]).withColumn("cap", F.col("source_size") * REPEATS)
    ratio = F.col("cap") / F.col("weight")
    by_ratio, whole = Window.orderBy(ratio, F.col("source").asc_nulls_last()), Window.partitionBy()
    caps = caps.withColumns(
        {
            "full": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "left": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(whole) * F.lit(TIMES),
        }
    )
    level = (F.col("total") - F.col("full")) / F.col("left")
    # levels fall after the first source that stays below its cap, so its level is the largest of those not reached
    caps = caps.withColumn("level", F.max(F.when(ratio > level, level)).over(whole))
    cap = F.col("cap").cast("double")
    return caps.select("skey", "source", "source_size", F.coalesce(F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def quotas(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(skey, upto): how many blocks a source has by the end of each shard, by Sainte-Laguë.

    Seat j of a source has the quotient target / (2j - 1); the highest quotients win, ties by source.  With divisor
    total / (2 * seats) each source has round(its share) seats; the true number differs by half the number of sources,
    times the share, plus one, at most.  Only those seats are listed and ranked.  The method is house-monotone, so
    the seats at the end of each shard give quotas that never fall."""
    whole, house = Window.partitionBy(), Window.partitionBy("k")
    t = targets.where("target > 0").withColumn("total", F.sum("target").over(whole)).withColumn("sources", F.count("*").over(whole))
    t = t.withColumn("share", F.col("target") / F.col("total")).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    t = t.withColumn("seats", F.round(F.greatest(F.lit(1.0), F.round(F.col("total") / block)) * F.col("k") / shards).cast("long"))
    t = t.withColumn("near", F.round(F.col("share") * F.col("seats")).cast("long"))
    t = t.withColumn("reach", F.ceil(F.col("share") * F.col("sources") / 2).cast("long") + 2)
    t = t.withColumn("sure", F.greatest(F.lit(0), F.col("near") - F.col("reach")))
    t = t.withColumn("open", F.col("seats") - F.sum("sure").over(house))
    seat = t.withColumn("j", F.explode(F.sequence(F.col("sure") + 1, F.col("near") + F.col("reach"))))
    best = house.orderBy((F.col("target") / (2 * F.col("j") - 1)).desc(), F.col("source").asc_nulls_last())
    seat = seat.withColumn("won", (F.row_number().over(best) <= F.col("open")).cast("long"))
    ends = seat.groupBy("skey", "k").agg((F.max("sure") + F.sum("won")).alias("end"))
    return ends.groupBy("skey").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "end"))), lambda x: x["end"]).alias("upto"))


def _order(seed: str) -> Column:
    """What orders a source's stream: equal for rows that are alike, else as good as chance."""
    text = F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit("null"))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))


def mix_sources(
    docs: DataFrame, *, keep: tuple[str, ...] = (), block: int = BLOCK, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED
) -> DataFrame:
    """What a mix takes of each document.

    Returns doc_id, source, size (words), source_size, target, taken (words, repeats counted), takes (words of the
    first and of the second pass, both from the document's start) and shard (that of its first block; null if the mix
    takes none), and the columns named in `keep`, prefixed by `kept_`.  A null or wordless text has size 0 and takes none;
    null is a source of its own; repeated rows are documents of their own; an empty table gives an empty table.
    """
    base = docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("skey"), word_count(F.col("text")).alias("size"), _order(seed).alias("okey"),
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    # the written table keeps the number of a row; its upper bits are the part of the table that holds it
    base = materialize(base.withColumn("part", F.shiftright("row", 33)), "mix-sizes")
    bucket = F.substring("okey", 1, 3).alias("bucket")
    alike = base.groupBy("skey", "source", "okey", "part").agg(F.count("*").alias("n"), F.first("size").alias("each")).withColumn("words", F.col("n") * F.col("each"))
    alike = materialize(alike.select("*", bucket), "mix-alike")
    totals = materialize(alike.groupBy("skey", "source", "bucket").agg(F.sum("words").alias("words")), "mix-totals")
    targets = source_targets(totals.groupBy("skey", "source").agg(F.sum("words").alias("source_size")), weights)
    targets = targets.join(quotas(targets, block, shards), "skey", "left").drop("source")
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("skey", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")).join(targets, "skey")
    here = Window.partitionBy("skey", "bucket").orderBy("okey", "part").rowsBetween(Window.unboundedPreceding, 0)
    alike = alike.withColumn("end", F.sum("words").over(here)).withColumn("first", F.col("end") - F.col("words")).join(places, ["skey", "bucket"])
    alike = alike.select("skey", "okey", "part", (F.col("start") + F.col("first")).alias("first"), "source_size", "target", "upto")
    nth = F.row_number().over(Window.partitionBy("skey", "okey", "part").orderBy("row")) - 1
    out = base.withColumn("nth", nth).join(alike, ["skey", "okey", "part"])
    at = F.col("first") + F.col("nth") * F.col("size")
    quota = F.least(F.coalesce(F.element_at("upto", -1), F.lit(0)) * block, F.col("source_size") * REPEATS)
    part = lambda left: F.greatest(F.lit(0), F.least(F.col("size"), left))
    out = out.withColumn("at", at).withColumn("quota", quota)
    out = out.withColumn("takes", F.array(*[part(F.col("quota") - F.col("source_size") * n - F.col("at")) for n in range(REPEATS)]))
    shard = F.size(F.filter("upto", lambda x: x * block <= F.col("at")))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("takes")[0] + F.col("takes")[1]).alias("taken"), "takes",
        F.when(F.col("takes")[0] > 0, shard).alias("shard"), *[f"kept_{c}" for c in keep],
    )


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each pass over a document, with the words that the mix takes of it (all of them, but for the last
    document of a source's quota); n_chars follows.  Documents that the mix does not reach, or without words, go."""
    mixed = mix_sources(docs, keep=tuple(docs.columns))
    rows = mixed.withColumn("words", F.explode("takes")).where("words > 0")
    pieces = F.regexp_extract_all("kept_text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    text = F.when(F.col("words") == F.col("size"), F.col("kept_text")).otherwise(F.array_join(F.slice(pieces, 1, F.col("words").cast("int")), ""))
    rows = rows.withColumn("kept_text", text)
    return rows.withColumn("kept_n_chars", F.length("kept_text").cast(docs.schema["n_chars"].dataType)).select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def op4_sql() -> str:
    """The same by windows over whole sources, for DuckDB."""
    w = "[5, 2, 1]"
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS okey FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ({w})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * {REPEATS} AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS done,
             (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS remaining, (sum(source_size) OVER ())::DOUBLE * {TIMES} AS total
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
l AS (SELECT *, max(CASE WHEN cap / weight > (total - done) / remaining THEN (total - done) / remaining END) OVER () AS level FROM r),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, level * weight), cap::DOUBLE) AS target FROM l),
h AS (SELECT greatest(1, round(sum(target) / {BLOCK}))::BIGINT AS seats, sum(target) AS total FROM t),
j AS (SELECT source, target, unnest(generate_series(1, (target / total * seats)::BIGINT + (SELECT count(*) FROM t) + 2)) AS j FROM t, h WHERE target > 0),
q AS (SELECT source, row_number() OVER (ORDER BY target / (2 * j - 1) DESC, source NULLS LAST) AS place FROM j),
u AS (SELECT source, count(*) AS blocks FROM q WHERE place <= (SELECT seats FROM h) GROUP BY source),
p AS (SELECT d.*, t.source_size, t.target, least(coalesce(u.blocks, 0) * {BLOCK}, t.source_size * {REPEATS}) AS quota,
             (sum(size) OVER (PARTITION BY d.source ORDER BY okey ROWS UNBOUNDED PRECEDING))::BIGINT - size AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - pos)) + greatest(0, least(size, quota - source_size - pos)))::BIGINT AS taken FROM p
"""
