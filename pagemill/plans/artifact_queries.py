"""Queries over run records, contracts and progress, made from events, labels and conversations, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import artifacts as ar
from ..operators import contracts as co
from ..operators import model as mo
from ..operators.settle import shared_dir
from ..streaming import progress as pr


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def token_usage(spark, d):
    e = _read(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("stage"), F.round(F.col("value") * 100).cast("long").alias("prompt_tokens"), (F.col("event_id") % 97).alias("output_tokens"), (F.round(F.col("value") * 100).cast("long") * 10_000_000).alias("duration"))
    return ar.token_usage(e).withColumn("total", F.col("total").cast("long"))


token_usage_sql = """WITH c AS (SELECT user_id AS page, event_type AS stage, round(value * 100)::BIGINT AS p, event_id % 97 AS o FROM events)
SELECT stage, grouping(stage)::BIGINT AS total, count(*) AS calls, sum(p)::BIGINT AS prompt_tokens, sum(o)::BIGINT AS output_tokens, sum(p + o)::BIGINT AS total_tokens, round(sum(p * 10000000)::DOUBLE / 1e9, 1) AS seconds, count(DISTINCT page) AS pages FROM c GROUP BY ROLLUP (stage)"""


def manifest(spark, d):
    e = _read(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("stage"), F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("status"), F.struct("ts", "event_id").alias("at"), F.col("value").alias("seconds"), F.when(F.col("value") > 20, "slow").alias("warning"))
    return ar.manifest(e)


manifest_sql = """SELECT user_id AS page, count(*) AS records, count(*) FILTER (WHERE event_type = 'error') AS failed, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS stages,
max_by(CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END, (ts, event_id)) AS last_status, round(sum(value), 3) AS seconds, count(*) FILTER (WHERE value > 20) AS warnings FROM events GROUP BY user_id"""


def fired_warnings(spark, d):
    e = _read(spark, d, "events").select(F.col("user_id").alias("page"), F.create_map(F.col("event_type"), F.when(F.col("value") > 20, "1").otherwise("0")).alias("warnings"))
    return ar.fired_warnings(e)


fired_warnings_sql = "SELECT event_type AS category, count(DISTINCT user_id) AS pages FROM events WHERE value > 20 GROUP BY 1"


def progress_validate(spark, d):
    e = pr.payloads(_read(spark, d, "events"))
    return e.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


progress_validate_sql = "SELECT CASE WHEN event_type = 'error' THEN 'page event without page' ELSE 'ok' END AS outcome, count(*) AS n FROM events GROUP BY 1"


def progress_windows(spark, d):
    return pr.windowed(pr.payloads(_read(spark, d, "events"))).withColumn("start", F.unix_timestamp("start"))


progress_windows_sql = """SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts))::BIGINT AS start, event_type, event_type <> 'error' AS valid, count(*) AS n, round(sum(value), 4) AS seconds FROM events GROUP BY ALL"""


def _shared(spark) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def progress_stream(spark, d):
    """The same state of each page from a stream as from a batch: the last update of each page."""
    from pyspark.sql import Window

    at = _shared(spark)
    _read(spark, d, "events").repartitionByRange(4, "ts").write.parquet(f"{at}/in")
    out = pr.drain(pr.page_state(pr.source(spark, f"{at}/in", files=1)), "update", f"{at}/checkpoint", f"{at}/out")
    last = Window.partitionBy("page").orderBy(F.col("batch").desc())
    return out.withColumn("k", F.row_number().over(last)).where("k = 1").select("page", "seen", "failed")


progress_stream_sql = "SELECT user_id AS page, count(*) AS seen, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1"


def stage_replay(spark, d):
    """Conversations as pages whose turns are stages; every third restarts from turn 1."""
    c = _read(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("stage_no"))
    start = c.select("page").distinct().where("page % 3 = 0").withColumn("from_stage", F.lit(1))
    return ar.replay(c, start).groupBy("page").agg(F.count("*").alias("kept"))


stage_replay_sql = "SELECT conv_id AS page, count(*) AS kept FROM conversations WHERE conv_id % 3 <> 0 OR turn < 1 GROUP BY 1"


def stale_pages(spark, d):
    return ar.stale(_read(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url"), _read(spark, d, "labels"), "doc_id")


stale_pages_sql = "SELECT page_id AS doc_id, url FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)"


def triage_route(spark, d):
    l = _read(spark, d, "labels")
    kind = F.when(F.col("toxic") == 1, "photo").when(F.col("quality") == 1, "chart").otherwise("decorative")
    sure = (F.col("doc_id") % 10) / 10
    why = ar.triage_prefilter(F.when(F.col("doc_id") % 11 == 0, "picture").otherwise(""), F.col("doc_id") % 13 != 0, (F.col("doc_id") % 100) / 1000, F.col("quality") == 0)
    return l.select("doc_id", ar.triage_route(kind, sure).alias("route"), why.alias("prefilter"))


triage_route_sql = """WITH k AS (SELECT *, CASE WHEN toxic = 1 THEN 'photo' WHEN quality = 1 THEN 'chart' ELSE 'decorative' END AS kind, (doc_id % 10) / 10 AS sure, (doc_id % 100) / 1000 AS area FROM labels)
SELECT doc_id, CASE WHEN sure < 0.65 THEN 'generic' WHEN kind = 'photo' AND sure >= 0.8 THEN 'skip' WHEN kind = 'decorative' THEN 'skip' WHEN kind = 'photo' THEN 'generic' ELSE 'specialist' END AS route,
CASE WHEN doc_id % 11 = 0 THEN 'covered_by_parent' WHEN doc_id % 13 = 0 THEN 'missing_image' WHEN area < 0.01 THEN 'too_small' WHEN quality = 0 AND area < 0.05 THEN 'decorative' ELSE 'visual_candidate' END AS prefilter FROM k"""


def symbol_audit(spark, d):
    e = _read(spark, d, "events")
    expected = e.select(F.col("user_id").alias("scope"), F.col("event_type").alias("value"), F.col("value").alias("priority"), F.col("event_id").alias("id"))
    observed = e.where("event_id % 3 = 0").groupBy(F.col("user_id").alias("scope"), F.col("event_type").alias("value")).agg(F.count("*").alias("count"))
    return ar.symbol_audit(expected, observed)


symbol_audit_sql = """WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) AS nth FROM events), o AS (SELECT user_id, event_type, count(*) AS c FROM events WHERE event_id % 3 = 0 GROUP BY ALL)
SELECT x.user_id AS scope, x.event_type AS value, event_id AS id FROM x LEFT JOIN o ON x.user_id = o.user_id AND x.event_type = o.event_type WHERE nth > coalesce(c, 0)"""


def visual_targets(spark, d):
    e = _read(spark, d, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 5).alias("table"), F.expr("event_id div 3").alias("record"), F.lit(0).alias("col"), F.col("event_type").alias("value"), F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("existing"))
    return ar.resolve_targets(e).select("id", "resolution")


visual_targets_sql = """WITH c AS (SELECT event_id AS id, user_id % 5 AS t, event_id // 3 AS r, event_type AS v, CASE WHEN event_id % 4 = 0 THEN event_type END AS e FROM events), n AS (SELECT t, r, count(DISTINCT v) AS k FROM c GROUP BY ALL)
SELECT id, CASE WHEN k > 1 THEN 'conflict' WHEN e IS NOT NULL THEN 'already_present' ELSE 'trusted' END AS resolution FROM c JOIN n USING (t, r)"""


def _geometry(spark, d):
    li = _read(spark, d, "lineitem")
    y = (F.col("l_linenumber") + 1) / 10
    rules = li.select(F.col("l_orderkey").alias("page"), y.alias("y"), (F.col("l_discount") * 2).alias("x0"), (F.lit(0.6) + F.col("l_tax") * 4).alias("x1"))
    tables = li.select(F.col("l_orderkey").alias("page")).distinct().withColumn("table", F.lit(1)).withColumn("rect", F.array(*[F.lit(x) for x in (0.0, 0.0, 1.0, 1.0)]))
    return li, rules, tables


def rule_boundaries(spark, d):
    _, rules, tables = _geometry(spark, d)
    return ar.rule_boundaries(rules, tables).select("page", F.round("y", 6).alias("y"))


# the pieces of a rule overlap, so together they cover from the least start to the greatest end
rule_boundaries_sql = """SELECT l_orderkey AS page, round((l_linenumber + 1) / 10, 6) AS y FROM lineitem WHERE l_linenumber <= 9 GROUP BY l_orderkey, l_linenumber
HAVING least(1, max(0.6 + l_tax * 4)) - greatest(0, min(l_discount * 2)) >= 0.5 - 1e-9"""


def reconcile_grid(spark, d):
    """Source lines placed on the grid that rules and column intervals draw."""
    from pyspark.sql import Window

    li, rules, tables = _geometry(spark, d)
    bounds = ar.rule_boundaries(rules, tables)
    y = (F.col("l_linenumber") + 1) / 10 + 0.02
    left = (F.col("l_suppkey") % 2) * 0.5
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))  # line numbers repeat in an order
    lines = li.select(F.col("l_orderkey").alias("page"), F.lit(1).alias("table"), nth.alias("line"), F.array(left + 0.05, y, left + 0.3, y + 0.05).alias("rect"), F.col("l_partkey").cast("string").alias("text"))
    columns = tables.select("page", "table", F.explode(F.array(F.struct(F.lit(0).alias("col"), F.lit(0.0).alias("left"), F.lit(0.5).alias("right")), F.struct(F.lit(1).alias("col"), F.lit(0.5).alias("left"), F.lit(1.0).alias("right")))).alias("c")).select("page", "table", "c.*")
    return ar.lines_to_grid(lines, columns, bounds).select("page", "band", "col", "text")


def _echo():
    return lambda prompt: prompt.upper()


def model_udf(spark, d):
    """A stand-in model over all documents."""
    p = _read(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    return mo.call_model(p, _echo, key="doc_id").select("doc_id", "answer", "attempts", "error")


NAMES = (
    "token_usage", "manifest", "fired_warnings", "progress_validate", "progress_windows", "progress_stream", "stage_replay", "stale_pages", "triage_route", "symbol_audit", "visual_targets",
    "rule_boundaries", "reconcile_grid", "model_udf",
)
