"""Queries over records: tagged values, states and progress of pages, prompt maps, regions and reconciled grids, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import paint as pt
from ..functions import prompts as fp
from ..functions import symbols as sy
from ..operators import contracts as co
from ..operators import gates as ga
from ..operators import layout as lo
from ..operators import prompt_map as pm
from ..operators import reconcile as rc
from ..operators import state as st
from ..operators import tagged as tg
from . import layout_queries as lq


GRID_ROWS = 40  #: suppliers of a page in `grid_reconciled`


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string")


# --- tagged values ------------------------------------------------------------------------------------------------


def paint_space(spark, d):
    """Matrices and points of page space, from the components of vectors, as numbers of the page as it is shown."""
    e = _read(spark, d, "embeddings")
    x = lambda i: F.abs(F.col("embedding")[i].cast("double")) * 100
    m = pt.compose(F.array(F.lit(2.0), F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(5.0), F.lit(7.0)), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), x(0), x(1)))
    p = pt.apply(m, pt.point(x(2), x(3)))
    turn = pt.rotation((F.col("vec_id") % 5 * 90).cast("string"))
    box = pt.crop(F.array(*[F.lit(v) for v in (0.0, 0.0, 600.0, 800.0)]), F.lit(1.0), F.lit(1.0))
    r = pt.rect_to_page(F.array(p["x"], p["y"], p["x"] + 50, p["y"] + 20), box, turn)
    q = e.select("vec_id", p.alias("p"), turn.alias("turn"), r.alias("r"))
    return q.select("vec_id", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"), F.col("turn").alias("turn"), *[F.round(F.coalesce(F.col("r")[i], F.lit(-1.0)), 6).alias(c) for i, c in enumerate(("left_", "top", "right_", "bottom"))])


paint_space_sql = """WITH e AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 100 AS a, abs(embedding[2]::DOUBLE) * 100 AS b, abs(embedding[3]::DOUBLE) * 100 AS c, abs(embedding[4]::DOUBLE) * 100 AS d FROM embeddings),
p AS (SELECT vec_id, 2 * (c + a) + 5 AS x, 3 * (d + b) + 7 AS y, (vec_id % 5 * 90) % 360 AS turn FROM e),
u AS (SELECT *, x AS ux0, x + 50 AS ux1, 800 - y - 20 AS uy0, 800 - y AS uy1 FROM p),
t AS (SELECT *, CASE turn WHEN 90 THEN (800 - uy1) / 800 WHEN 180 THEN (600 - ux1) / 600 WHEN 270 THEN uy0 / 800 ELSE ux0 / 600 END AS l, CASE turn WHEN 90 THEN (800 - uy0) / 800 WHEN 180 THEN (600 - ux0) / 600 WHEN 270 THEN uy1 / 800 ELSE ux1 / 600 END AS r,
 CASE turn WHEN 90 THEN ux0 / 600 WHEN 180 THEN (800 - uy1) / 800 WHEN 270 THEN (600 - ux1) / 600 ELSE uy0 / 800 END AS tp, CASE turn WHEN 90 THEN ux1 / 600 WHEN 180 THEN (800 - uy0) / 800 WHEN 270 THEN (600 - ux0) / 600 ELSE uy1 / 800 END AS bt FROM u),
v AS (SELECT *, least(1, r) > greatest(0, l) AND least(1, bt) > greatest(0, tp) AS seen FROM t)
SELECT vec_id, round(x, 6) AS x, round(y, 6) AS y, turn, CASE WHEN seen THEN round(greatest(0, l), 6) ELSE -1 END::DOUBLE AS left_, CASE WHEN seen THEN round(greatest(0, tp), 6) ELSE -1 END::DOUBLE AS top,
CASE WHEN seen THEN round(least(1, r), 6) ELSE -1 END::DOUBLE AS right_, CASE WHEN seen THEN round(least(1, bt), 6) ELSE -1 END::DOUBLE AS bottom FROM v"""


def pdf_strings(spark, d):
    """Names of parts as strings of bytes in four encodings, decoded and normalised."""
    p = _read(spark, d, "part")
    k = F.col("p_partkey") % 4
    n = F.concat("p_name", F.lit(" é"), F.when((k == 2) & (F.length("p_name") % 2 == 0), "x").otherwise(""))  # Latin-1 of even length reads as UTF-16
    raw = F.when(k == 0, F.encode(n, "UTF-8")).when(k == 1, F.concat(F.unhex(F.lit("FEFF")), F.encode(n, "UTF-16BE"))).when(k == 2, F.encode(n, "ISO-8859-1")).otherwise(F.concat(F.unhex(F.lit("EFBBBF")), F.encode(n, "UTF-8")))
    text = pt.decode(raw)
    return p.select("p_partkey", text.alias("text"), pt.actual_text(F.concat(F.lit("  "), text, F.lit("  x"), F.unhex(F.lit("00")).cast("string"))).alias("value"), pt.name(F.concat(F.lit("/"), "p_brand")).alias("name"), pt.object_key(F.col("p_partkey"), F.lit(0)).alias("key"))


pdf_strings_sql = """WITH p AS (SELECT p_partkey, p_brand, p_name || ' é' || CASE WHEN p_partkey % 4 = 2 AND length(p_name) % 2 = 0 THEN 'x' ELSE '' END AS n FROM part)
SELECT p_partkey, n AS text, n || ' x' AS value, p_brand AS name, p_partkey || ':0' AS key FROM p"""


def _tree(spark, d):
    """Suppliers as a tagged document: regions, nations as tables, suppliers as rows of two cells; every other first cell covers two rows."""
    s = _read(spark, d, "supplier").select("s_suppkey", "s_nationkey").withColumn("nth", F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1)
    n = _read(spark, d, "nation")
    one, none = F.lit(1), F.lit(None).cast("string")
    node = lambda df, key, tag, actual=none, span=one: df.select(F.lit("d").alias("doc"), key.alias("key"), F.lit(tag).alias("tag"), actual.alias("actual"), F.lit(1).alias("colspan"), span.alias("rowspan"))
    kid = lambda df, parent, child, ord_: df.select(F.lit("d").alias("doc"), parent.alias("parent"), child.alias("child"), ord_.cast("int").alias("ord"))
    k = lambda p, c: F.concat(F.lit(p), _s(c))
    r = _read(spark, d, "region")
    nodes = node(r.where("r_regionkey = 0"), F.lit("root"), "Document").unionByName(node(r, k("g", "r_regionkey"), "Sect")).unionByName(node(n, k("t", "n_nationkey"), "Table")).unionByName(node(s, k("r", "s_suppkey"), "TR"))
    nodes = nodes.unionByName(node(s, k("a", "s_suppkey"), "TD", none, F.when(F.col("nth") % 2 == 0, 2).otherwise(1))).unionByName(node(s, k("b", "s_suppkey"), "TD", k("value ", "s_suppkey")))
    kids = kid(r.where("r_regionkey = 0"), none, F.lit("root"), F.lit(0)).unionByName(kid(r, F.lit("root"), k("g", "r_regionkey"), F.col("r_regionkey"))).unionByName(kid(n, k("g", "n_regionkey"), k("t", "n_nationkey"), F.col("n_nationkey")))
    kids = kids.unionByName(kid(s, k("t", "s_nationkey"), k("r", "s_suppkey"), F.col("nth"))).unionByName(kid(s, k("r", "s_suppkey"), k("a", "s_suppkey"), F.lit(0))).unionByName(kid(s, k("r", "s_suppkey"), k("b", "s_suppkey"), F.lit(1)))
    # a child that points back to its table, as broken files have it
    kids = kids.unionByName(kid(s.where("nth = 0"), k("b", "s_suppkey"), k("t", "s_nationkey"), F.lit(0)))
    return nodes, kids


def structure_cells(spark, d):
    """Logical rows and columns of the cells, with the tags above them."""
    nodes, kids = _tree(spark, d)
    found = tg.structure(nodes, kids)
    cells = tg.table_cells(found, nodes, kids)
    return found.join(cells.drop("table_ref"), ["doc", "key"]).select("key", "table_ref", "struct_row", "struct_col", F.array_join("tags", "/").alias("tags"), F.coalesce("actual", F.lit("")).alias("actual"))


structure_cells_sql = """WITH s AS (SELECT s_suppkey AS k, s_nationkey AS t, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS n FROM supplier)
SELECT 'a' || k AS key, 't' || t AS table_ref, n AS struct_row, n % 2 AS struct_col, 'Document/Sect/Table/TR/TD' AS tags, '' AS actual FROM s
UNION ALL SELECT 'b' || k, 't' || t, n, n % 2 + 1, 'Document/Sect/Table/TR/TD', 'value ' || k FROM s"""


def parent_entries(spark, d):
    """A number tree of three levels over orders: which element a mark of an owner belongs to."""
    o = _read(spark, d, "lineitem")
    doc = F.lit("d").alias("doc")
    node = lambda c: F.concat(F.lit("n"), (F.col(c) % 7).cast("string"))
    entries = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.get(F.filter(F.col("x"), lambda s: s["m"] == i), F.lit(0))["key"])
    per = o.groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_linenumber") - 1).alias("m"), F.concat(F.lit("e"), _s("l_linenumber")).alias("key"))).alias("x"))
    numbers = per.select(doc, node("l_orderkey").alias("node"), F.col("l_orderkey").cast("int").alias("owner"), entries.alias("entries"))
    inner = o.select(doc, F.lit("root").alias("parent"), node("l_orderkey").alias("child")).where("child != 'n6'").distinct()
    tree = inner.unionByName(o.limit(1).select(doc, F.lit(None).cast("string").alias("parent"), F.lit("root").alias("child"))).unionByName(o.limit(1).select(doc, F.lit("n1").alias("parent"), F.lit("root").alias("child")))
    return tg.parent_tree(numbers, tree).select("owner", "mcid", F.array_join("keys", ",").alias("keys"))


parent_entries_sql = "SELECT DISTINCT l_orderkey AS owner, l_linenumber - 1 AS mcid, 'e' || l_linenumber AS keys FROM lineitem WHERE l_orderkey % 7 <> 6 AND l_linenumber <= 7"


def marked_groups(spark, d):
    """Lines of orders as marked boxes of a page, some outside of it, some of text alone: what is painted where."""
    li = _read(spark, d, "lineitem")
    li = li.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    page = F.expr("cast(l_orderkey div 64 as int)").alias("page")
    none, nil = F.array().cast("array<double>"), F.lit(None).cast("string")
    op = lambda name, numbers=none, text=nil, mcid=F.lit(None).cast("int"), actual=nil: F.struct(F.lit(name).alias("op"), numbers.alias("numbers"), text.alias("text"), F.lit("Span").alias("tag"), mcid.alias("mcid"), actual.alias("actual"), nil.alias("ref"))
    x, y = (F.col("l_orderkey") % 64 * 10).cast("double"), (F.col("k") * 100).cast("double")
    moved = op("cm", F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 1.0)], F.lit(20.0), F.lit(0.0)))
    shape = F.when(F.col("l_partkey") % 3 == 0, F.array(op("BT"), op("Tm", F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 1.0)], x, y)), op("Tf", F.array(F.lit(10.0))), op("Tj", none, F.lit("word")))).otherwise(F.array(op("re", F.array(x, y, F.lit(8.0), F.lit(8.0))), op("f")))
    ops = F.concat(F.array(op("q"), moved, op("BDC", none, nil, F.col("k").cast("int"), _s("l_partkey"))), shape, F.array(op("EMC"), op("Q")))
    rows = li.select(F.lit("d").alias("doc"), page, F.lit("page").alias("stream"), "l_orderkey", "k", F.posexplode(ops).alias("at", "o"))
    rows = rows.select("doc", "page", "stream", (F.col("l_orderkey") * 10000 + F.col("k") * 100 + F.col("at")).alias("seq"), "o.*")
    pages = li.select(F.lit("d").alias("doc"), page).distinct().select("doc", "page", F.array(*[F.lit(v) for v in (0.0, 0.0, 600.0, 800.0)]).alias("crop"), F.lit(0).alias("turn"), F.lit(7).alias("owner"))
    g = tg.marked_groups(rows, pages)
    return g.select("page", "mcid", "owner", "actual", "paint", "native", *[F.round(F.coalesce(F.col("rect")[i], F.lit(-1.0)), 6).alias(c) for i, c in enumerate(("left_", "top", "right_", "bottom"))])


marked_groups_sql = """WITH l AS (SELECT l_orderkey // 64 AS page, l_orderkey % 64 * 10 + 20 AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k, l_partkey FROM lineitem),
b AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN 20 ELSE 8 END AS w, CASE WHEN l_partkey % 3 = 0 THEN 10 ELSE 8 END AS h, k * 100 AS y FROM l),
v AS (SELECT *, least(1, (x + w) / 600) > greatest(0, x / 600) AND least(1, (800 - y) / 800) > greatest(0, (800 - y - h) / 800) AS seen FROM b)
SELECT page, k AS mcid, 7::BIGINT AS owner, l_partkey::VARCHAR AS actual, CASE WHEN seen THEN 'visible' ELSE 'not_visible' END AS paint, seen AND l_partkey % 3 = 0 AS native, CASE WHEN seen THEN round(greatest(0, x / 600), 6) ELSE -1 END::DOUBLE AS left_,
CASE WHEN seen THEN round(greatest(0, (800 - y - h) / 800), 6) ELSE -1 END::DOUBLE AS top, CASE WHEN seen THEN round(least(1, (x + w) / 600), 6) ELSE -1 END::DOUBLE AS right_, CASE WHEN seen THEN round(least(1, (800 - y) / 800), 6) ELSE -1 END::DOUBLE AS bottom FROM v"""


def tagged_values(spark, d):
    """Marked groups of suppliers tied to the cells of their tables: candidates, and a page that could not be read."""
    nodes, kids = _tree(spark, d)
    found = tg.structure(nodes, kids)
    cells = tg.table_cells(found, nodes, kids)
    s = _read(spark, d, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    groups = s.select(F.lit("d").alias("doc"), F.lit(1).alias("page"), k.cast("int").alias("idx"), F.lit(1).alias("owner"), F.when(k % 5 != 0, k.cast("int")).alias("mcid"), F.lit("Span").alias("tag"), F.when(k % 5 == 0, F.concat(F.lit("own "), _s("s_suppkey"))).alias("actual"),
                      F.array(*[F.lit(v) for v in (0.1, 0.1, 0.2, 0.2)]).alias("rect"), F.when(k % 2 == 0, "visible").otherwise("not_visible").alias("paint"), (k % 7 == 0).alias("native"))
    parents = s.select(F.lit("d").alias("doc"), F.lit(1).alias("owner"), k.cast("int").alias("mcid"), F.array(F.concat(F.lit("b"), _s("s_suppkey"))).alias("keys"))
    bad = s.limit(1).select(F.lit("d").alias("doc"), F.lit(2).alias("page"), F.lit("page_unreadable").alias("reason"))
    return tg.tagged_candidates(groups, parents, found, cells, bad).select("page", "id", "ref", "paint", F.array_join("codes", ",").alias("codes"), F.coalesce("value", F.lit("")).alias("value"))


tagged_values_sql = """SELECT 1::BIGINT AS page, printf('vv%04d_%03d', 1, s_suppkey) AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'owner:1;mcid:none;struct:unresolved' ELSE 'owner:1;mcid:' || s_suppkey || ';struct:b' || s_suppkey END AS ref,
CASE WHEN s_suppkey % 2 = 0 THEN 'visible' ELSE 'not_visible' END AS paint, 'marked_content,' || CASE WHEN s_suppkey % 5 = 0 THEN 'missing_mcid' ELSE 'parent_tree_unique,structure_cell' END || ',paint_' || CASE WHEN s_suppkey % 2 = 0 THEN 'visible' ELSE 'not_visible' END AS codes,
CASE WHEN s_suppkey % 5 = 0 THEN 'own ' ELSE 'value ' END || s_suppkey AS value FROM supplier WHERE s_suppkey % 7 <> 0
UNION ALL SELECT 2, 'vv0002_error', NULL, 'unknown', 'collector_error,page_unreadable', ''"""


def visual_status(spark, d):
    """Audit of every supplier's table from the events of its users: which values are there, missing or unresolved."""
    e = _read(spark, d, "events")
    r = F.when(F.col("event_type") == "error", "conflict").when(F.col("event_type") == "purchase", "trusted").when(F.col("event_type") == "view", "already_present").otherwise("skipped")
    c = e.select(F.lit("d").alias("doc"), _s("event_id").alias("id"), r.alias("resolution"), F.lit("informational").alias("semantic"), F.array().cast("array<string>").alias("codes"), (F.col("user_id") + 1).alias("table"), (F.col("event_id") % 3).alias("m"))
    tables = _read(spark, d, "customer").select(F.lit("d").alias("doc"), F.col("c_custkey").alias("table"))
    links = tg.affected(c.withColumn("target", F.when(F.col("m") > 0, F.col("table"))), c.select("doc", "id", F.array("table").alias("tables")))
    return tg.completeness(tables, c, links, "audit").select("table", "status", "why", F.size("candidate_ids").alias("n"), F.size("represented").alias("represented"), F.size("missing").alias("missing"), F.size("unresolved").alias("unresolved"))


visual_status_sql = """WITH e AS (SELECT user_id + 1 AS t, event_type AS y FROM events), s AS (SELECT c_custkey AS t, count(y) AS n, count(y) FILTER (WHERE y = 'view') AS represented, count(y) FILTER (WHERE y = 'purchase') AS missing, count(y) FILTER (WHERE y = 'error') AS unresolved
 FROM customer LEFT JOIN e ON e.t = c_custkey GROUP BY 1)
SELECT t AS "table", CASE WHEN n = 0 THEN 'not_observed' WHEN missing > 0 THEN 'incomplete' WHEN unresolved > 0 THEN 'uncertain' ELSE 'complete' END AS status,
CASE WHEN n = 0 THEN 'no_relevant_visual_candidates' WHEN missing > 0 THEN 'trusted_value_missing_from_grid' WHEN unresolved > 0 THEN 'unresolved_visual_evidence' ELSE 'all_observed_values_represented' END AS why, n, represented, missing, unresolved FROM s"""


def legacy_values(spark, d):
    """Pictures that were placed in the very cell that a value aims at, and agree with it."""
    e = _read(spark, d, "events")
    i = F.col("event_id")
    c = e.select(F.lit("d").alias("doc"), _s("event_id").alias("id"), F.lit("t").alias("table"), i.alias("record"), F.lit(1).alias("col"), F.when(i % 2 == 0, "trusted").otherwise("unresolved").alias("resolution"), F.when(i % 3 != 0, F.col("event_type")).alias("key"))
    ev = e.select(F.lit("d").alias("doc"), _s("event_id").alias("id"), pt.whole(_s("event_id")).alias("picture"), F.when(i % 4 == 0, "view").otherwise(F.col("event_type")).alias("key"))
    at = e.select(F.lit("d").alias("doc"), F.lit("t").alias("table"), i.cast("int").alias("picture"), (i + F.when(i % 5 == 0, 1).otherwise(0)).alias("record"), F.lit(1).alias("col"))
    return tg.legacy_placed(c, at, ev).select("id", "resolution")


legacy_values_sql = """SELECT event_id::VARCHAR AS id, CASE WHEN event_id % 5 <> 0 AND (event_id % 3 = 0 OR (event_id % 2 = 0 AND event_type = CASE WHEN event_id % 4 = 0 THEN 'view' ELSE event_type END)) THEN 'already_present'
WHEN event_id % 2 = 0 THEN 'trusted' ELSE 'unresolved' END AS resolution FROM events"""


# --- states and progress ------------------------------------------------------------------------------------------


def _states(spark, d):
    """Customers as pages that have come to some stage, with a picture and two tables each."""
    c = _read(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("page"))
    k = F.col("page")
    s = st.new_states(c.select(k, k.alias("page_index"), F.lit("a.pdf").alias("pdf_name"), F.lit(10).alias("pdf_size"), F.lit(100).alias("total_pages"), F.lit(200).alias("dpi")))
    pic = F.struct(*[F.lit(v).alias(n) for n, v in (("summary", "a chart"), ("summary_type", "chart"), ("triage_type", "chart"), ("abs_path", ""))]).cast("struct<summary:string,summary_type:string,triage_type:string,abs_path:string>")
    full = {f.name: F.lit(None).cast(f.dataType) for f in s.schema["picture_records"].dataType.elementType.fields}
    picture = F.struct(*[(pic[n] if n in ("summary", "summary_type", "triage_type") else F.concat("page_dir", F.lit("/images/x.png")) if n == "abs_path" else F.map_from_arrays(F.array(F.lit("prompt_tokens"), F.lit("output_tokens")), F.array(k.cast("string"), F.lit("2"))) if n == "usage" else v).alias(n) for n, v in full.items()])
    cand = {f.name: F.lit(None).cast(f.dataType) for f in s.schema["table_candidates"].dataType.elementType.fields}
    table = lambda form: F.struct(*[(F.lit("| a |") if n == "markdown" else F.lit(True) if n == "verified" else F.lit(form) if n == "format" else F.lit("grid_table") if n == "kind" else v).alias(n) for n, v in cand.items()])
    stage = F.get(F.lit(list(st.STAGES)), (k % 8).cast("int"))
    return s.withColumns(
        {"picture_records": F.array(picture), "table_candidates": F.array(table("regular_table"), table("sectioned_table")), "final_markdown": F.lit("final"), "refined_markdown": F.lit("refined"), "raw_markdown": F.lit("raw"), "pre_repair_markdown": F.when(k % 2 == 0, "before").otherwise(""),
         "completed_stage": stage, "status": F.when(k % 8 == 7, "completed").otherwise("ready"), "warnings": F.create_map(F.lit("footnotes"), F.when(k % 3 == 0, "1").otherwise("0")), "pre_repair_warnings": F.create_map(F.lit("old"), F.lit("1")), "visual_values_mode": F.lit("audit")}
    )


def replayed_states(spark, d):
    """What a replay from a stage leaves of each page."""
    out = st.invalidated(_states(spark, d), F.get(F.lit(list(st.STAGES)), (F.col("page") % 5 + 3).cast("int")))
    t = F.col("table_candidates")
    return out.select("page", F.get("picture_records", F.lit(0))["summary"].alias("summary"), F.size(t).alias("tables"), F.coalesce(F.get(t, F.lit(0))["verified"], F.lit(False)).alias("first"), F.coalesce(F.get(t, F.lit(1))["verified"], F.lit(False)).alias("second"), "visual_values_mode", "refined_markdown",
                      "final_markdown", F.array_join(F.map_keys("warnings"), ",").alias("warnings"), "status", "completed_stage")


replayed_states_sql = """WITH s AS (SELECT c_custkey AS page, c_custkey % 8 AS done, c_custkey % 5 + 3 AS start FROM customer), a AS (SELECT *, start <= done AS on_ FROM s),
g AS (SELECT *, ['prepare', 'picture_triage', 'picture_extract', 'table_detect', 'table_extract', 'page_refine', 'page_repair', 'finalize'] AS st FROM a)
SELECT page, 'a chart' AS summary, CASE WHEN on_ AND start = 3 THEN 0 ELSE 2 END::BIGINT AS tables, NOT (on_ AND start <= 4) AS first, NOT (on_ AND start = 3) AS second, CASE WHEN on_ AND start = 3 THEN 'off' ELSE 'audit' END AS visual_values_mode,
CASE WHEN on_ AND start <= 5 THEN '' ELSE 'refined' END AS refined_markdown, CASE WHEN on_ AND start <= 5 THEN '' WHEN on_ AND start = 6 AND page % 2 = 0 THEN 'before' ELSE 'final' END AS final_markdown,
CASE WHEN on_ AND start <= 5 THEN '' WHEN on_ AND start = 6 AND page % 2 = 0 THEN 'old' ELSE 'footnotes' END AS warnings, CASE WHEN on_ THEN 'ready' WHEN done = 7 THEN 'completed' ELSE 'ready' END AS status, CASE WHEN on_ THEN st[start] ELSE st[done + 1] END AS completed_stage FROM g"""


def page_records(spark, d):
    """Stages that ended well, failed or were skipped, in the history of each page; files a replay must not leave; the manifest."""
    s = _states(spark, d)
    k = F.col("page")
    none = F.lit(None).cast("string")
    s = st.with_record(s, F.lit("finalize"), F.when(k % 4 == 0, "fail").otherwise("ok"), F.lit(1.23456), F.create_map(F.lit("prompt_tokens"), F.lit("5")), F.when(k % 4 == 0, "ValueError").otherwise(none), F.when(k % 4 == 0, "no such row").otherwise(none), F.lit(1.0))
    s = st.skipped(st.portable(s), "picture_triage", "off", F.lit(2.0))
    m = st.manifest_rows(s)
    bad = st.failed(s).select("page", F.lit(True).alias("bad"))
    calls = st.usage_calls(s).groupBy("page").agg(F.sum("prompt_tokens").alias("prompt"), F.sum("output_tokens").alias("output"), F.count("*").alias("calls"))
    files = st.downstream_files(s.select("page", F.get(F.lit(list(st.STAGES)), (k % 8).cast("int")).alias("stage"))).groupBy("page").agg(F.count("*").alias("files"))
    h = F.element_at("stage_history", 1)
    path = s.select("page", F.get("picture_records", F.lit(0))["abs_path"].alias("path"))
    out = m.join(bad, "page", "left").join(calls, "page").join(files, "page", "left").join(path, "page")
    return out.select("page", "page_dir", "status", F.coalesce("failure", F.lit("")).alias("failure"), "table_candidate_count", F.array_join("table_candidate_kinds", ",").alias("kinds"), "picture_count", F.size("stage_history").alias("records"), h["elapsed_seconds"].alias("seconds"), F.coalesce("bad", F.lit(False)).alias("bad"),
                      "prompt", "output", "calls", F.coalesce("files", F.lit(0)).alias("files"), "path")


page_records_sql = """SELECT c_custkey AS page, printf('page_%04d', c_custkey) AS page_dir, 'ready' AS status, CASE WHEN c_custkey % 4 = 0 THEN 'ValueError: no such row' ELSE '' END AS failure, 2::BIGINT AS table_candidate_count, 'grid_table' AS kinds, 1::BIGINT AS picture_count, 2::BIGINT AS records,
1.235::DOUBLE AS seconds, c_custkey % 4 = 0 AS bad, c_custkey + 5 AS prompt, 2::BIGINT AS output, 2::BIGINT AS calls, [12, 12, 12, 12, 12, 6, 5, 2][c_custkey % 8 + 1]::BIGINT AS files, 'images/x.png' AS path FROM customer"""


def checkpoint_checks(spark, d):
    """Why the saved state of a page does not fit a run."""
    k = F.col("page")
    s = _states(spark, d).withColumn("schema_version", F.when(k % 7 == 0, 2).otherwise(1)).withColumn("dpi", F.when(k % 5 == 0, 100).otherwise(200))
    row = F.struct(*[F.col(c) for c in ("schema_version", "pdf_name", "pdf_size", "page", "dpi", "page_dir")])
    audit = F.struct(F.lit(True).alias("completed"), F.lit(1).alias("collector_version"), F.lit("audit").alias("mode"), (k % 3).alias("candidate_count"))
    now = ga.audit_is_current(audit, F.lit(1), F.array(F.lit("audit"), F.when(k % 2 == 0, "audit")), F.array(F.lit(1), F.lit(1)), F.lit(True), F.lit("audit"))
    fault = ga.checkpoint_fault(row, F.lit("a.pdf"), F.when(k % 3 == 0, 11).otherwise(10), k, F.lit(200), F.concat(F.lit("/other/root/"), F.when(k % 11 == 0, "page_0000").otherwise(F.col("page_dir")), F.lit("/")))
    return s.select("page", F.coalesce(fault, F.lit("")).alias("fault"), now.alias("current"), ga.is_stale_grid(F.array(F.lit(True)), F.array((k % 6).cast("int"))).alias("stale"))


checkpoint_checks_sql = """SELECT c_custkey AS page, CASE WHEN c_custkey % 7 = 0 THEN 'schema version' WHEN c_custkey % 3 = 0 THEN 'source' WHEN c_custkey % 5 = 0 THEN 'resolution' WHEN c_custkey % 11 = 0 THEN 'page folder' ELSE '' END AS fault,
c_custkey % 3 = 1 AND c_custkey % 2 = 0 AS current, c_custkey % 6 <> 5 AS stale FROM customer"""


def progress_log(spark, d):
    """Events as progress: what is published, what people read, and events that break the contract."""
    e = _read(spark, d, "events")
    k = F.col("event_id")
    rec = e.select(
        "event_id", (k % 50 + F.when(k % 9 == 0, -50).otherwise(1)).cast("int").alias("page"), F.lit(1).alias("page_index"), F.lit(60).alias("total_pages"), F.when(k % 4 == 0, "page").otherwise("table_detect").alias("stage"),
        F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("status"), F.lit(1.5).alias("seconds"), F.create_map(F.lit("rows"), (k % 10).cast("string"), F.lit("note"), F.lit("two words"), F.lit("flag"), F.lit("true")).alias("details"),
        F.when(F.col("event_type") == "error", "ValueError").alias("error_type"),
    )
    return st.progress_events(rec).select("event_id", "payload", "line", F.coalesce("error", F.lit("")).alias("error"))


progress_log_sql = f"""WITH e AS (SELECT event_id AS k, event_type = 'error' AS bad, event_id % 50 + CASE WHEN event_id % 9 = 0 THEN -50 ELSE 1 END AS page FROM events)
SELECT k AS event_id, CASE WHEN page >= 1 THEN '{{"contract":"{co.PROGRESS}","contract_version":"1.0","event":"' || CASE WHEN k % 4 = 0 THEN 'page' ELSE 'page_stage' END || '","status":"' || CASE WHEN bad THEN 'fail' ELSE 'ok' END || '"' || CASE WHEN k % 4 = 0 THEN '' ELSE ',"stage":"table_detect"' END
|| ',"page":' || page || ',"page_index":1,"total_pages":60,"seconds":1.5' || CASE WHEN bad THEN ',"error_type":"ValueError"' ELSE '' END || ',"detail":{{"rows":"' || k % 10 || '","flag":"true"}}}}' END AS payload,
'[1/60 p' || printf('%04d', page) || '] ' || CASE WHEN k % 4 = 0 THEN 'PAGE ' ELSE 'TABLE_DETECT ' END || CASE WHEN bad THEN 'fail' ELSE 'ok' END || ' seconds=1.5 flag=yes note=two_words rows=' || k % 10 AS line, CASE WHEN page < 1 THEN 'page: not from 1' ELSE '' END AS error FROM e"""


def progress_faults(spark, d):
    """Payloads with one fault each: every rule of the progress contract."""
    e = _read(spark, d, "events").select("event_id")
    good = f'"contract":"{co.PROGRESS}","contract_version":"1.0","event":"page_stage","status":"ok","stage":"finalize","page":3,"page_index":1,"total_pages":4,"seconds":1.5'
    forms = [
        "{" + good + "}", "[1]", "not json", "{" + good + ',"extra":1}', '{"contract":"x"}', "{" + good.replace('"page":3', '"page":"3"') + "}", "{" + good.replace("/progress", "/other") + "}", "{" + good.replace('"1.0"', '"2.0"') + "}", "{" + good.replace('"page_stage"', '"nap"') + "}",
        "{" + good.replace('"ok"', '"fine"') + "}", "{" + good.replace('"page":3,', "") + "}", "{" + good.replace('"stage":"finalize",', "") + "}", "{" + good.replace('"total_pages":4', '"total_pages":0') + "}", "{" + good.replace('"page_stage"', '"run"').replace('"page":3,', "") + "}",
        "{" + good.replace('"seconds":1.5', '"seconds":"x"') + "}", "{" + good.replace('"page":3', '"page":2.5') + "}",
    ]
    p = F.get(F.array(*map(F.lit, forms)), (F.col("event_id") % len(forms)).cast("int"))
    return e.select("event_id", F.coalesce(co.progress_error(p), F.lit("")).alias("fault"))


progress_faults_sql = """SELECT event_id, ['', 'not an object', 'not an object', 'unknown key', 'missing key', 'page: wrong type', 'contract', 'version', 'event', 'status', 'page event without page', 'stage event without stage', 'total_pages: not from 1', '', 'seconds: wrong type', 'page: wrong type'][event_id % 16 + 1] AS fault FROM events"""


def edge_texts(spark, d):
    """Short lines at the ends of the pages of a source that stand on three pages or more."""
    docs = _read(spark, d, "documents").where("text is not null and source is not null")
    from ..operators import lines as ln

    lines = ln.to_lines(docs.select("source", "doc_id", "text"), "source", "doc_id")
    edges = st.edge_lines(lines, "source", "doc_id")
    return st.footer_texts(edges, "source", page="doc_id")


edge_texts_sql = r"""WITH l AS (SELECT source, doc_id, unnest(string_split(regexp_replace(text, '\r?\n$', ''), chr(10))) AS line, generate_subscripts(string_split(regexp_replace(text, '\r?\n$', ''), chr(10)), 1) AS pos FROM documents WHERE source IS NOT NULL AND text NOT IN ('', chr(10))),
t AS (SELECT source, doc_id, pos, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM l), f AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY source, doc_id) AS n FROM t WHERE line <> '' WINDOW w AS (PARTITION BY source, doc_id ORDER BY pos)),
e AS (SELECT DISTINCT source, doc_id, regexp_replace(regexp_replace(regexp_replace(lower(line), '\d+', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS norm FROM f WHERE (k <= 3 OR k > n - 3) AND length(line) <= 120 AND NOT regexp_matches(line, '^[#|>!\-*+]|^\d+[.)]\s'))
SELECT source, norm FROM e WHERE norm <> '' GROUP BY 1, 2 HAVING count(*) >= 3"""


# --- maps, regions, grids -----------------------------------------------------------------------------------------


def near_structure(spark, d):
    """For each rectangle, how many others of its page near it are structure."""
    r = lq._rects(spark, d).withColumn("page", F.concat_ws("-", "label", "page")).withColumn("structure", F.col("idx") % 3 == 0).withColumnRenamed("idx", "pos")
    return pm.neighbours(r, "page").select("pos", "structural")


near_structure_sql = f"""WITH {lq.RECTS}, c AS (SELECT label, page, idx, (l + r) / 2 AS x, (t + b) / 2 AS y FROM q)
SELECT a.idx AS pos, count(b.idx) AS structural FROM c a LEFT JOIN c b ON a.label = b.label AND a.page = b.page AND a.idx <> b.idx AND b.idx % 3 = 0 AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.12 GROUP BY a.idx"""


def prompt_tables(spark, d):
    """Verified tables of a region's nations as the block of a prompt."""
    n = _read(spark, d, "nation")
    k = F.col("n_nationkey")
    form = F.get(F.array(*[F.lit(x) for x in ("kpi_list", "sectioned_table", "title_detail_table", "regular_table", "other")]), (k % 5).cast("int"))
    t = F.struct(F.array(F.lit(0.1), F.lit(0.2)).alias("bbox"), F.concat(F.lit("| "), "n_name", F.lit(" |\n")).alias("markdown"), form.alias("format"), (k % 2 == 0).alias("complete"))
    g = n.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", t.alias("t")))), lambda x: x["t"]).alias("tables"))
    text = fp.verified_tables(F.col("tables"))
    return g.select("n_regionkey", text.alias("tables"), fp.fill("a {x} {{b}} {y}", x=F.col("n_regionkey").cast("string"), y=F.lit("{z}")).alias("filled"))


prompt_tables_sql = """WITH t AS (SELECT n_regionkey, n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'Panel of values at [0.1, 0.2]; keep it as a list, never as a table:' WHEN 1 THEN 'Table at [0.1, 0.2] in titled parts with the same header each; keep all parts in order, each under its heading:'
WHEN 2 THEN 'Table at [0.1, 0.2]; first cells join a title and its detail by <br>; keep them whole, and the one header row:' WHEN 3 THEN 'Table at [0.1, 0.2]; keep it as one table with its one header row:' ELSE 'Table at [0.1, 0.2]:' END || chr(10) || '| ' || n_name || ' |' AS part FROM nation)
SELECT n_regionkey::BIGINT AS n_regionkey, coalesce(string_agg(part, chr(10) || chr(10) ORDER BY n_nationkey) FILTER (WHERE n_nationkey % 2 = 0), '(none)') AS tables, 'a ' || n_regionkey || ' {b} {z}' AS filled FROM t GROUP BY n_regionkey"""


def region_tables(spark, d):
    """Orders as regions: a row for each line, a label and two values in it; three rows make a table."""
    li = _read(spark, d, "lineitem")
    li = li.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    y = F.col("k") * 0.06
    cell = lambda c, x, text: F.struct(F.lit(c).alias("c"), F.array(F.lit(x), y, F.lit(x + 0.08), y + 0.02).alias("rect"), text.alias("text"))
    three = F.array(cell(0, 0.1, F.concat(F.lit("Label of line "), F.when(F.col("l_linenumber") > 0, F.lit("x")))), cell(1, 0.25, F.concat(_s("l_partkey"), F.lit("%"))), cell(2, 0.4, F.concat(F.lit("€ "), _s("l_suppkey"))))
    cells = li.select("l_orderkey", "k", F.explode(three).alias("x")).select("l_orderkey", (F.col("k") * 10 + F.col("x.c")).alias("idx"), "x.rect", "x.text", F.lit(False).alias("is_heading"))
    return lo.region_scores(cells, "l_orderkey").select("l_orderkey", "score", "reject", "cells", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("columns", "aligned_rows", "value_columns")])


region_tables_sql = """WITH o AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN n >= 3 THEN 0.95 ELSE 0.0 END::DOUBLE AS score, CASE WHEN n = 1 THEN 'too_few_cells' WHEN n = 2 THEN 'not_enough_columns' END AS reject, 3 * n AS cells, CASE WHEN n >= 3 THEN 3 ELSE 0 END::BIGINT AS columns, CASE WHEN n >= 3 THEN n ELSE 0 END AS aligned_rows, CASE WHEN n >= 3 THEN 2 ELSE 0 END::BIGINT AS value_columns FROM o"""


def region_search(spark, d):
    """Tables of the source, regions found on the page, and pictures, as numbered candidates: two panels side by side, of which the left
    one is a table."""
    k = _read(spark, d, "orders").select(F.col("o_orderkey").alias("page"))
    k = k.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page")  # pages of few files, evaluated by many tasks
    cell = lambda i, rect, text: F.struct(F.lit(i).alias("idx"), F.array(*[F.lit(v) for v in rect]).alias("rect"), F.lit(text).alias("text"), F.lit(False).alias("is_heading"))
    spots = [cell(10 * r + c, (0.1 + 0.1 * c, 0.1 + 0.06 * r, 0.19 + 0.1 * c, 0.12 + 0.06 * r), ("Label text here", "12%", "€ 3")[c]) for r in range(4) for c in range(3)]
    prose = [cell(100 + i, (0.6, 0.1 + 0.08 * i, 0.9, 0.17 + 0.08 * i), "long prose " * 25) for i in range(7)]
    found, _, _ = lo.evaluate_pages(k.select("page", F.array(*spots, *prose).alias("cells")), "page")
    box = lambda a: F.array(*[F.lit(v) for v in a])
    tables = k.where("page % 3 = 0").select("page", F.lit(0).alias("pos"), box((0.1, 0.1, 0.4, 0.35)).alias("rect"))
    pictures = k.where("page % 2 = 0").select("page", F.lit(4).alias("picture"), box((0.1, 0.7, 0.5, 0.9)).alias("rect"), F.lit("semantic_label").alias("reason"), F.lit(0.7).alias("confidence"))
    c = lo.table_candidates(tables, found, pictures, "page")
    return lo.symbols_in(c, pictures, "page").select("page", "id", "kind", "confidence", "reason", F.coalesce(F.size("symbols"), F.lit(0)).alias("symbols"))


region_search_sql = """WITH o AS (SELECT o_orderkey AS page FROM orders), c AS (SELECT page, 0 AS g, 'grid_table' AS kind, 0.95 AS confidence, 'table_item' AS reason, 0 AS symbols FROM o WHERE page % 3 = 0
UNION ALL SELECT page, 1, 'layout_region', 0.95, 'table_shaped_region', 0 FROM o WHERE page % 3 <> 0 UNION ALL SELECT page, 2, 'picture_table', 0.7, 'semantic_label', 1 FROM o WHERE page % 2 = 0)
SELECT page, printf('tc%03d', row_number() OVER (PARTITION BY page ORDER BY g)) AS id, kind, confidence::DOUBLE AS confidence, reason, symbols::BIGINT AS symbols FROM c"""


def source_lines(spark, d):
    """Words of a page joined to lines, and its strokes to rules."""
    li = _read(spark, d, "lineitem")
    li = li.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    x = F.col("k") * 20.0
    w = li.select(F.col("l_orderkey").alias("page"), (F.col("k") % 2).alias("block"), F.lit(0).alias("line"), F.col("k").alias("word"), _s("l_partkey").alias("text"), x.alias("x0"), F.lit(10.0).alias("y0"), (x + 15).alias("x1"), F.lit(20.0).alias("y1"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"))
    lines = rc.page_lines(w)
    strokes = li.select(F.col("l_orderkey").alias("page"), (x * 3).alias("x0"), F.lit(100.0).alias("y0"), (x * 3 + 55).alias("x1"), F.lit(102.0).alias("y1"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"))
    rules = rc.dividers(strokes).groupBy("page").agg(F.count("*").alias("rules"), F.round(F.max("hi"), 6).alias("reach"))
    return lines.join(rules, "page").select("page", "block", "text", F.round(F.col("rect")[0], 6).alias("left_"), F.round(F.col("rect")[2], 6).alias("right_"), "rules", "reach")


source_lines_sql = """WITH l AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k, l_partkey FROM lineitem), r AS (SELECT page, max(k) AS m FROM l GROUP BY 1)
SELECT page, k % 2 AS block, string_agg(l_partkey::VARCHAR, ' ' ORDER BY k) AS text, round(min(k) * 20 / 600, 6) AS left_, round((max(k) * 20 + 15) / 600, 6) AS right_, 1::BIGINT AS rules, round(max(m * 60 + 55) / 600, 6) AS reach FROM l JOIN r USING (page) GROUP BY page, k % 2"""


def grid_reconciled(spark, d):
    """Suppliers of a nation as grids whose last rows were torn in two: the page's rules put them together again, where there are rules.
    A nation has as many pages as it needs for GRID_ROWS suppliers on each: thinner rows would have rules nearer than those of one line."""
    s = _read(spark, d, "supplier")
    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    s = s.select(F.col("s_nationkey").alias("nation"), (n - 1).alias("k"), F.concat(F.lit("supplier "), _s("s_suppkey")).alias("name"), _s("s_suppkey").alias("key"))
    s = s.withColumn("sheet", F.floor(F.col("k") / GRID_ROWS).cast("int")).withColumn("k", F.col("k") % GRID_ROWS)
    s = s.withColumn("n", F.count("*").over(Window.partitionBy("nation", "sheet"))).withColumn("page", F.struct("nation", "sheet"))
    h = F.lit(0.8) / F.col("n")
    top = F.lit(0.2) + F.col("k") * h
    tables = s.select("page").distinct().withColumn("table", F.lit("t")).withColumn("rect", F.array(*[F.lit(v) for v in (0.0, 0.0, 1.0, 1.0)]))
    rect = lambda x0, x1, y0, y1: F.array(F.lit(x0), y0, F.lit(x1), y1)
    cell = lambda c, text, x0, x1, r, y0, y1, head=False: F.struct(r.alias("r"), F.lit(c).alias("c"), text.alias("text"), rect(x0, x1, y0, y1).alias("rect"), F.lit(head).alias("header"))
    mid = top + h * 0.3
    last = (F.col("k") == F.col("n") - 1) & (F.col("nation") % 2 == 0)
    whole = F.array(cell(0, F.col("name"), 0.0, 0.4, F.col("k") + 1, top, top + h * 0.6), cell(1, F.col("key"), 0.5, 0.9, F.col("k") + 1, top, top + h * 0.6))
    torn = F.array(cell(0, F.lit("supplier"), 0.0, 0.4, F.col("k") + 1, top, mid), cell(1, F.lit(""), 0.5, 0.9, F.col("k") + 1, top, mid), cell(0, F.col("key"), 0.0, 0.4, F.col("k") + 2, mid, top + h * 0.6), cell(1, F.col("key"), 0.5, 0.9, F.col("k") + 2, mid, top + h * 0.6))
    body = s.select("page", F.explode(F.when(last, torn).otherwise(whole)).alias("x")).select("page", "x.*")
    heads = s.select("page").distinct().select("page", F.explode(F.array(*[F.struct(F.lit(0).cast("int").alias("r"), F.lit(c).alias("c"), F.lit(t).alias("text"), F.array(*[F.lit(v) for v in (x, 0.05, x + 0.4, 0.15)]).alias("rect"), F.lit(True).alias("header")) for c, t, x in ((0, "Name", 0.0), (1, "Key", 0.5))])).alias("x")).select("page", "x.*")
    none = F.lit(None).cast("int")
    cells = body.unionByName(heads).withColumn("table", F.lit("t")).withColumn("r", F.col("r").cast("int")).withColumns({c: none for c in ("row0", "row1", "col0", "col1")})
    lines = s.select("page", (F.col("k") * 2).cast("int").alias("block"), F.lit(0).alias("line"), F.col("name").alias("text"), rect(0.02, 0.38, top + h * 0.1, top + h * 0.5).alias("rect")).unionByName(
        s.select("page", (F.col("k") * 2 + 1).cast("int").alias("block"), F.lit(0).alias("line"), F.col("key").alias("text"), rect(0.52, 0.88, top + h * 0.1, top + h * 0.5).alias("rect"))
    )
    ruled = s.where("nation % 3 != 0")
    rules = ruled.select("page", F.explode(F.array(top, top + h)).alias("y"), F.lit(0.0).alias("x0"), F.lit(1.0).alias("x1")).distinct()
    verdicts, grids = rc.reconcile(tables, cells, rules, lines)
    rows = grids.groupBy(F.col("page.nation").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page.sheet", "r", "cells"))), lambda x: F.array_join(x["cells"], "|")), "/").alias("body"))
    verdicts = verdicts.select(F.col("page.nation").alias("page"), "status", F.coalesce("reason", F.lit("")).alias("reason")).distinct()
    return verdicts.join(rows, "page", "left").select("page", "status", "reason", F.coalesce("body", F.lit("")).alias("body"))


grid_reconciled_sql = """WITH s AS (SELECT s_nationkey::BIGINT AS page, string_agg('supplier ' || s_suppkey || '|' || s_suppkey, '/' ORDER BY s_suppkey) AS body FROM supplier GROUP BY 1)
SELECT page, CASE WHEN page % 3 = 0 OR page % 2 = 1 THEN 'unchanged' ELSE 'repaired' END AS status, CASE WHEN page % 3 = 0 THEN 'no_rule_bands' WHEN page % 2 = 1 THEN 'raw_matches_rules' ELSE '' END AS reason, CASE WHEN page % 3 <> 0 AND page % 2 = 0 THEN body ELSE '' END AS body FROM s"""


def grid_places(spark, d):
    """Rectangles of all places of a grid of three by three of which the diagonal is known."""
    r = _read(spark, d, "region").select(F.col("r_regionkey").alias("page"))
    known = r.select("page", F.lit("t").alias("table"), F.explode(F.array(*[F.struct(F.lit(i).alias("r"), F.lit(i).alias("c"), F.array(*[F.lit(v) for v in (0.1 * i, 0.2 * i, 0.1 * i + 0.1, 0.2 * i + 0.2)]).alias("rect")) for i in (0, 2)])).alias("x")).select("page", "table", "x.*")
    size = r.select("page", F.lit("t").alias("table"), F.lit(3).alias("rows"), F.lit(3).alias("cols"), F.array(*[F.lit(v) for v in (0.0, 0.0, 0.3, 0.6)]).alias("rect"))
    out = rc.grid_rects(known, size)
    return out.select("page", "r", "c", *[F.round(F.col("rect")[i], 6).alias(n) for i, n in enumerate(("left_", "top", "right_", "bottom"))])


grid_places_sql = """SELECT r_regionkey::BIGINT AS page, r, c, round(0.1 * c, 6)::DOUBLE AS left_, round(0.2 * r, 6)::DOUBLE AS top, round(0.1 * c + 0.1, 6)::DOUBLE AS right_, round(0.2 * r + 0.2, 6)::DOUBLE AS bottom FROM region, (SELECT unnest([0, 1, 2])::BIGINT AS r), (SELECT unnest([0, 1, 2])::BIGINT AS c)"""


def symbol_order(spark, d):
    """Symbols of a cell from the top down, and from left to right in a row."""
    li = _read(spark, d, "lineitem")
    li = li.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    k = F.col("k")
    y, x = F.expr("(k div 3) * 0.1").cast("double") + (k % 3) * 0.001, F.lit(0.9) - (k % 3) * 0.2
    s = li.select("l_orderkey", k.cast("bigint").alias("id"), F.array(x, y, x + 0.05, y + 0.05).alias("rect"))
    return rc.in_reading_order(s, "l_orderkey").select("l_orderkey", "id", "place")


symbol_order_sql = """WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)
SELECT l_orderkey, k AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY k // 3, k % 3 DESC) AS place FROM l"""


def repair_lines(spark, d):
    """What a repair is told about each supplier's page: lines, and symbols without a place, each once."""
    k = F.col("s_suppkey")
    lines = F.array(F.col("s_name"), F.col("s_name"), F.lit("other"))
    out = ga.repair_lines(lines, F.array(F.lit("E1 "), F.lit("S2")), F.array(k, k + 1))
    return _read(spark, d, "supplier").select("s_suppkey", F.array_join(out, "|").alias("lines"), F.size(sy.value_tokens(F.lit("x y"))).alias("n"))


repair_lines_sql = "SELECT s_suppkey, s_name || '|other|table symbol picture_index=' || s_suppkey || ' value=E1 is not placed|table symbol picture_index=' || (s_suppkey + 1) || ' value=S2 is not placed' AS lines, 2::BIGINT AS n FROM supplier"

NAMES = (
    "paint_space", "pdf_strings", "structure_cells", "parent_entries", "marked_groups", "tagged_values", "visual_status", "legacy_values", "replayed_states", "page_records", "checkpoint_checks", "progress_log", "progress_faults", "edge_texts",
    "near_structure", "prompt_tables", "region_tables", "region_search", "source_lines", "grid_reconciled", "grid_places", "symbol_order", "repair_lines",
)
