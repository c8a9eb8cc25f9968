"""Queries over pipe tables, rendered inside the query from the relational tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import lines as ln
from ..operators import tables as tb
from .text_queries import sql_lines, sql_numbers, sql_strip, sql_ws


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _number(*order):
    from pyspark.sql import Window

    return Window.partitionBy("t").orderBy(*order)


def _nation_rows(spark, d):
    """One table a region: header and a row for each nation."""
    n = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = n.select(F.col("r_name").alias("t"), F.row_number().over(_number_by("r_name", "n_nationkey")).alias("r"), F.array("n_name", F.col("n_nationkey").cast("string")).alias("cells"))
    head = _read(spark, d, "region").select(F.col("r_name").alias("t"), F.lit(0).alias("r"), F.array(F.lit("Nation"), F.lit("Key")).alias("cells"))
    return body.unionByName(head)


def _number_by(key, *order):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


NATION = """nr AS (SELECT r_name AS t, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS r, [n_name, n_nationkey::VARCHAR] AS cells FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name, 0, ['Nation', 'Key'] FROM region)"""


def pipe_render(spark, d):
    return tb.render(_nation_rows(spark, d), "t")


pipe_render_sql = f"""WITH {NATION} SELECT t, string_agg('| ' || array_to_string(cells, ' | ') || ' |' || CASE WHEN r = 0 THEN chr(10) || '| --- | --- |' ELSE '' END, chr(10) ORDER BY r) AS markdown FROM nr GROUP BY t"""


def pipe_parse(spark, d):
    """Rendered tables read back as cells."""
    md = tb.render(_nation_rows(spark, d), "t")
    rows = tb.rows_of(ln.to_lines(md, "t", text="markdown"), "t")
    return rows.select("t", "r", F.array_join("cells", "|").alias("cells"))


pipe_parse_sql = f"WITH {NATION} SELECT t, r, array_to_string(cells, '|') AS cells FROM nr"


def _part_lines(spark, d):
    """Parts by brand as ragged pipe rows: name, type and size, the size left off every third row."""
    p = _read(spark, d, "part")
    n = F.row_number().over(_number_by("p_brand", "p_partkey"))
    line = F.concat(F.lit("| "), "p_name", F.lit(" | "), "p_type", F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit(" | "), F.col("p_size").cast("string"))), F.lit(" |"))
    return p.select(F.col("p_brand").alias("t"), (n - 1).alias("pos"), line.alias("line"))


PARTS = """pl AS (SELECT p_brand AS t, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, '| ' || p_name || ' | ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' | ' || p_size END || ' |' AS line,
  [p_name, p_type] || CASE WHEN p_partkey % 3 = 0 THEN [] ELSE [p_size::VARCHAR] END AS cells FROM part)"""


def pipe_normalize(spark, d):
    return tb.normalize(_part_lines(spark, d), "t")


pipe_normalize_sql = f"""WITH {PARTS}, w AS (SELECT *, max(len(cells)) OVER (PARTITION BY t) AS width, count(*) OVER (PARTITION BY t) AS n FROM pl)
SELECT t, pos, 0::BIGINT AS part, CASE WHEN n >= 2 THEN '| ' || array_to_string(cells || list_resize([]::VARCHAR[], width - len(cells), ''), ' | ') || ' |' ELSE line END AS line FROM w
UNION ALL SELECT t, pos, 1, '|' || repeat('---|', width::BIGINT) FROM w WHERE pos = 0 AND n >= 2"""


def _kpi_rows(spark, d):
    """Panels of order values over captions: a value row and a label row for each status."""
    o = _read(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    o = o.withColumn("label", F.concat(F.lit("ORDERS OF "), F.upper(F.regexp_replace("o_orderpriority", "[^A-Za-z]", " ")), F.lit(" CLASS")))
    g = o.groupBy(F.col("o_orderstatus").alias("t")).agg(F.array_sort(F.collect_list(F.struct("label", F.col("n").cast("string").alias("v")))).alias("x"))
    return g.select("t", F.explode(F.array(F.struct(F.lit(0).alias("r"), F.transform("x", lambda y: y["v"]).alias("cells")), F.struct(F.lit(1).alias("r"), F.transform("x", lambda y: tx.collapse_ws(y["label"])).alias("cells")))).alias("z")).select("t", "z.*")


KPI = """k AS (SELECT o_orderstatus AS t, regexp_replace(trim('ORDERS OF ' || upper(regexp_replace(o_orderpriority, '[^A-Za-z]', ' ', 'g')) || ' CLASS'), '\\s+', ' ', 'g') AS label, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)"""


def kpi_stats(spark, d):
    return tb.panel_stats(_kpi_rows(spark, d), "t")


kpi_stats_sql = f"""WITH {KPI} SELECT t, 2::BIGINT AS n_rows, count(*) AS n_cols, 2 * count(*) AS non_empty, count(*) AS value_cells, count(*) AS label_cells, 0::BIGINT AS long_cells, true AS alternating, 1.0 AS signal_ratio,
count(*) BETWEEN 3 AND 6 AS panel FROM k GROUP BY t"""


def kpi_lists(spark, d):
    return tb.panel_lists(_kpi_rows(spark, d), "t")


kpi_lists_sql = f"""WITH {KPI}, c AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY label) AS pos, count(*) OVER (PARTITION BY t) AS m FROM k) SELECT t, pos, '- ' || label || ': ' || n AS line FROM c WHERE m BETWEEN 3 AND 6"""


def kpi_text_pairs(spark, d):
    """The same values and captions as loose lines under each other."""
    r = _kpi_rows(spark, d)
    flat = r.select("t", "r", F.posexplode("cells").alias("c", "line"))
    return tb.text_pairs(flat.select("t", (2 * F.col("c") + F.col("r")).alias("pos"), "line"), "t").select("t", "pair", "line")


kpi_text_pairs_sql = f"""WITH {KPI}, c AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY label) - 1 AS pair, count(*) OVER (PARTITION BY t) AS m, bool_and(regexp_matches(n::VARCHAR, '^(19|20)[0-9][0-9]$')) OVER (PARTITION BY t) AS years FROM k)
SELECT t, pair, '- ' || label || ': ' || n AS line FROM c WHERE m >= 2 AND NOT years"""


def _banded(spark, d):
    """One table: a header, and each region as a banner over its nations."""
    n = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = n.select((F.col("r_regionkey") * 1000 + F.col("n_nationkey") + 2).alias("o"), F.array("n_name", F.col("n_nationkey").cast("string"), F.lit("x")).alias("cells"))
    bands = _read(spark, d, "region").select((F.col("r_regionkey") * 1000 + 1).alias("o"), F.array(F.col("r_name"), F.lit(""), F.lit("")).alias("cells"))
    head = _read(spark, d, "region").where("r_regionkey = 0").select(F.lit(-1).alias("o"), F.array(F.lit("Nation"), F.lit("Key"), F.lit("Note")).alias("cells"))
    u = body.unionByName(bands).unionByName(head).withColumn("t", F.lit(1))
    return u.select("t", (F.row_number().over(_number_by("t", "o")) - 1).alias("r"), "cells")


def sectioned_split(spark, d):
    return tb.split_sections(_banded(spark, d), "t").select("section", "title", F.array_join("cells", "|").alias("cells"))


sectioned_split_sql = """SELECT (row_number() OVER (PARTITION BY n_nationkey IS NULL ORDER BY 1) * 0 + dense_rank() OVER (ORDER BY r_regionkey)) AS section, r_name AS title, n_name || '|' || n_nationkey || '|x' AS cells
FROM nation JOIN region ON n_regionkey = r_regionkey"""


def title_detail(spark, d):
    """Parts by brand as title rows with a detail row under each."""
    p = _read(spark, d, "part")
    two = F.array(F.struct(F.lit(0).alias("h"), F.array(F.col("p_name"), F.lit("")).alias("cells")), F.struct(F.lit(1).alias("h"), F.array(F.col("p_type"), F.col("p_size").cast("string")).alias("cells")))
    rows = p.select(F.col("p_brand").alias("t"), "p_partkey", F.explode(two).alias("x")).select("t", F.row_number().over(_number_by("t", "p_partkey", "x.h")).alias("r"), "x.cells")
    return tb.title_detail(rows, "t")


title_detail_sql = """SELECT p_brand AS t, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS record, p_name || '<br>' || p_type || '|' || p_size AS cells, true AS merged FROM part"""


def dup_subset_tables(spark, d):
    """Suppliers of each nation rendered twice, once without the balance: the narrower table is a subset."""
    s = _read(spark, d, "supplier")
    wide = s.select(F.col("s_nationkey").alias("doc"), F.lit(1).alias("tab"), F.array("s_name", F.col("s_suppkey").cast("string"), F.lit("b")).alias("cells"))
    thin = s.select(F.col("s_nationkey").alias("doc"), F.lit(2).alias("tab"), F.array("s_name", F.col("s_suppkey").cast("string")).alias("cells"))
    return tb.subset_tables(wide.unionByName(thin), "doc", "tab")


dup_subset_tables_sql = "SELECT DISTINCT s_nationkey::BIGINT AS doc, 2::BIGINT AS tab, 1::BIGINT AS other FROM supplier"


def verify_table(spark, d):
    """Transcriptions of each region's table: as it is, with a number changed, or with rows lost, in turn."""
    rows = _nation_rows(spark, d)
    md = tb.render(rows, "t")
    cells = rows.select("t", F.explode("cells").alias("cell")).groupBy("t").agg(F.collect_list("cell").alias("cells"))
    regions = _read(spark, d, "region").select(F.col("r_name").alias("t"), "r_regionkey")
    j = md.join(cells, "t").join(regions, "t")
    m = F.when(F.col("r_regionkey") % 3 == 1, F.concat("markdown", F.lit("\n| x | 9999 |"))).when(F.col("r_regionkey") % 3 == 2, F.substring_index("markdown", "\n", 3)).otherwise(F.col("markdown"))
    return tb.verify(j.withColumn("markdown", m)).select("t", "verified", "reason")


verify_table_sql = r"""WITH n AS (SELECT r_name AS t, r_regionkey AS k, count(*) AS rows, list(DISTINCT x) AS numbers, list(DISTINCT x) FILTER (WHERE o = 1) AS first FROM
 (SELECT r_name, r_regionkey, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS o, unnest(regexp_extract_all(n_name || ' ' || n_nationkey, '\d+')) AS x FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY ALL)
SELECT t, k % 3 = 0 OR (k % 3 = 2 AND len(list_intersect(numbers, first)) >= 0.9 * len(numbers)) AS verified, CASE WHEN k % 3 = 1 THEN 'invented_numbers' WHEN k % 3 = 2 AND len(list_intersect(numbers, first)) < 0.9 * len(numbers) THEN 'missing_numbers' END AS reason FROM n"""


def layout_tables(spark, d):
    """Conversations as tables of role and text, a row a turn: which are prose in disguise?"""
    c = _read(spark, d, "conversations")
    rows = c.select("conv_id", F.col("turn").alias("r"), F.array(F.col("role"), tx.escape_cell(F.col("text"))).alias("cells"))
    return tb.layout_tables(rows, "conv_id")


layout_tables_sql = rf"""WITH c AS (SELECT conv_id, role, replace({sql_ws("coalesce(text, '')")}, '|', '\|') AS x FROM conversations), s AS (SELECT conv_id, count(*) AS n,
  max(greatest(length(role), length(x))) AS longest, sum(length(role) + length(x)) AS chars, sum((role <> '')::INT + (x <> '')::INT) AS filled FROM c GROUP BY conv_id)
SELECT conv_id, CASE WHEN n <= 4 AND (longest > 200 OR chars > 120 * filled) THEN 'unwrap' ELSE 'table' END AS kind FROM s"""


def _toc(spark, d):
    """Contents pages: each brand's parts as rows of number, title and page.  A page holds 20 parts; a brand's further pages
    are named after it with their number."""
    p = _read(spark, d, "part")
    n = F.row_number().over(_number_by("p_brand", "p_partkey"))
    p = p.select("p_brand", (n - 1).alias("at"), "p_name", "p_partkey").withColumn("page", F.expr("at div 20 + 1")).withColumn("n", F.col("at") % 20 + 1)
    p = p.withColumn("t", F.when(F.col("page") == 1, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit(" ("), "page", F.lit(")"))))
    raw = p.select("t", F.col("n").alias("pos"), F.concat(F.lit("| 2."), "n", F.lit(" | "), "p_name", F.lit(" "), "p_partkey", F.lit(" | "), (F.col("n") * 3).cast("string"), F.lit(" |")).alias("line"))
    own = p.select("t", F.col("n").alias("pos"), F.concat("n", F.lit(". "), "p_name", F.lit(" "), "p_partkey").alias("line"))
    return raw, own


def toc_detect(spark, d):
    return ln.toc_pages(_toc(spark, d)[0], "t").select("t", "numbered", "toc")


CONTENTS = """at_ AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part),
pg AS (SELECT *, CASE WHEN k < 20 THEN p_brand ELSE p_brand || ' (' || (k // 20 + 1) || ')' END AS t, k % 20 + 1 AS n FROM at_)"""
toc_detect_sql = f"WITH {CONTENTS} SELECT t, count(*) AS numbered, count(*) >= 8 AS toc FROM pg GROUP BY t"


def toc_numbers(spark, d):
    raw, own = _toc(spark, d)
    return ln.restore_toc_numbers(own, raw, "t")


# titles of a page that is no contents page keep their numbers in order
toc_numbers_sql = f"""WITH {CONTENTS} SELECT t, n AS pos, '- 2.' || n || ' ' || p_name || ' ' || p_partkey AS line FROM pg"""


def footnotes(spark, d):
    """Orders as pages: returned lines define a note, all others refer to one."""
    li = _read(spark, d, "lineitem")
    mark = F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit("] "))
    line = F.when(F.col("l_returnflag") == "R", F.concat(mark, F.lit("part "), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.lit("see "), mark))
    lines = li.select("l_orderkey", F.col("l_linenumber").alias("pos"), line.alias("line"))
    out = ln.footnotes(lines, "l_orderkey")
    return out.select("l_orderkey", *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("refs", "defs", "duplicates", "undefined", "gaps")])


footnotes_sql = """WITH l AS (SELECT l_orderkey, l_linenumber::VARCHAR AS k, l_returnflag = 'R' AS d FROM lineitem),
a AS (SELECT l_orderkey, coalesce(list_sort(list(DISTINCT k) FILTER (WHERE NOT d)), []) AS refs, coalesce(list_sort(list(DISTINCT k) FILTER (WHERE d)), []) AS defs FROM l GROUP BY l_orderkey),
u AS (SELECT l_orderkey, list_sort(list(k)) AS dup FROM (SELECT l_orderkey, k FROM l WHERE d GROUP BY ALL HAVING count(*) > 1) GROUP BY l_orderkey)
SELECT a.l_orderkey, array_to_string(refs, ',') AS refs, array_to_string(defs, ',') AS defs, coalesce(array_to_string(dup, ','), '') AS duplicates, array_to_string(list_filter(refs, lambda x: NOT list_contains(defs, x)), ',') AS undefined,
coalesce(array_to_string(list_filter(range(list_min(list_transform(defs, lambda x: x::INT)), list_max(list_transform(defs, lambda x: x::INT)) + 1), lambda x: NOT list_contains(defs, x::VARCHAR)), ','), '') AS gaps
FROM a LEFT JOIN u USING (l_orderkey)"""

NAMES = (
    "pipe_render", "pipe_parse", "pipe_normalize", "kpi_stats", "kpi_lists", "kpi_text_pairs", "sectioned_split", "title_detail", "dup_subset_tables", "verify_table", "layout_tables",
    "toc_detect", "toc_numbers", "footnotes",
)
