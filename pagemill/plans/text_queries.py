"""Queries over texts, lines, blocks and web pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import furniture as fu
from ..operators import lines as ln
from ..sources import html

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)


def sql_strip(x: str) -> str:
    return STRIP.format(x)


def sql_ws(x: str) -> str:
    return sql_strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def sql_words(x: str) -> str:
    raw = f"list_transform(regexp_extract_all(lower({x}), '{tx.SIGNIFICANT}'), lambda w: regexp_replace(w, '^[.,]+|[.,]+$', '', 'g'))"
    return f"list_filter({raw}, lambda w: (length(w) >= 4 OR regexp_matches(w, '[0-9]')) AND w NOT IN ({STOP}))"


def sql_numbers(x: str) -> str:
    return rf"list_distinct(list_transform(regexp_extract_all({x}, '\d+(?:[.,]\d+)*'), lambda t: replace(t, ',', '.')))"


def sql_furniture(x: str) -> str:
    return sql_ws(rf"regexp_replace(lower({x}), '\d+', ' ', 'g')")


def sql_lines(table: str, key: str, text: str = "text") -> str:
    parts = rf"string_split(regexp_replace({text}, '\r?\n$', ''), chr(10))"
    return f"SELECT {key}, unnest({parts}) AS line, generate_subscripts({parts}, 1) - 1 AS pos FROM {table} WHERE coalesce({text}, '') NOT IN ('', chr(10))"


LINES = f"lines AS ({sql_lines('documents', 'doc_id')})"


def _docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def _lines(spark, d):
    return ln.to_lines(_docs(spark, d), "doc_id")


def _blocks(spark, d):
    spread = _docs(spark, d).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return ln.blocks(ln.to_lines(spread, "doc_id"), "doc_id")


BLOCKS = rf"""{LINES}, blocks AS (SELECT doc_id, pos * 2 AS pos, line, {sql_ws('lower(line)')} AS norm FROM lines WHERE {sql_strip('line')} <> '' AND NOT starts_with(ltrim(line), '|') AND NOT regexp_matches(line, '^#{{1,6}}\s+'))"""


def repeated_lines(spark, d):
    return ln.repeated_lines(_lines(spark, d), "doc_id")


repeated_lines_sql = rf"""
WITH {LINES}, t AS (SELECT doc_id, pos, {sql_strip('line')} AS line FROM lines),
r AS (SELECT *, regexp_matches(line, '^\|?[\s|:-]+\|?$') AS rule FROM t),
u AS (SELECT *, coalesce(lead(rule) OVER (PARTITION BY doc_id ORDER BY pos), false) AS under FROM r),
c AS (SELECT doc_id, line, count(*) AS n FROM u WHERE NOT rule AND NOT (under AND starts_with(line, '|')) AND length(line) > 20 GROUP BY ALL),
s AS (SELECT doc_id, sum(n)::BIGINT AS total, count(*) AS dist, max(n) AS most FROM c GROUP BY doc_id)
SELECT doc_id, total, round(1 - dist / total, 3) AS repeated_ratio, (total >= 8 AND 1 - dist / total > 0.5) OR most >= 5 AS anomalous FROM s"""


def duplicate_paragraphs(spark, d):
    return ln.duplicate_paragraphs(_blocks(spark, d), "doc_id")


duplicate_paragraphs_sql = f"""
WITH {BLOCKS}, c AS (SELECT doc_id, norm, count(*) AS n FROM blocks WHERE length(norm) >= 80 GROUP BY ALL)
SELECT doc_id, sum(n - 1)::BIGINT AS duplicates FROM c GROUP BY doc_id"""


def collapse_duplicates(spark, d):
    return ln.collapse_duplicates(_blocks(spark, d), "doc_id").where("kind = 'text'").select("doc_id", "pos", "norm")


collapse_duplicates_sql = f"""
WITH {BLOCKS}, e AS (SELECT *, length(norm) >= 80 OR len(string_split(norm, ' ')) >= 15 AS eligible FROM blocks),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, norm, eligible ORDER BY pos) AS nth FROM e),
f AS (SELECT * FROM r WHERE eligible AND nth = 1 AND length(norm) >= 80)
SELECT doc_id, pos, norm FROM r WHERE NOT (eligible AND nth > 1) AND NOT (eligible AND length(norm) >= 80 AND EXISTS
  (SELECT 1 FROM f WHERE f.doc_id = r.doc_id AND f.pos < r.pos AND f.norm <> r.norm AND suffix(f.norm, r.norm)))"""


def furniture_norm(spark, d):
    t = _lines(spark, d).select(tx.furniture_text(F.col("line")).alias("norm")).where("norm != ''")
    return t.groupBy("norm").agg(F.count("*").alias("n")).where("n > 1")


furniture_norm_sql = f"WITH {LINES} SELECT {sql_furniture('line')} AS norm, count(*) AS n FROM lines GROUP BY 1 HAVING count(*) > 1 AND norm <> ''"


def _site():
    return F.regexp_extract(F.regexp_extract(F.lower("url"), r"://([^/?#]*)", 1), r"([^.]+\.[^.]+)$", 1)


def _items(spark, d):
    return html.items(spark.read.parquet(f"{d}/pages.parquet"), doc=_site())


def _entries(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").select(_site().alias("doc"), F.col("page_id").alias("page"))
    return _items(spark, d), pages


_ENT = "html"
for _a, _b in tx.ENTITIES:
    _ENT = f"""replace({_ENT}, '{_a}', '{_b.replace("'", "''")}')"""


def sql_entities(x: str) -> str:
    return _ENT.replace("html", x, 1) if _ENT.count("html") == 1 else x


ITEMS = rf"""pg AS (SELECT page_id, regexp_extract(regexp_extract(lower(url), '://([^/?#]*)', 1), '([^.]+\.[^.]+)$', 1) AS doc,
  regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!--.*?-->', '', 'g') AS c FROM pages),
mk AS (SELECT page_id, doc, string_split(regexp_replace(regexp_replace(c, '(?is)<(h[1-6]|p|li|nav|footer|article|div|table|tr)\b([^>]*)>', chr(1) || '\1 \2' || chr(2), 'g'),
  '(?is)</(nav|footer|article)>', chr(1) || 'end \1' || chr(2), 'g'), chr(1)) AS parts FROM pg),
pc AS (SELECT page_id, doc, unnest(parts) AS piece, generate_subscripts(parts, 1) AS at_ FROM mk),
ct AS (SELECT page_id, doc, at_, lower(regexp_extract(piece, '(?s)^([A-Za-z0-9]+) [^\x02]*\x02', 1)) AS tag, lower(regexp_extract(piece, '(?s)^[A-Za-z0-9]+ ([^\x02]*)\x02', 1)) AS rest,
  regexp_replace(regexp_replace(regexp_replace(piece, '(?s)^[A-Za-z0-9]+ [^\x02]*\x02', ''), '(?i)<br\s*/?>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS body FROM pc),
tt AS (SELECT *, {sql_ws(sql_entities('body'))} AS text, CASE WHEN tag IN ('nav', 'footer') THEN tag WHEN tag IN ('end', 'article') THEN 'body' WHEN tag = 'div' AND contains(rest, '"ad"') THEN 'ad'
  WHEN tag = 'div' THEN 'body' END AS region FROM ct),
rg AS (SELECT *, last_value(region IGNORE NULLS) OVER (PARTITION BY page_id, doc ORDER BY at_ ROWS UNBOUNDED PRECEDING) AS inside FROM tt),
items AS (SELECT doc, page_id AS page, row_number() OVER (PARTITION BY page_id, doc ORDER BY at_) - 1 AS pos,
  CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN 'section_header' WHEN tag = 'li' THEN 'list_item' WHEN tag = 'footer' THEN 'page_footer' ELSE 'paragraph' END AS kind,
  CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN substr(tag, 2, 1)::INT END AS level,
  CASE inside WHEN 'nav' THEN 'top' WHEN 'footer' THEN 'bottom' WHEN 'ad' THEN 'right' ELSE 'body' END AS band, text FROM rg WHERE text <> '')"""

FURNITURE = rf"""{ITEMS}, tot AS (SELECT doc, count(DISTINCT page_id) AS total FROM pg GROUP BY doc),
en AS (SELECT *, {sql_furniture('text')} AS norm FROM items),
sg AS (SELECT *, CASE WHEN band <> 'body' AND regexp_matches(norm, '\p{{L}}') THEN norm END AS sig,
  CASE WHEN band <> 'body' AND len(string_split(norm, ' ')) > 4 AND length(array_to_string(string_split(norm, ' ')[1:4], ' ')) >= 12 AND regexp_matches(array_to_string(string_split(norm, ' ')[1:4], ' '), '\p{{L}}')
       THEN array_to_string(string_split(norm, ' ')[1:4], ' ') END AS pre FROM en),
sigs AS (SELECT doc, sig AS key, band, count(DISTINCT page) AS pages FROM sg JOIN tot USING (doc) WHERE sig IS NOT NULL GROUP BY doc, sig, band, total
  HAVING count(DISTINCT page) >= CASE WHEN total < 2 THEN NULL WHEN total >= 12 THEN 3 ELSE greatest(2, ceil(total * 0.25)) END),
pres AS (SELECT doc, pre AS key, band, count(DISTINCT page) AS pages FROM sg JOIN tot USING (doc) WHERE pre IS NOT NULL GROUP BY doc, pre, band, total
  HAVING count(DISTINCT page) >= CASE WHEN total < 2 THEN NULL WHEN total >= 12 THEN 3 ELSE greatest(2, ceil(total * 0.25)) END),
sp AS (SELECT sg.*, EXISTS (SELECT 1 FROM sigs WHERE sigs.doc = sg.doc AND sigs.key = sg.sig AND sigs.band = sg.band) AS s1,
  EXISTS (SELECT 1 FROM pres WHERE pres.doc = sg.doc AND pres.key = sg.pre AND pres.band = sg.band) AS s2,
  band = 'right' AND regexp_matches(text, '^(\d{{1,2}}|[A-Z]|[-–—])$') AS tb FROM sg)"""


def furniture_signatures(spark, d):
    return fu.signatures(*_entries(spark, d))


furniture_signatures_sql = f"WITH {FURNITURE} SELECT * FROM sigs"


def furniture_prefixes(spark, d):
    return fu.prefixes(*_entries(spark, d))


furniture_prefixes_sql = f"WITH {FURNITURE} SELECT * FROM pres"


def furniture_split(spark, d):
    return fu.split_furniture(*_entries(spark, d)).select("doc", "page", "pos", "band", "furniture")


furniture_split_sql = f"WITH {FURNITURE} SELECT doc, page, pos, band, s1 OR s2 OR tb AS furniture FROM sp"


def furniture_strip_texts(spark, d):
    return fu.strip_texts(*_entries(spark, d))


furniture_strip_texts_sql = f"""WITH {FURNITURE} SELECT doc, page, norm FROM sp WHERE norm <> '' AND NOT (tb AND NOT s1 AND NOT s2) GROUP BY ALL HAVING bool_and(s1 OR s2 OR tb)"""


def document_profile(spark, d):
    """Page Markdown without furniture: the flagship."""
    entries, pages = _entries(spark, d)
    kept = fu.split_furniture(entries, pages).where("not furniture")
    return html.page_markdown(kept)


def _sql_markdown(source: str) -> str:
    line = "CASE kind WHEN 'section_header' THEN repeat('#', level) || ' ' || text WHEN 'list_item' THEN '- ' || text ELSE text END"
    return f"SELECT doc, page, string_agg({line}, chr(10) || chr(10) ORDER BY pos) || chr(10) AS markdown FROM {source} GROUP BY doc, page"


document_profile_sql = f"WITH {FURNITURE}, kept AS (SELECT * FROM sp WHERE NOT (s1 OR s2 OR tb)) {_sql_markdown('kept')}"


def page_markdown(spark, d):
    return html.page_markdown(_items(spark, d))


page_markdown_sql = f"WITH {ITEMS} {_sql_markdown('items')}"


def furniture_line_strip(spark, d):
    entries, pages = _entries(spark, d)
    lines = ln.to_lines(html.page_markdown(entries), "doc", "page", text="markdown")
    return fu.strip_lines(lines, fu.strip_texts(entries, pages)).where("line != ''").groupBy("doc", "page").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


furniture_line_strip_sql = None  # spans of up to four lines: held against brute force in the tests


def page_blocks(spark, d):
    return html.block_rows(_items(spark, d))


page_blocks_sql = rf"""WITH {ITEMS}, h AS (SELECT doc, page, pos, text, level FROM items WHERE kind = 'section_header'),
p AS (SELECT i.*, (SELECT h.text FROM h WHERE h.doc = i.doc AND h.page = i.page AND h.pos <= i.pos ORDER BY h.pos DESC LIMIT 1) AS head FROM items i)
SELECT doc, page, printf('p%04d-b%04d', page, pos + 1) AS block_id, kind AS type, coalesce(head, '') AS heading_path, substr(text, 1, 500) AS text, text AS text_full, length(text) AS n_chars FROM p"""


def combine_markdown(spark, d):
    """Pages of a site in one text, each under its mark."""
    pages = html.page_markdown(_items(spark, d))
    part = F.concat(F.format_string("<!-- page %d -->\n\n", F.col("page")), F.col("markdown"))
    ordered = F.array_sort(F.collect_list(F.struct("page", part.alias("part"))))
    return pages.groupBy("doc").agg(F.count("*").alias("pages"), F.md5(F.array_join(F.transform(ordered, lambda x: x["part"]), "\n").cast("binary")).alias("digest"))


combine_markdown_sql = f"""WITH {ITEMS}, m AS ({_sql_markdown('items')})
SELECT doc, count(*) AS pages, md5(string_agg('<!-- page ' || page || ' -->' || chr(10) || chr(10) || markdown, chr(10) ORDER BY page)) AS digest FROM m GROUP BY doc"""


def html_entities(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select("page_id", tx.unescape_entities(F.col("html")).alias("t"))
    return p.select("page_id", F.length("t").alias("n_chars"), F.md5(F.col("t").cast("binary")).alias("digest"))


html_entities_sql = f"SELECT page_id, length({sql_entities('html')})::BIGINT AS n_chars, md5({sql_entities('html')}) AS digest FROM pages"


def numeric_tokens(spark, d):
    return _docs(spark, d).select("doc_id", F.explode(tx.numeric_tokens(F.col("text"))).alias("token"))


numeric_tokens_sql = f"SELECT doc_id, unnest({sql_numbers('text')}) AS token FROM documents"


def significant_words(spark, d):
    w = _docs(spark, d).select("lang", F.explode(tx.significant_words(F.col("text"))).alias("word"))
    return w.groupBy("lang", "word").agg(F.count("*").alias("n"))


significant_words_sql = f"SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest({sql_words('text')}) AS word FROM documents) GROUP BY ALL"


def body_windows(spark, d):
    return ln.body_windows(_lines(spark, d), "doc_id").select("doc_id", "pos", F.size("words").alias("words"), F.size("numbers").alias("numbers"))


body_windows_sql = f"""WITH {LINES}, t AS (SELECT doc_id, pos, {sql_strip('line')} AS line FROM lines), f AS (SELECT doc_id, pos, {sql_words('line')} AS w, {sql_numbers('line')} AS n FROM t WHERE line <> ''),
o AS (SELECT doc_id, pos, flatten(list(w) OVER x) AS w, flatten(list(n) OVER x) AS n FROM f WINDOW x AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
SELECT doc_id, pos, len(list_distinct(w))::BIGINT AS words, len(list_distinct(n))::BIGINT AS numbers FROM o"""


def completeness(spark, d):
    """Lines of a document that a later version of it lacks: neighbours in a source stand in for versions."""
    docs = _docs(spark, d).select("doc_id", "text")
    source = ln.to_lines(docs.select((F.col("doc_id") + 1).alias("page"), "text"), "page")
    body = ln.to_lines(docs.select(F.col("doc_id").alias("page"), "text"), "page")
    return ln.missing_lines(source, body, "page")


completeness_sql = rf"""WITH docs AS (SELECT doc_id, text FROM documents), src AS ({sql_lines('(SELECT doc_id + 1 AS page, text FROM docs)', 'page')}), bod AS ({sql_lines('(SELECT doc_id AS page, text FROM docs)', 'page')}),
c0 AS (SELECT page, pos, {sql_strip('line')} AS raw FROM src),
c1 AS (SELECT page, pos, {sql_strip("regexp_replace(" + sql_strip("replace(regexp_replace(raw, '^[#>*|" + chr(92) + "s-]+', ''), '|', ' ')") + ", '^-{2,}$', '')")} AS line FROM c0 WHERE NOT regexp_matches(raw, '^!\[[^\]]*\]\([^)]*\)$')),
c2 AS (SELECT *, list_distinct({sql_words('line')}) AS sig, {sql_numbers('line')} AS nums, len({sql_words('line')}) AS k FROM c1 WHERE line <> ''),
c3 AS (SELECT * FROM c2 WHERE len(sig) > 0 AND (k >= 3 OR (NOT regexp_matches(line, '^\d{{1,3}}$') AND (regexp_matches(line, '^(?:19|20)\d{{2}}$') OR regexp_matches(line, '{tx.SHORT_VALUE.replace("(?iU)", "(?i)")}'))))),
b1 AS (SELECT page, pos, {sql_strip('line')} AS line FROM bod), b2 AS (SELECT page, pos, {sql_words('line')} AS w, {sql_numbers('line')} AS n FROM b1 WHERE line <> ''),
b3 AS (SELECT page, flatten(list(w) OVER x) AS w, flatten(list(n) OVER x) AS n FROM b2 WINDOW x AS (PARTITION BY page ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
b4 AS (SELECT page, lower(string_agg(line, chr(10) ORDER BY pos)) AS body FROM bod GROUP BY page)
SELECT page, pos, line FROM c3 WHERE NOT EXISTS (SELECT 1 FROM b3 WHERE b3.page = c3.page AND (len(nums) = 0 OR list_has_any(nums, b3.n)) AND len(list_intersect(sig, b3.w)) >= len(sig) * 0.6)
AND NOT coalesce((SELECT contains(b4.body, substr(lower(line), 1, 80)) FROM b4 WHERE b4.page = c3.page), false)"""


def unplaced_filter(spark, d):
    """Benchmark passages that no document holds literally.  A document that does holds the passage's inner words whole, so
    passages meet documents over their longest inner word, and only those pairs are compared; nothing is cut or sampled."""
    bench = spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", tx.collapse_ws(F.lower("text")).alias("probe"))
    words = F.split("probe", " ")
    inner = F.slice(words, F.lit(2), F.greatest(F.lit(0), F.size(words) - 2))
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))["word"]
    bench = bench.withColumn("key", longest)
    docs = spark.read.parquet(f"{d}/documents.parquet").select(tx.collapse_ws(F.lower("text")).alias("body"))
    long_ = bench.where("key is not null")
    keys = docs.select("body", F.explode(F.array_distinct(F.split("body", " "))).alias("key"))
    met = keys.join(long_, "key").where(F.contains("body", F.col("probe"))).select("item_id").distinct()
    return bench.select("item_id").join(met, "item_id", "left_anti")


unplaced_filter_sql = f"""WITH b AS (SELECT item_id, {sql_ws('lower(text)')} AS probe FROM benchmark), d AS (SELECT {sql_ws('lower(text)')} AS body FROM documents)
SELECT item_id FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE contains(body, probe))"""


def summary_redundancy(spark, d):
    """Turns of 12 different words or more of which nine tenths occur in the turn before."""
    from pyspark.sql import Window

    c = spark.read.parquet(f"{d}/conversations.parquet").withColumn("w", tx.word_tokens(F.col("text")))
    c = c.withColumn("before", F.lag("w").over(Window.partitionBy("conv_id").orderBy("turn")))
    share = F.size(F.array_intersect("w", "before")) / F.size("w")
    return c.where((F.size("w") >= 12) & F.col("before").isNotNull()).select("conv_id", "turn", F.size("w").alias("tokens"), (share >= 0.9).alias("redundant"))


summary_redundancy_sql = r"""WITH c AS (SELECT conv_id, turn, list_distinct(list_transform(regexp_extract_all(text, '\p{L}{4,}'), lambda x: lower(x))) AS w FROM conversations),
b AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS before_ FROM c)
SELECT conv_id, turn, len(w)::BIGINT AS tokens, len(list_intersect(w, before_)) / len(w) >= 0.9 AS redundant FROM b WHERE len(w) >= 12 AND before_ IS NOT NULL"""


def meta_commentary(spark, d):
    """Lines that talk about the parse, first pattern that fits; planted by prefixing every fifth turn."""
    c = spark.read.parquet(f"{d}/conversations.parquet")
    t = F.when(F.col("turn") % 5 == 0, F.concat(F.lit("Note: as per the image, "), F.col("text"))).otherwise(F.col("text"))
    lines = ln.to_lines(c.select("conv_id", "turn", t.alias("text")), "conv_id", "turn")
    return lines.where(tx.is_meta_note(F.col("line"))).select("conv_id", "turn", "pos", F.substring(tx.strip(F.col("line")), 1, 80).alias("excerpt"))


meta_commentary_sql = f"""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'Note: as per the image, ' || text ELSE text END AS text FROM conversations), lines AS ({sql_lines('c', 'conv_id, turn')})
SELECT conv_id, turn, pos, substr({sql_strip('line')}, 1, 80) AS excerpt FROM lines WHERE regexp_matches(line, '(?i){"|".join(tx.META_PATTERNS)}')
AND regexp_matches(regexp_replace(lower({sql_strip('line')}), '^[>* -]+', ''), '^(?:note|footnotes \\(as per)|should be included|as per image|this text is preserved')"""


def repair_gate(spark, d):
    """Reasons to reject a repaired text: it shrank below seven tenths, or it gained repeated paragraphs."""
    docs = _docs(spark, d)
    blocks = _blocks(spark, d)
    dup = ln.duplicate_paragraphs(blocks, "doc_id")
    after = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.length("text").alias("after")).join(dup.select((F.col("doc_id") + 1).alias("doc_id"), F.col("duplicates").alias("more")), "doc_id", "left")
    pair = docs.select("doc_id", F.length("text").alias("before")).join(dup, "doc_id", "left").join(after, "doc_id")
    reasons = F.array_compact(F.array(F.when(F.col("after") < 0.7 * F.col("before"), "shrink"), F.when(F.coalesce("more", F.lit(0)) > F.coalesce("duplicates", F.lit(0)), "duplicates")))
    return pair.select("doc_id", F.array_join(reasons, ",").alias("reasons"))


repair_gate_sql = f"""WITH {BLOCKS}, c AS (SELECT doc_id, norm, count(*) AS n FROM blocks WHERE length(norm) >= 80 GROUP BY ALL), dup AS (SELECT doc_id, sum(n - 1) AS k FROM c GROUP BY doc_id)
SELECT a.doc_id, concat_ws(',', CASE WHEN length(b.text) < 0.7 * length(a.text) THEN 'shrink' END, CASE WHEN coalesce(y.k, 0) > coalesce(x.k, 0) THEN 'duplicates' END) AS reasons
FROM documents a JOIN documents b ON b.doc_id + 1 = a.doc_id LEFT JOIN dup x ON x.doc_id = a.doc_id LEFT JOIN dup y ON y.doc_id = b.doc_id"""

NAMES = (
    "document_profile", "repeated_lines", "duplicate_paragraphs", "collapse_duplicates", "furniture_norm", "furniture_signatures", "furniture_prefixes", "furniture_split", "furniture_strip_texts",
    "furniture_line_strip", "page_markdown", "page_blocks", "combine_markdown", "html_entities", "numeric_tokens", "significant_words", "body_windows", "completeness", "unplaced_filter",
    "summary_redundancy", "meta_commentary", "repair_gate",
)
