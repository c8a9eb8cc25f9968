"""Queries over single rewrites of texts, tables and pictures, fed from the relational tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import grids as gr
from ..functions import html_tables as ht
from ..functions import items as it
from ..functions import markdown as md
from ..functions import pictures as pi
from ..functions import symbols as sy
from ..functions import text as tx
from ..operators import gates as ga
from ..operators import lines as ln
from ..operators import prompt_map as pm
from ..operators import rewrites as rw
from ..operators import tables as tb


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])



def spaces_collapsed(spark, d):
    """Documents with every blank doubled: blanks inside a line are one again, those at its ends stay."""
    t = md.collapse_spaces(F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("  ")))
    return _read(spark, d, "documents").select("doc_id", F.length(t).alias("n_chars"), F.md5(t.cast("binary")).alias("digest"))


spaces_collapsed_sql = r"""WITH l AS (SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda l: CASE WHEN starts_with(regexp_replace(l, '^\s+', ''), '|') THEN replace(l, ' ', '  ') WHEN trim(l, ' ') = '' THEN replace(l, ' ', '  ')
  ELSE repeat(' ', 2 * (length(l) - length(ltrim(l, ' ')))) || regexp_replace(trim(l, ' '), ' {2,}', ' ', 'g') || repeat(' ', 2 * (length(l) - length(rtrim(l, ' ')))) END) AS parts FROM documents)
SELECT doc_id, length(array_to_string(parts, chr(10))) AS n_chars, md5(array_to_string(parts, chr(10))) AS digest FROM l"""


def inline_bullets(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    line = F.when(part % 3 == 0, _text(name, ": • ", F.col("p_type"), " • ", F.col("p_brand"))).when(part % 3 == 1, _text("• ", name)).otherwise(name)
    return _read(spark, d, "part").select("p_partkey", F.posexplode(tx.split_inline_bullets(line)).alias("n", "line"))


inline_bullets_sql = """WITH p AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN [p_name || ':', '- ' || p_type, '- ' || p_brand] WHEN 1 THEN ['- ' || p_name] ELSE [p_name] END AS x FROM part)
SELECT p_partkey, unnest(generate_series(0, len(x) - 1)) AS n, unnest(x) AS line FROM p"""


def list_glyphs(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    line = F.when(part % 4 == 0, _text("- • ", name)).when(part % 4 == 1, _text("- ■ = ", name)).when(part % 4 == 2, _text("  - ◦ ", name)).otherwise(_text("| - • ", name, " |"))
    return _read(spark, d, "part").select("p_partkey", md.strip_list_glyphs(line).alias("line"))


list_glyphs_sql = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '- ' || p_name WHEN 1 THEN '- ■ = ' || p_name WHEN 2 THEN '  - ' || p_name ELSE '| - • ' || p_name || ' |' END AS line FROM part"


def cell_lists(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    cell = F.when(part % 4 == 0, _text("• ", name, " • ", F.col("p_type"))).when(part % 4 == 1, _text(name, " • ", F.col("p_type"), " • ", F.col("p_brand"))).when(part % 4 == 2, _text(name, " · ", F.col("p_type"))).otherwise(_text("· ", name, " · x"))
    out = tx.cell_with_bullets(cell)
    return _read(spark, d, "part").select("p_partkey", out.alias("cell"), tx.became_bullet_list(cell, out).alias("listed"))


cell_lists_sql = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '- ' || p_name || '<br>- ' || p_type WHEN 1 THEN p_name || '<br>- ' || p_type || '<br>- ' || p_brand WHEN 2 THEN p_name || ' · ' || p_type ELSE '- ' || p_name || '<br>- x' END AS cell, p_partkey % 4 <> 2 AS listed FROM part"""


def recogniser_marks(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    t = _text("H$ _{2} $O ", name, " $ ^{[", (part % 10).cast("string"), "]} $ 20$ ^{\\circ} $C ^[a] $ \\underline{\\text{X}} $ <div class=\"c\"> cap </div>")
    return _read(spark, d, "part").select("p_partkey", tx.clean_ocr(t).alias("text"))


recogniser_marks_sql = "SELECT p_partkey, 'H2O ' || p_name || ' [' || p_partkey % 10 || '] 20°C [a] X cap' AS text FROM part"


def demoted_headings(spark, d):
    part = F.col("p_partkey")
    t = _text("### Part ", part.cast("string"), ": ", F.col("p_size").cast("string"), "%\n\n", F.when(part % 2 == 0, "## Next\n").otherwise("text under it\n"))
    return _read(spark, d, "part").select("p_partkey", md.demote_headings(t).alias("text"))


demoted_headings_sql = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '- Part ' || p_partkey || ': ' || p_size || '%' || chr(10) || chr(10) || '## Next' || chr(10)
ELSE '### Part ' || p_partkey || ': ' || p_size || '%' || chr(10) || chr(10) || 'text under it' || chr(10) END AS text FROM part"""


def uncertain_notes(spark, d):
    name = F.col("p_name")
    t = _text("# Title\n\nbody ", name, "\n\n## Uncertain mappings\n- ", F.col("p_type"), "\n\n### deeper\nmore\n\n## After\nend")
    u = md.extract_uncertainty(t)
    return _read(spark, d, "part").select("p_partkey", u["md"].alias("text"), u["notes"].alias("notes"))


uncertain_notes_sql = r"""SELECT p_partkey, replace('# Title~~body ' || p_name || '~~## After~end~', '~', chr(10)) AS text, replace('## Uncertain mappings~- ' || p_type || '~~### deeper~more', '~', chr(10)) AS notes FROM part"""


def unplaced_sections(spark, d):
    name = F.col("p_name")
    t = _text("# Title\nbody\n## Unplaced content\n- ", name, "\n\n- ", F.col("p_type"), "\n# Next\nend")
    u = md.extract_unplaced(t)
    back = md.merge_unplaced(u["md"], F.concat(u["lines"], F.array(F.lit("BODY"))))
    return _read(spark, d, "part").select("p_partkey", u["md"].alias("text"), F.array_join(u["lines"], "|").alias("lines"), back.alias("merged"), ga.without_unplaced(t).alias("stripped"))


unplaced_sections_sql = r"""SELECT p_partkey, replace('# Title~body~# Next~end', '~', chr(10)) AS text, '- ' || p_name || '|- ' || p_type AS lines,
replace('# Title~body~# Next~end~~## Unplaced content~~- - ' || p_name || '~- - ' || p_type || '~', '~', chr(10)) AS merged, replace('# Title~body~# Next~end', '~', chr(10)) AS stripped FROM part"""


def footnotes_moved(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    t = _text("Text [1] ", name, "\n\n[1] note ", part.cast("string"), "\n\nmore [2]\n\n[1] NOTE ", part.cast("string"), "\n[2] second")
    return md.normalize_footnotes(_read(spark, d, "part").select("p_partkey", t.alias("text")), "text")


footnotes_moved_sql = r"""SELECT p_partkey, replace('Text [1] ' || p_name || '~~more [2]~~## Footnotes~[1] note ' || p_partkey || '~[2] second~', '~', chr(10)) AS text FROM part"""


def breaks_and_notes(spark, d):
    """Line breaks out of tables, notes about the parse, and spaces around headings."""
    name = F.col("p_name")
    t = _text(name, "<br>", F.col("p_type"), "\n| a<br>b | c |\nNote: as per the image, ", name, "\nlast")
    return _read(spark, d, "part").select("p_partkey", md.strip_breaks(t).alias("cut"), md.strip_meta(t).alias("plain"), md.bullets_and_headings(_text("a\n# ", name, "\n• b\n\n\n\nc")).alias("spaced"))


breaks_and_notes_sql = r"""SELECT p_partkey, replace(p_name || '~' || p_type || '~| a<br>b | c |~Note: as per the image, ' || p_name || '~last', '~', chr(10)) AS cut, replace(p_name || '<br>' || p_type || '~| a<br>b | c |~last~', '~', chr(10)) AS plain,
replace('a~~# ' || p_name || '~- b~~c~', '~', chr(10)) AS spaced FROM part"""


def line_counts(spark, d):
    """Values that stand alone, and rows of tables, in a text for each order."""
    li = _read(spark, d, "lineitem").withColumn("line", F.when(F.col("l_linenumber") % 3 == 0, _text("| ", F.col("l_partkey").cast("string"), " | x |")).when(F.col("l_linenumber") % 3 == 1, F.col("l_partkey").cast("string")).otherwise(_text("part ", F.col("l_partkey").cast("string"))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "line"))), lambda x: x["line"]), "\n")
    return li.groupBy("l_orderkey").agg(text.alias("t")).select("l_orderkey", md.value_line_count(_text("# 12\n- 13\n", F.col("t"))).alias("value_lines"), md.pipe_row_count(_text("| a | b |\n|---|---|\n", F.col("t"))).alias("table_rows"))


line_counts_sql = "SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber % 3 = 1) AS value_lines, 1 + count(*) FILTER (WHERE l_linenumber % 3 = 0) AS table_rows FROM lineitem GROUP BY 1"

_SAMPLES = ("AAA", "A-2", "2024", "12", "B", "–", "12.5%", "€ 3 bn", "REVENUE OF THE GROUP", "Revenue of the Group", "3", "1999", "this text is distinctive", "a b", "~45 kg", "AA+", "| a |", "|---|", "(in EUR)", "15 pts")
_VALUES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(_SAMPLES))


def text_flags(spark, d):
    """Predicates over texts that tell them apart, on every customer's sample."""
    s = F.get(F.array(*map(F.lit, _SAMPLES)), (F.col("c_custkey") % len(_SAMPLES)).cast("int"))
    c = _read(spark, d, "customer").select("c_custkey", s.alias("s"))
    t = F.col("s")
    return c.select(
        "c_custkey", tx.is_letter_rating(t).alias("rating"), tx.is_bare_year(t).alias("year"), tx.is_chapter_tab_text(t).alias("tab"), tx.is_distinctive_cell(t).alias("distinctive"), tx.is_pipe_line(t).alias("pipe"),
        tx.is_separator_line(t).alias("rule"), pm.has_value_signal(t).alias("signal"), pm.is_timeline_text(t).alias("point"), pm.is_value_cell(t).alias("value_cell"), pm.is_table_like(t).alias("table_like"), rw.line_kind(t).alias("kind"),
    )


text_flags_sql = rf"""WITH v(i, s) AS (VALUES {_VALUES}), c AS (SELECT c_custkey, s FROM customer JOIN v ON c_custkey % {len(_SAMPLES)} = i)
SELECT c_custkey, regexp_full_match(s, '[A-Z][a-zA-Z]{{0,3}}[+-]?\d?') AS rating, regexp_full_match(s, '(19|20)\d\d') AS year, regexp_full_match(s, '\d{{1,2}}|[A-Z]|[-–—]') AS tab,
length(s) >= 16 OR len(regexp_extract_all(s, '\p{{L}}{{3,}}')) >= 3 AS distinctive, starts_with(s, '|') AS pipe, s = '|---|' AS rule,
regexp_matches(s, '(?i)\b(?:19|20)\d\d\b|\d[\d,.\s]*(?:%|pts?|bn|kg)\b|[€]\s*\d') AS signal, s IN ('2024', '1999', '12', '3', '12.5%', '15 pts') AS point,
s IN ('2024', '1999', '12', '3', '12.5%', '15 pts') OR regexp_matches(s, '(?i)\b(?:19|20)\d\d\b|\d[\d,.\s]*(?:%|pts?|bn|kg)\b|[€]\s*\d') AS value_cell, false AS table_like,
CASE WHEN s IN ('2024', '1999', '12', '3', '12.5%', '€ 3 bn', '15 pts') THEN 'VALUE' WHEN s = 'REVENUE OF THE GROUP' THEN 'LABEL' ELSE 'OTHER' END AS kind FROM c"""


def mixed_pairs(spark, d):
    """Values and labels on one line, in either order, and with a rating's footnote."""
    s = F.col("s_suppkey")
    t = F.when(s % 4 == 0, _text(s.cast("string"), "% SHARE OF SUPPLIER")).when(s % 4 == 1, _text("SHARE OF SUPPLIER ", s.cast("string"), "%")).when(s % 4 == 2, _text("AA (a) AWARDED BY AGENCY")).otherwise(_text("OUTLOOK FOR ALL OF 2026"))
    p = rw.mixed_pair(t)
    return _read(spark, d, "supplier").select("s_suppkey", p["label"].alias("label"), p["value"].alias("value"))


mixed_pairs_sql = "SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN 'SHARE OF SUPPLIER' WHEN s_suppkey % 4 = 2 THEN 'AWARDED BY AGENCY' END AS label, CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey || '%' WHEN s_suppkey % 4 = 2 THEN 'AA (a)' END AS value FROM supplier"


def text_helpers(spark, d):
    """Addresses without users, fences off answers, texts cut for a prompt, and estimates of tokens."""
    p = _read(spark, d, "pages")
    url = F.replace("url", F.lit("://"), F.lit("://user:secret@"))
    body = F.coalesce("html", F.lit(""))
    return p.select("page_id", tx.redact_url(url).alias("url"), tx.strip_fences(_text("```json\n", F.col("url"), "\n```")).alias("answer"), tx.truncate(body, 80).alias("cut"), tx.token_estimate(body).alias("tokens"))


text_helpers_sql = r"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, regexp_replace(regexp_replace(coalesce(html, ''), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS flat FROM pages)
SELECT page_id, url, url AS answer, CASE WHEN length(flat) > 80 THEN rtrim(substr(flat, 1, 79)) || '...' ELSE flat END AS cut, CASE WHEN h = '' THEN 0 ELSE greatest(1, round_even(length(h) / 4, 0)::BIGINT) END AS tokens FROM p"""


def html_tables(spark, d):
    """Nations of a region as an HTML table with a spanning cell, flattened."""
    n = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = _text("<tr><td>", F.col("n_name"), "</td><td>", F.col("n_nationkey").cast("string"), "</td></tr>")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("row")))), lambda x: x["row"]), "")
    t = n.groupBy("r_name").agg(body.alias("body")).select("r_name", _text("before\n\n<table><tr><td colspan=\"2\">", F.col("r_name"), "</td></tr>", F.col("body"), "</table>\n\nafter").alias("t"))
    return t.select("r_name", tx.strip(ht.flatten_html_tables(F.col("t"))).alias("text"))


html_tables_sql = r"""SELECT r_name, 'before' || repeat(chr(10), 3) || '| ' || r_name || ' | ' || r_name || ' |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) || repeat(chr(10), 3) || 'after' AS text
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""


def _item(**fields):
    kinds = dict(p.split(":", 1) for p in it.ITEM[len("struct<") : -1].replace("array<", "array<").split(",") if ":" in p and p.split(":")[0] in ("label", "class_name", "content_layer", "text", "orig", "caption", "marker", "parent_ref", "level"))
    full = [F.coalesce(fields[k], F.lit(None)).cast(t).alias(k) if k in fields else F.lit(None).cast(t).alias(k) for k, t in kinds.items()]
    prov = f"array<struct<page_no:int,bbox:{it.BBOX}>>"
    grid = f"array<array<{it.CELL}>>"
    return F.struct(*full, fields.get("prov", F.lit(None)).cast(prov).alias("prov"), fields.get("grid", F.lit(None)).cast(grid).alias("grid"))


_LABELS = ("Label.TITLE", "Label.SECTION_HEADER", "Label.LIST_ITEM", "Label.TEXT", "Label.PICTURE", "Label.PAGE_FOOTER", "", "Label.CAPTION")


def item_fields(spark, d):
    """Accessors of items, on parts that play items of all kinds."""
    part, name = F.col("p_partkey"), F.col("p_name")
    label = F.get(F.array(*map(F.lit, _LABELS)), (part % 8).cast("int"))
    box = F.struct(F.lit(60.0).alias("l"), (F.lit(800.0) - part % 700).alias("t"), F.lit(300.0).alias("r"), (F.lit(790.0) - part % 700).alias("b"), F.lit("CoordOrigin.BOTTOMLEFT").alias("origin"))
    prov = F.when(part % 11 != 0, F.array(F.struct((part % 5 + 1).cast("int").alias("page_no"), box.alias("bbox"))))
    item = _item(label=label, class_name=F.when(part % 8 == 6, "TableItem"), content_layer=F.when(part % 8 == 7, "Layer.FURNITURE"), text=F.when(part % 3 == 0, "  ").otherwise(_text(" ", name)), orig=name, marker=F.when(part % 2 == 0, "·"), level=(part % 4).cast("int"), prov=prov)
    i = F.col("item")
    p = _read(spark, d, "part").select("p_partkey", item.alias("item"))
    return p.select(
        "p_partkey", it.kind(i).alias("kind"), it.layer(i).alias("layer"), F.coalesce(it.page_number(i), F.lit(0)).cast("long").alias("page"), it.is_furniture(i).alias("furniture"), it.is_picture(i).alias("picture"), it.is_table(i).alias("is_table"),
        it.is_heading(i).alias("heading"), it.text_of(i).alias("text"), it.marker(i).alias("marker"), it.parent_key(i).alias("parent"), it.heading_level(i).alias("level"), it.prompt_type(i).alias("type"), it.box_origin(it.bbox(i)).alias("origin"),
        it.markdown(i, F.lit(1), part % 16 == 4, F.lit("")).alias("line"),
    )


item_fields_sql = r"""WITH p AS (SELECT p_partkey AS k, p_name, CASE p_partkey % 8 WHEN 0 THEN 'title' WHEN 1 THEN 'section_header' WHEN 2 THEN 'list_item' WHEN 3 THEN 'text' WHEN 4 THEN 'picture' WHEN 5 THEN 'page_footer' WHEN 6 THEN 'table' ELSE 'caption' END AS kind,
  p_partkey % 4 AS lv FROM part),
q AS (SELECT *, CASE WHEN kind = 'section_header' AND lv > 0 THEN least(6, lv + 1) WHEN lv > 0 THEN lv WHEN kind = 'title' THEN 1 ELSE 2 END AS level FROM p)
SELECT k AS p_partkey, kind, CASE WHEN kind = 'caption' THEN 'furniture' ELSE '' END AS layer, CASE WHEN k % 11 <> 0 THEN k % 5 + 1 ELSE 0 END AS page, kind IN ('page_footer', 'caption') AS furniture, kind = 'picture' AS picture, kind = 'table' AS is_table,
kind IN ('title', 'section_header') AS heading, p_name AS text, CASE WHEN k % 2 = 0 THEN '·' ELSE '' END AS marker, '__no_parent__' AS parent, level, CASE kind WHEN 'text' THEN 'paragraph' ELSE kind END AS type, CASE WHEN k % 11 <> 0 THEN 'BOTTOMLEFT' END AS origin,
CASE kind WHEN 'picture' THEN CASE WHEN k % 16 = 4 THEN '<!-- image -->' ELSE '' END WHEN 'title' THEN repeat('#', level) || ' ' || p_name WHEN 'section_header' THEN repeat('#', level) || ' ' || p_name WHEN 'list_item' THEN '  - ' || p_name ELSE p_name END AS line FROM q"""


def list_levels(spark, d):
    """Parts of a brand as items of one list: those with a mark are a level deeper, where any has none."""
    part, name = F.col("p_partkey"), F.col("p_name")
    some = F.substring("p_brand", -1, 1).try_cast("int") % 2 == 0
    item = _item(label=F.lit("Label.LIST_ITEM"), text=name, marker=F.when(some & (part % 3 != 0), None).otherwise("·"), parent_ref=F.col("p_brand"))
    items = _read(spark, d, "part").select("p_partkey", "p_brand", item.alias("item"))
    return it.list_levels(items).select("p_partkey", F.coalesce("list_level", F.lit(-1)).alias("list_level"))


list_levels_sql = """WITH p AS (SELECT p_partkey, p_brand, right(p_brand, 1)::INT % 2 <> 0 OR p_partkey % 3 = 0 AS marked FROM part), g AS (SELECT p_brand, bool_and(marked) AS every FROM p GROUP BY 1)
SELECT p_partkey, CASE WHEN every THEN -1 ELSE marked::INT::BIGINT END AS list_level FROM p JOIN g USING (p_brand)"""


def grid_records(spark, d):
    """Suppliers of a nation as a grid of title and detail rows, normalised and rendered."""
    s = _read(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    two = F.array(F.array(F.col("s_name"), F.lit(""), F.lit("")), F.array(_text("about ", key), key, F.lit("n")))
    rows = F.concat(F.array(F.array(*[F.lit(x) for x in ("Name", "Key", "Note")])), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", two.alias("two")))), lambda x: x["two"])))
    t = s.groupBy("s_nationkey").agg(rows.alias("rows")).withColumn("t", gr.normalize(F.col("rows"), F.lit(3), F.lit(0)))
    return t.select("s_nationkey", F.col("t.classification").alias("kind"), F.when(F.col("t").isNotNull(), gr.render(F.col("t"))).alias("markdown"))


grid_records_sql = r"""WITH s AS (SELECT s_nationkey, count(*) AS n, string_agg('| ' || s_name || '<br>about ' || s_suppkey || ' | ' || s_suppkey || ' | n |' || chr(10), '' ORDER BY s_suppkey) AS body FROM supplier GROUP BY 1)
SELECT s_nationkey, CASE WHEN n >= 2 THEN 'title_detail_table' END AS kind, CASE WHEN n >= 2 THEN '| Name | Key | Note |' || chr(10) || '|---|---|---|' || chr(10) || body END AS markdown FROM s"""


def grid_headers(spark, d):
    """Two header rows of which the upper one spans columns, merged; one value put into a blank cell, and one refused."""
    name = F.col("p_name")
    p = _read(spark, d, "part")
    rows = F.array(F.array(F.lit(""), F.col("p_brand"), F.col("p_brand")), F.array(F.lit(""), F.lit("A"), F.lit("B")), F.array(name, F.lit("1"), F.lit("")), F.array(F.col("p_type"), F.lit("2"), F.lit("")))
    t = gr.normalize(rows, F.lit(3), F.lit(2))
    q = p.select("p_partkey", "p_brand", rows.alias("rows"), t.alias("t"))
    put = gr.place_value(F.col("t"), F.lit(0), F.lit(2), F.lit("E1"))
    no = gr.place_value(F.col("t"), F.lit(0), F.lit(1), F.lit("E1"))
    back = gr.copy_back(F.col("rows"), F.array(F.lit(2)), F.lit(2), F.lit("E1"))
    return q.select(
        "p_partkey", F.array_join("t.header", "|").alias("header"), gr.coverage_column(F.col("t")).alias("coverage"), put["placed"].alias("placed"), F.array_join(F.get(put["table"]["records"], F.lit(0))["cells"], "|").alias("first"), no["placed"].alias("refused"),
        F.array_join(F.get(back, F.lit(2)), "|").alias("source"), F.array_join(gr.body_cells(F.col("rows"), F.lit(2), F.lit(1)), "|").alias("column"), gr.spanning_label(F.get("rows", F.lit(0))).alias("span"),
    )


grid_headers_sql = "SELECT p_partkey, p_brand || '|' || p_brand || '<br>A|' || p_brand || '<br>B' AS header, 2::BIGINT AS coverage, true AS placed, p_name || '|1|E1' AS first, false AS refused, p_name || '|1|E1' AS source, '1|2' AS column, p_brand AS span FROM part"


def grid_sections(spark, d):
    """Nations under their regions as one grid with title rows, cut into sections and rendered."""
    n = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.array(x["n_name"], x["n_nationkey"].cast("string"), F.lit("x")))
    one = n.groupBy("r_regionkey", "r_name").agg(body.alias("body"))
    rows = F.concat(F.array(F.array(F.col("r_name"), F.lit(""), F.lit("")), F.array(F.lit("(all)"), F.lit(""), F.lit(""))), F.col("body"))
    g = one.select("r_regionkey", rows.alias("rows")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "rows"))), lambda x: x["rows"])).alias("rows"))
    split = rw.sections(F.concat(F.array(F.array(*[F.lit(x) for x in ("Nation", "Key", "Note")])), F.col("rows")), F.lit(1))
    return g.withColumn("s", split).select(F.size("s.sections").alias("sections"), F.array_join(rw.section_kinds(F.col("s")), ",").alias("kinds"), rw.render_sections(F.col("s"), F.lit(3)).alias("markdown"), rw.relevel(rw.render_sections(F.col("s"), F.lit(3)), rw.section_kinds(F.col("s")), F.lit(2)).alias("shallower"))


grid_sections_sql = r"""WITH t AS (SELECT r_regionkey, ' ' || r_name || ' (all)' || chr(10) || chr(10) || '| Nation | Key | Note |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' | x |', chr(10) ORDER BY n_nationkey) AS part
 FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name)
SELECT count(*) AS sections, string_agg('data', ',') AS kinds, string_agg('###' || part, chr(10) || chr(10) ORDER BY r_regionkey) AS markdown, string_agg('##' || part, chr(10) || chr(10) ORDER BY r_regionkey) AS shallower FROM t"""


def picture_rules(spark, d):
    """Which pictures are described, which may hold a table, and which are navigation."""
    k = F.col("doc_id")
    area = (k % 100) / 1000
    kind = F.get(F.array(*[F.lit(x) for x in ("chart", "logo", "photo", "")]), (k % 4).cast("int"))
    inside = F.when(k % 13 == 0, "picture").when(k % 13 == 1, "table").otherwise("")
    s = pi.summarize(inside, area, kind, F.lit("Caption"))
    rect = F.array(F.when(k % 3 == 0, 0.92).otherwise(0.1), F.lit(0.4), F.lit(0.99), F.when(k % 2 == 0, 0.6).otherwise(0.95))
    t = pi.table_like(area, rect, kind, F.lit(""), k % 5 == 0)
    nav = pi.is_navigation(rect, inside, F.lit(""), F.lit("too_small"), F.lit(True))
    return _read(spark, d, "labels").select("doc_id", s["wanted"].alias("wanted"), s["reason"].alias("reason"), t["yes"].alias("table_like"), t["reason"].alias("why"), F.round(t["confidence"], 3).alias("confidence"), nav.alias("navigation"))


picture_rules_sql = """WITH l AS (SELECT doc_id AS k, (doc_id % 100) / 1000 AS area, ['chart', 'logo', 'photo', ''][doc_id % 4 + 1] AS kind, CASE doc_id % 13 WHEN 0 THEN 'picture' WHEN 1 THEN 'table' ELSE '' END AS inside,
 CASE WHEN doc_id % 3 = 0 THEN 0.92 ELSE 0.1 END AS lf, CASE WHEN doc_id % 2 = 0 THEN 0.6 ELSE 0.95 END AS bt FROM labels),
m AS (SELECT *, (0.99 - lf) / (bt - 0.4) AS aspect FROM l), r AS (SELECT *, CASE inside WHEN 'picture' THEN 'covered_by_parent' WHEN 'table' THEN 'table_embedded' ELSE CASE WHEN area < 0.01 THEN 'too_small' WHEN kind = 'logo' AND area < 0.05 THEN 'decorative'
  WHEN area >= 0.05 THEN 'large_picture' WHEN kind = 'chart' THEN 'semantic_label' ELSE 'not_semantic' END END AS reason,
  CASE WHEN area < 0.08 THEN 'picture_too_small' WHEN kind = 'logo' THEN 'decorative_picture' WHEN NOT (aspect >= 1.8 OR kind = 'chart' OR k % 5 = 0) THEN 'no_table_signal' END AS no FROM m)
SELECT k AS doc_id, reason IN ('table_embedded', 'large_picture', 'semantic_label') AS wanted, reason, no IS NULL AS table_like,
coalesce(no, concat_ws(',', CASE WHEN aspect >= 2.2 THEN 'wide_region' END, CASE WHEN aspect >= 1.8 THEN 'lower_wide_region' END, CASE WHEN kind = 'chart' THEN 'semantic_label' END, CASE WHEN k % 5 = 0 THEN 'nearby_structured_text' END)) AS why,
CASE WHEN no IS NULL THEN round(least(0.95, 0.55 + CASE WHEN aspect >= 2.2 THEN 0.15 ELSE 0 END + CASE WHEN aspect >= 1.8 THEN 0.1 ELSE 0 END + CASE WHEN kind = 'chart' THEN 0.15 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 0.15 ELSE 0 END), 3)::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
lf >= 0.9 AND inside <> 'table' AS navigation FROM r"""


def picture_answers(spark, d):
    """Answers of a model about pictures: kinds with confidence, typed summaries and their shape, symbols."""
    k = F.col("event_id")
    answer = F.get(F.array(F.lit('```json\n{"type": "Chart", "confidence": 0.9}\n```'), F.lit('It is {"type": "photo", "confidence": "0.7"} I think'), F.lit('{"type": "cat", "confidence": 3}'), F.lit("no idea"), F.lit("[1]"), F.lit('{"type": "map", "confidence": "high"}')), (k % 6).cast("int"))
    t = pi.triage(answer)
    typed = F.get(F.array(F.lit("TYPE: chart\na: 1\nb: 2"), F.lit("type: Photo\nA dog."), F.lit("TYPE: cat\nx"), F.lit("plain")), (k % 4).cast("int"))
    s = pi.typed_summary(typed)
    e = _read(spark, d, "events").select("event_id", t.alias("t"), s.alias("s"), F.when(k % 2 == 0, " E1 S3 G12 ").otherwise("E1 and S3").alias("sym"))
    return e.select("event_id", "t.kind", "t.confidence", F.array_join("t.warnings", ",").alias("warnings"), F.col("s.kind").alias("typed"), F.col("s.body").alias("body"), pi.shape_ok(F.col("s.kind"), F.col("s.body")).alias("shape"), pi.symbol_summary(F.col("sym")).alias("symbol"))


picture_answers_sql = r"""SELECT event_id, ['chart', 'photo', 'unclear', 'unclear', 'unclear', 'map'][event_id % 6 + 1] AS kind, ([0.9, 0.7, 1.0, 0.0, 0.0, 0.0][event_id % 6 + 1])::DOUBLE AS confidence,
['', '', 'triage_unknown_type', 'triage_invalid_json', 'triage_invalid_payload', 'triage_invalid_confidence'][event_id % 6 + 1] AS warnings, ['chart', 'photo', '', ''][event_id % 4 + 1] AS typed,
['a: 1' || chr(10) || 'b: 2', 'A dog.', 'TYPE: cat' || chr(10) || 'x', 'plain'][event_id % 4 + 1] AS body, true AS shape, CASE WHEN event_id % 2 = 0 THEN 'E1, S3, G12' ELSE 'E1 and S3' END AS symbol FROM events"""


def picture_blocks(spark, d):
    """Pictures as they stand in a text, with the rectangle that a summary looks at."""
    k = F.col("vec_id")
    ref = pi.reference((k % 7).cast("int"), (k % 50).cast("int"), F.lit("images/x.png"))
    kind = F.when(k % 3 == 0, "symbol").otherwise("chart")
    rect, cells = F.array(*[F.lit(x) for x in (0.4, 0.4, 0.6, 0.6)]), F.array(F.array(*[F.lit(x) for x in (0.4, 0.62, 0.6, 0.65)]), F.array(*[F.lit(x) for x in (0.4, 0.67, 0.6, 0.7)]), F.array(*[F.lit(x) for x in (0.0, 0.0, 0.1, 0.1)]))
    grown = pi.summary_rect(rect, cells)
    return _read(spark, d, "embeddings").select("vec_id", pi.block(kind, F.when(k % 2 == 0, " sum ").otherwise(""), k % 4 == 0, ref).alias("block"), F.round(grown[1], 6).alias("top"), F.round(grown[3], 6).alias("bottom"))


picture_blocks_sql = """WITH e AS (SELECT vec_id AS k, printf('![Picture p%04d-i%03d](images/x.png)', vec_id % 7, vec_id % 50) AS ref FROM embeddings)
SELECT k AS vec_id, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'sum' ELSE '' END WHEN k % 2 = 0 AND k % 4 <> 0 THEN ref || chr(10) || chr(10) || '**Image summary:** sum' ELSE ref END AS block, 0.38::DOUBLE AS top, 0.72::DOUBLE AS bottom FROM e"""


def figure_marks(spark, d):
    part = F.col("p_partkey")
    img = F.when(part % 3 == 0, '<div><img src="a/img_in_chart_1.png" width="20%"/></div>').when(part % 3 == 1, '<img src="b.png" width="55%"/>').otherwise('<img src="c.png">')
    t = _text("a ", img, "\nb")
    return _read(spark, d, "part").select("p_partkey", pi.figure_marks(t).alias("marked"), pi.strip_figure_marks(_text("x\n", F.when(part % 2 == 0, "[CHART HERE] y\n").otherwise("z\n"), "w")).alias("stripped"))


figure_marks_sql = "SELECT p_partkey, 'a [' || CASE WHEN p_partkey % 3 < 2 THEN 'CHART' ELSE 'FIGURE' END || ' HERE]' || chr(10) || 'b' AS marked, CASE WHEN p_partkey % 2 = 0 THEN 'x' || chr(10) || 'w' ELSE 'x' || chr(10) || 'z' || chr(10) || 'w' END AS stripped FROM part"


def symbol_lines(spark, d):
    """Lines that only list symbols go, but for as many as still lack a place; symbols in cells are counted."""
    k = F.col("s_suppkey")
    code = F.concat(F.lit("E"), (k % 9).cast("string"))
    t = _text("text\n![", code, "](a.png)\n![", code, "](b.png) ![S3](c.png)\n![photo of x](d.png)\n| ", code, " | ", code, ", S3 |\n|---|---|")
    known = sy.codes(F.array(code, F.lit("S3 x")))
    kept = sy.strip_loose(t, known, sy.budget(F.when(k % 2 == 0, F.array(code)).otherwise(F.array().cast("array<string>"))))
    n = sy.table_counts(t, F.array(code, F.lit("S3")))
    return _read(spark, d, "supplier").select("s_suppkey", F.array_join(sy.value_tokens(F.concat(code, F.lit(" s3"))), "|").alias("tokens"), F.array_join(known, "|").alias("known"), kept["removed"].alias("removed"), F.size(md.lines_of(kept["md"])).alias("lines"),
                                               F.try_element_at(n, code).alias("own"), F.try_element_at(n, F.lit("S3")).alias("s3"), sy.deficit_line(k.cast("string"), code).alias("deficit"),
                                               sy.complete_geometry(F.lit("enforce"), F.when(k % 3 == 0, "complete").otherwise("uncertain"), F.array().cast("array<int>"), F.array(F.lit(1)), F.when(k % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))).alias("complete"))


symbol_lines_sql = """SELECT s_suppkey, 'E' || s_suppkey % 9 || '|S3' AS tokens, 'E' || s_suppkey % 9 || '|S3' AS known, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS removed, CASE WHEN s_suppkey % 2 = 0 THEN 5 ELSE 4 END::BIGINT AS lines, 2::BIGINT AS own, 1::BIGINT AS s3,
'table symbol picture_index=' || s_suppkey || ' value=E' || s_suppkey % 9 || ' is not placed' AS deficit, s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 AS complete FROM supplier"""


# --- rewrites of line tables --------------------------------------------------------------------------------------


def _brand_lines(spark, d):
    part, name = F.col("p_partkey"), F.col("p_name")
    p = _read(spark, d, "part")
    n = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    return p.select(F.col("p_brand").alias("t"), n.alias("pos"), "p_partkey", _text("- ", name, " ", part.cast("string")).alias("line"))


def list_indents(spark, d):
    lines = _brand_lines(spark, d)
    specs = lines.select("t", _text("", F.substring("line", 3, 1000)).alias("text"), (F.col("p_partkey") % 4).cast("int").alias("level"))
    twice = specs.where("level = 3")
    return rw.apply_list_levels(lines.select("t", "pos", "line"), specs.unionByName(twice), "t")


list_indents_sql = """SELECT p_brand AS t, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, CASE p_partkey % 4 WHEN 3 THEN '' ELSE repeat('  ', (p_partkey % 4)::BIGINT) END || '- ' || p_name || ' ' || p_partkey AS line FROM part"""


def blank_headers(spark, d):
    """Suppliers of a nation as a table without a header: every second nation is known for that."""
    s = _read(spark, d, "supplier")
    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    lines = s.select(F.col("s_nationkey").alias("t"), n.alias("pos"), _text("| ", F.col("s_name"), " | ", F.col("s_suppkey").cast("string"), " |").alias("line"))
    first = s.groupBy(F.col("s_nationkey").alias("t")).agg(F.min_by(F.array("s_name", F.col("s_suppkey").cast("string")), "s_suppkey").alias("cells")).where("t % 2 = 0")
    return rw.add_blank_headers(lines, first, "t")


blank_headers_sql = """WITH s AS (SELECT s_nationkey::BIGINT AS t, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n, '| ' || s_name || ' | ' || s_suppkey || ' |' AS line FROM supplier)
SELECT t, n - 1 + CASE WHEN t % 2 = 0 THEN 2 ELSE 0 END AS pos, line FROM s UNION ALL SELECT DISTINCT t, 0, '|  |  |' FROM s WHERE t % 2 = 0 UNION ALL SELECT DISTINCT t, 1, '|---|---|' FROM s WHERE t % 2 = 0"""


def heading_notes(spark, d):
    """Orders as pages whose lines are headings of a level each; the later text lost the deepest ones."""
    li = _read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), _text(F.repeat(F.lit("#"), F.col("l_linenumber")), " part").alias("line"))
    own = li.where("pos < 3 and l_orderkey % 5 != 0")
    return rw.heading_warnings(own, li, li, "l_orderkey")


heading_notes_sql = """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem WHERE l_linenumber <= 6), k AS (SELECT DISTINCT l_orderkey FROM lineitem),
a AS (SELECT l_orderkey, list_sort(list(n)) AS raw, coalesce(list_sort(list(n) FILTER (WHERE n < 3 AND l_orderkey % 5 <> 0)), []) AS own FROM l GROUP BY 1), b AS (SELECT k.l_orderkey, coalesce(raw, []) AS raw, coalesce(own, []) AS own FROM k LEFT JOIN a USING (l_orderkey))
SELECT l_orderkey, 'no heading on the page' AS warning FROM b WHERE len(own) = 0
UNION ALL SELECT l_orderkey, 'fewer heading levels [' || array_to_string(own, ', ') || '] than the raw text [' || array_to_string(raw, ', ') || ']' FROM b WHERE len(raw) > 0 AND len(own) < len(raw)"""


def header_restored(spark, d):
    """Tables whose header lost its upper row get it back from their source, where half of their rows are in it."""
    s = _read(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    body = s.select(F.col("s_nationkey").alias("t"), (n + 1).alias("pos"), _text("| ", F.col("s_name"), " | ", key, " | 7 |").alias("line"))
    head = s.select(F.col("s_nationkey").alias("t")).distinct().select("t", F.posexplode(F.array(F.lit("| Name | | Key |"), F.lit("|---|---|---|"))).alias("pos", "line"))
    rows = F.concat(F.array(F.array(*[F.lit(x) for x in ("Name", "Numbers", "Numbers")]), F.array(*[F.lit(x) for x in ("Name", "Key", "Other")])), F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: F.array(x["s_name"], x["s_suppkey"].cast("string"), F.lit("7"))))
    grids = s.groupBy(F.col("s_nationkey").alias("t")).agg(rows.alias("rows")).select("t", F.lit("tc001").alias("table"), "rows", F.lit(3).alias("num_cols"), F.lit(2).alias("header_rows"))
    new = rw.merged_headers(head.unionByName(body), grids, "t")
    return rw.apply_lines(head.unionByName(body), new, "t").where("pos = 0").select("t", "line")


header_restored_sql = "SELECT DISTINCT s_nationkey::BIGINT AS t, '| Name | Numbers<br>Key | Numbers<br>Other |' AS line FROM supplier"


def lost_lines(spark, d):
    """Lines that a page seems to lack: a phrase over and over, margin text, one that is there in parts, and one that is not."""
    part, name = F.col("p_partkey"), F.col("p_name")
    p = _read(spark, d, "part")
    body = p.select(F.col("p_partkey").alias("t"), F.lit(0).alias("pos"), _text("The ", F.lower(name), " component weighs ", F.col("p_size").cast("string"), " kilos in total").alias("line"))
    four = F.array(_text("Year ended December  Year ended December"), _text("Running Footer ", part.cast("string")), _text("weighs ", F.col("p_size").cast("string"), " kilos  component total"), _text("Rating outlook  A-", part.cast("string"), "x"))
    lines = p.select(F.col("p_partkey").alias("t"), F.posexplode(four).alias("pos", "line"))
    margin = p.select(F.col("p_partkey").alias("t"), F.lit("running footer").alias("norm"))
    return rw.present_parts(lines, body, margin, "t").select("t", "pos", "reason")


lost_lines_sql = "SELECT p_partkey AS t, i AS pos, ['repeated phrase', 'margin text', 'present', NULL][i + 1] AS reason FROM part, (SELECT unnest([0, 1, 2, 3])::BIGINT AS i)"


def section_levels(spark, d):
    """Where a table of sections would stand, one level below the last heading that is none of its own."""
    li = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("t"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_linenumber") % 2 == 0, _text("## Own (in EUR)")).otherwise(_text(F.repeat(F.lit("#"), F.least(F.lit(4), "l_linenumber")), " Other")).alias("line")).distinct()
    places = li.groupBy("t").agg((F.max("pos") + 1).alias("pos")).select("t", F.lit(1).alias("table"), "pos", F.array(F.lit("own")).alias("titles"))
    return rw.base_levels(li, places, "t").select("t", "level")


section_levels_sql = "SELECT l_orderkey AS t, coalesce(max(CASE WHEN l_linenumber % 2 = 1 THEN least(4, l_linenumber) END) + 1, 3)::BIGINT AS level FROM lineitem GROUP BY 1"


# --- gates --------------------------------------------------------------------------------------------------------


def table_gates(spark, d):
    """Transcriptions of a nation's suppliers with one fault each, by every rule that can refuse them."""
    s = _read(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    row = F.array(_text("Supplier number ", key), key, F.lit("9"))
    g = s.groupBy(F.col("s_nationkey").alias("t")).agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("row")))), lambda x: x["row"]).alias("body"))
    g = g.where(F.size("body") >= 3)
    rows = F.concat(F.array(F.array(*[F.lit(x) for x in ("Name", "Key", "Note")])), F.col("body"))
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    good = F.array_join(F.concat(F.array(F.lit("| Name | Key | Note |"), F.lit("|---|---|---|")), F.transform("body", line)), "\n")
    narrow = F.array_join(F.concat(F.array(F.lit("| Name | Key |"), F.lit("|---|---|")), F.transform("body", lambda r: line(F.slice(r, 1, 2)))), "\n")  # the widest row counts, so the header lacks the column too
    forms = {
        "good": good, "no rows": F.lit("text"), "two rules": F.concat(good, F.lit("\n|---|---|---|")), "columns": narrow, "header again": F.concat(good, F.lit("\n| Name | Key | Note |")),
        "records": F.concat(good, F.lit("\n| Supplier | 9 | 9 |")), "words": F.replace(good, F.lit("Supplier number"), F.lit("x")), "invented": F.replace(good, F.lit("Supplier number"), F.lit("Supplier number 0.5")),
    }
    each = g.select("t", rows.alias("rows"), F.flatten("body").alias("cells"), F.explode(F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)])).alias("form", "md"))
    return each.select("t", "form", ga.table_fault(F.col("md"), F.col("cells"), F.col("rows"), F.lit(3), F.lit(1)).alias("fault"))


table_gates_sql = """WITH g AS (SELECT s_nationkey::BIGINT AS t FROM supplier GROUP BY 1 HAVING count(*) >= 3)
SELECT t, f AS form, CASE f WHEN 'no rows' THEN 'no_table_structure' WHEN 'two rules' THEN 'multiple_header_blocks' WHEN 'columns' THEN 'column_count_mismatch' WHEN 'header again' THEN 'repeated_header_in_body' WHEN 'records' THEN 'record_count_mismatch'
WHEN 'words' THEN 'word_coverage_low' WHEN 'invented' THEN 'invented_numbers' END AS fault FROM g, (SELECT unnest(['good', 'no rows', 'two rules', 'columns', 'header again', 'records', 'words', 'invented']) AS f)"""


def list_gates(spark, d):
    """Lists of labels and values for each supplier: faithful, as a table, too short, with a new number, without most numbers."""
    k = F.col("s_suppkey")
    cells = F.array(k.cast("string"), (k + 1).cast("string"), F.lit("Label"))
    good = _text("- First label: ", k.cast("string"), "\n- Second label: ", (k + 1).cast("string"))
    form = F.when(k % 5 == 0, good).when(k % 5 == 1, _text("| a | b |\n", good)).when(k % 5 == 2, _text("- First label: ", k.cast("string"))).when(k % 5 == 3, _text(good, "\n- Third: 999999")).otherwise(_text("- First label: ", k.cast("string"), "\n- Second label: none"))
    return _read(spark, d, "supplier").select("s_suppkey", ga.kpi_fault(form, cells).alias("fault"))


list_gates_sql = "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 1 THEN 'pipe_table' WHEN 2 THEN 'no_kpi_list_structure' WHEN 3 THEN 'invented_numbers' WHEN 4 THEN 'missing_numbers' END AS fault FROM supplier"


def tables_lost(spark, d):
    """Verified tables of a brand's parts of whose rows the page has a share that falls with the brand's last digit."""
    part, name = F.col("p_partkey"), F.col("p_name")
    p = _read(spark, d, "part")
    row = _text("| ", name, " ", part.cast("string"), " | x |")
    md_of = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", c.alias("row")))), lambda x: x["row"]), "\n")
    tables = p.groupBy(F.col("p_brand").alias("t")).agg(md_of(row).alias("markdown")).select("t", F.lit("tc001").alias("id"), "markdown", F.lit("regular_table").alias("format"), F.lit(True).alias("complete"))
    pages = p.groupBy(F.col("p_brand").alias("t")).agg(md_of(F.when(part % 5 >= F.substring("p_brand", -1, 1).cast("int") % 5, row).otherwise(F.lit("| other |"))).alias("markdown"))
    return ga.missing_tables(pages, tables, "t")


tables_lost_sql = "SELECT p_brand AS t, 'tc001' AS id FROM part GROUP BY 1 HAVING count(*) FILTER (WHERE p_partkey % 5 >= right(p_brand, 1)::INT % 5) < 0.5 * count(*)"


def page_gates(spark, d):
    """Which documents need no call, which need a repair, and why a later version of them would be refused."""
    k = F.col("doc_id")
    docs = _read(spark, d, "documents")
    usage = F.struct((k % 7 == 0).alias("length_capped"), (k % 11 == 0).alias("decoding_anomaly"), F.lit(False).alias("context_overflow"))
    text = F.coalesce("text", F.lit(""))
    half = F.when(k % 3 == 0, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int"))).otherwise(text)
    faults = ga.repair_faults(text, half, usage, k % 5, F.lit(0), k % 2, F.lit(0), F.lit(0), F.lit(1), k % 4)
    return docs.select("doc_id", ga.is_plain_prose(text, k % 2, F.lit(0), F.lit(False), k % 9 == 0).alias("plain"), ga.needs_repair(k % 8 == 0, F.lit(0), F.lit(0), k % 3 == 0, k % 2, k % 2, F.lit(2), k % 4).alias("repair"), F.array_join(faults, ",").alias("faults"), ga.needs_image(k % 2, F.when(k % 3 == 0, "toc").otherwise("page")).alias("image"))


page_gates_sql = r"""WITH d AS (SELECT doc_id AS k, coalesce(text, '') AS t FROM documents), h AS (SELECT *, CASE WHEN k % 3 = 0 THEN substr(t, 1, length(t) // 2) ELSE t END AS h FROM d),
p AS (SELECT *, regexp_replace(t, '\n$', '') AS a, regexp_replace(h, '\n$', '') AS b FROM h), r AS (SELECT *, len(list_filter(string_split(a, chr(10)), lambda x: starts_with(regexp_replace(x, '^\s+', ''), '|'))) AS ra, len(list_filter(string_split(b, chr(10)), lambda x: starts_with(regexp_replace(x, '^\s+', ''), '|'))) AS rb FROM p)
SELECT k AS doc_id, length(regexp_replace(t, '^\s+|\s+$', '', 'g')) >= 300 AND k % 2 = 0 AND k % 9 <> 0 AS plain, k % 8 = 0 OR (k % 3 = 0 AND k % 2 = 0) OR k % 4 >= 3 AS repair,
concat_ws(',', CASE WHEN k % 7 = 0 THEN 'length_capped' END, CASE WHEN k % 11 = 0 THEN 'decoding_anomaly' END, CASE WHEN length(b) < 0.7 * length(a) THEN 'shrunk_output' END, CASE WHEN rb < ra THEN 'fewer_table_rows' END, CASE WHEN k % 5 > 0 THEN 'content_loss_vs_pre_repair' END,
 CASE WHEN k % 2 > 0 THEN 'duplicate_content_added' END, CASE WHEN k % 4 > 1 THEN 'fewer_table_symbol_instances' END) AS faults, k % 2 > 0 OR k % 3 = 0 AS image FROM r"""

NAMES = (
    "spaces_collapsed", "inline_bullets", "list_glyphs", "cell_lists", "recogniser_marks", "demoted_headings", "uncertain_notes", "unplaced_sections", "footnotes_moved", "breaks_and_notes", "line_counts", "text_flags", "mixed_pairs",
    "text_helpers", "html_tables", "item_fields", "list_levels", "grid_records", "grid_headers", "grid_sections", "picture_rules", "picture_answers", "picture_blocks", "figure_marks", "symbol_lines", "list_indents", "blank_headers",
    "heading_notes", "header_restored", "lost_lines", "section_levels", "table_gates", "list_gates", "tables_lost", "page_gates",
)
