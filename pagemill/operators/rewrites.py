"""Rewrites of a page's Markdown that need other records beside it: levels of lists, missing headers, sections, merged headers, lines set
aside; and what is told about headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grids as gr
from ..functions import text as tx
from ..functions.bind import bind
from . import lines as ln
from . import tables as tb
from .splice import splice, with_blocks

#: Share of a part's words that a window must hold to count as there; deepest level of a list.
PRESENT, DEEPEST = 0.85, 2


def heading_warnings(lines: DataFrame, raw: DataFrame, pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, warning): pages without a heading, and those with fewer levels of headings than their raw text."""
    own = ln.heading_levels(lines, *keys)
    theirs = ln.heading_levels(raw, *keys).withColumnRenamed("levels", "raw_levels")
    met = pages.select(*keys).distinct().join(own, list(keys), "left").join(theirs, list(keys), "left")
    none = F.array().cast("array<int>")
    met = met.withColumn("levels", F.coalesce("levels", none)).withColumn("raw_levels", F.coalesce("raw_levels", none))
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ", "), F.lit("]"))
    fewer = F.concat(F.lit("fewer heading levels "), listed("levels"), F.lit(" than the raw text "), listed("raw_levels"))
    some = F.array_compact(F.array(F.when(F.size("levels") == 0, "no heading on the page"), F.when((F.size("raw_levels") > 0) & (F.size("levels") < F.size("raw_levels")), fewer)))
    return met.select(*keys, F.explode(some).alias("warning"))


def apply_list_levels(lines: DataFrame, specs: DataFrame, *keys: str) -> DataFrame:
    """Lines of lists indented as specs (keys, text, level) say: the first line whose text is that of exactly one spec of the page."""
    text = F.when(F.rlike("line", F.lit(r"^\s*[-*+]\s+")), tx.collapse_ws(F.regexp_extract("line", r"^\s*[-*+]\s+(.*)$", 1)))
    known = specs.select(*keys, tx.collapse_ws(F.col("text")).alias("content"), F.greatest(F.lit(0), F.least(F.lit(DEEPEST), "level")).alias("level"))
    known = known.groupBy(*keys, "content").agg(F.count("*").alias("n"), F.first("level").alias("level")).where("n = 1 and content != ''").drop("n")
    met = lines.withColumn("content", text).join(known, [*keys, "content"], "left")
    first = F.row_number().over(Window.partitionBy(*keys, "content").orderBy("pos")) == 1
    new = F.when(F.col("level").isNotNull() & first, F.concat(F.repeat(F.lit("  "), F.col("level")), F.lit("- "), F.col("content"))).otherwise(F.col("line"))
    return met.select(*keys, "pos", new.alias("line"))


def add_blank_headers(lines: DataFrame, first_rows: DataFrame, *keys: str) -> DataFrame:
    """Tables that start with a row known to be no header (keys, cells) get an empty one and a rule; their other rules go."""
    low = lambda c: F.transform(c, lambda x: F.lower(tx.collapse_ws(x)))
    wanted = first_rows.where(F.size("cells") > 0).select(*keys, low(F.col("cells")).alias("key")).distinct()
    rows = tb.rows_of(lines, *keys)
    starts = rows.where("r = 0").select(*keys, "block", low(F.col("cells")).alias("key")).join(wanted, [*keys, "key"], "left_semi").select(*keys, "block")
    blocked = with_blocks(lines, *keys).join(starts, [*keys, "block"])
    width = rows.join(starts, [*keys, "block"], "left_semi").groupBy(*keys, "block").agg(F.max(F.size("cells")).alias("width"))
    at = blocked.groupBy(*keys, "block").agg(F.min("pos").alias("pos")).join(width, [*keys, "block"])
    blank = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit(""), F.col("width").cast("int")), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.col("width")))
    new = at.select(*keys, "pos", F.posexplode(F.array(blank, rule)).alias("part", "line")).withColumn("part", F.col("part") - 3)  # before the line that stands there
    gone = blocked.where(F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z"))).select(*keys, "pos")
    return splice(lines, gone, new, *keys)


def sections(rows: Column, header_rows: Column) -> Column:
    """struct(header, n_cols, sections) of a grid that titles cut into sections; else null.  Sections are struct(title, qualifiers, rows,
    source_rows, is_group): a title without rows of its own, before another, heads a group; one in brackets under a fresh title is its
    qualifier.  A fold over the rows of one table."""
    body = "array<struct<title:string,qualifiers:array<string>,rows:array<array<string>>,source_rows:array<int>>>"
    words, none = F.array().cast("array<string>"), F.array().cast("array<array<string>>")

    def of(all_: Column) -> Column:
        cols = gr.widest(all_)
        padded = F.transform(all_, lambda r: tx.pad_row(r, cols))
        fresh = lambda title: F.struct(title.alias("title"), words.alias("qualifiers"), none.alias("rows"), F.array().cast("array<int>").alias("source_rows"))

        def step(a: Column, x: Column) -> Column:
            title, last = tx.section_title(x["cells"]), F.element_at(a, -1)
            rest = F.slice(a, F.lit(1), F.size(a) - 1)
            note = F.startswith(title, F.lit("(")) & last["title"].isNotNull() & (F.size(last["rows"]) == 0)
            told = F.concat(rest, F.array(last.withField("qualifiers", F.concat(last["qualifiers"], F.array(title)))))
            more = last.withField("rows", F.concat(last["rows"], F.array(x["cells"]))).withField("source_rows", F.concat(last["source_rows"], F.array(x["at"])))
            return F.when(title.isNull(), F.concat(rest, F.array(more))).when(F.coalesce(note, F.lit(False)), told).otherwise(F.concat(a, F.array(fresh(title)))).cast(body)

        data = F.transform(F.slice(padded, F.lit(2), F.greatest(F.lit(0), F.size(padded) - 1)), lambda r, i: F.struct(r.alias("cells"), (i + 1).alias("at")))
        cut = F.aggregate(data, F.array(fresh(F.lit(None).cast("string"))).cast(body), step)

        def gated(found: Column) -> Column:
            kept = F.filter(found, lambda s: s["title"].isNotNull() | (F.size(s["rows"]) > 0))
            last = F.array_max(F.transform(kept, lambda s, i: F.when(F.size(s["rows"]) > 0, i)))
            kept = F.slice(kept, F.lit(1), F.coalesce(last + 1, F.lit(0)))  # titles at the end without rows head nothing
            marked = F.transform(kept, lambda s: F.struct(s["title"], s["qualifiers"], s["rows"], s["source_rows"], (s["title"].isNotNull() & (F.size(s["rows"]) == 0)).alias("is_group")))
            header = F.get(padded, F.lit(0))
            full = F.filter(header, lambda c: c != "")
            plausible = (F.coalesce(header_rows, F.lit(0)) >= 1) | ((F.size(full) * 2 >= F.size(header)) & F.forall(full, lambda c: F.length(c) <= 40))
            own = F.transform(F.filter(kept, lambda s: s["title"].isNotNull()), lambda s: F.size(s["rows"]))
            rows_in = F.aggregate(F.transform(kept, lambda s: F.size(s["rows"])), F.lit(0), lambda a, n: a + n)
            good = (F.size(all_) >= 4) & (cols >= 3) & tx.section_title(header).isNull() & plausible & (F.coalesce(F.array_max(own), F.lit(0)) >= 2) & (rows_in >= 2)
            return F.when(F.coalesce(good, F.lit(False)), F.struct(header.alias("header"), cols.alias("n_cols"), marked.alias("sections")))

        return bind(cut, gated)

    return bind(gr.stripped(rows), of)


def section_kinds(split: Column) -> Column:
    return F.transform(F.filter(split["sections"], lambda s: s["title"].isNotNull()), lambda s: F.when(s["is_group"], "group").otherwise("data"))


def render_sections(split: Column, level: Column) -> Column:
    """Sections as headings over tables that repeat the header; under groups, sections are a level deeper."""
    deep = level + F.when(F.exists(split["sections"], lambda s: s["is_group"]), 1).otherwise(0)
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(tx.pad_row(r, split["n_cols"]), lambda c: F.replace(c, F.lit("|"), F.lit(r"\|"))), " | "), F.lit(" |"))
    rule = tx.separator_row(split["n_cols"])

    def one(s: Column) -> Column:
        head = F.when(s["title"].isNotNull(), tx.sectioned_heading(s["title"], s["qualifiers"], F.when(s["is_group"], level).otherwise(deep)))
        table = F.when(F.size(s["rows"]) > 0, F.array_join(F.concat(F.array(line(split["header"]), rule), F.transform(s["rows"], lambda r: line(F.transform(r, tx.cell_with_bullets)))), "\n"))
        return F.array_join(F.array_compact(F.array(head, table)), "\n\n")

    return F.array_join(F.transform(split["sections"], one), "\n\n")


def matches_title(text: Column, titles: Column) -> Column:
    """A heading that is a section's title, with a note in brackets or without."""
    flat = F.lower(tx.collapse_ws(text))
    return F.exists(titles, lambda t: (flat == t) | F.startswith(flat, F.concat(t, F.lit(" ("))))


def base_levels(lines: DataFrame, places: DataFrame, *keys: str) -> DataFrame:
    """(keys, table, level): a level below the nearest heading before a place (keys, table, pos, titles) that is none of the table's own
    titles; 3 without one."""
    heads = lines.select(*keys, F.col("pos").alias("at"), F.length(F.regexp_extract(tx.strip(F.col("line")), tx.HEADING, 1)).alias("depth"), F.regexp_extract(tx.strip(F.col("line")), tx.HEADING, 2).alias("head")).where("depth > 0")
    met = places.join(heads, list(keys), "left").where((F.col("at") < F.col("pos")) & ~matches_title(F.col("head"), F.col("titles")))
    near = met.groupBy(*keys, "table").agg((F.max_by("depth", "at") + 1).alias("level"))
    return places.select(*keys, "table").join(near, [*keys, "table"], "left").select(*keys, "table", F.coalesce("level", F.lit(3)).alias("level"))


def relevel(markdown: Column, kinds: Column, level: Column) -> Column:
    """The text of sections with its n-th heading at the level of the n-th kind."""
    deep = level + F.when(F.array_contains(kinds, "group"), 1).otherwise(0)
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        title = F.regexp_extract(x, r"^#{1,6}\s+(.*)$", 1)
        is_head = F.rlike(x, F.lit(r"^#{1,6}\s+")) & (a["n"] < F.size(kinds))
        depth = F.greatest(F.lit(1), F.least(F.lit(6), F.when(F.get(kinds, a["n"]) == "group", level).otherwise(deep)))
        new = F.when(is_head, F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), title)).otherwise(x)
        return F.struct(F.concat(a["out"], F.array(new)).alias("out"), (a["n"] + F.when(is_head, 1).otherwise(0)).alias("n"))

    return F.array_join(F.aggregate(F.split(markdown, "\n", -1), start, step, lambda a: a["out"]), "\n")


def present_parts(lines: DataFrame, body: DataFrame, furniture: DataFrame | None, *keys: str) -> DataFrame:
    """Lines (keys, pos, line) that a page seems to lack, with `reason` where they are not missing after all: one phrase over and over,
    margin text, or every part of the line (between wide blanks) stands in the body.

    A part of words stands there if one window of three lines holds 85 % of them and all its numbers; one of numbers if the body has it
    literally.  Parts meet windows over their words, each page on its own, in merge joins by hint: what is joined grows with the pages, and
    the size of a file does not tell that it is too much for a broadcast."""
    t = tx.strip(F.col("line"))
    parts = F.filter(F.split(t, r"(?U)\s{2,}", -1), lambda p: p != "")
    rows = lines.withColumn("parts", parts).withColumn("norm", tx.furniture_text(t)).where(t != "")
    again = (F.size("parts") >= 2) & (F.size(F.array_distinct("parts")) == 1)
    each = rows.select(*keys, "pos", F.posexplode("parts").alias("at", "part"))
    words = F.array_distinct(F.filter(tx.significant_words(F.col("part")), lambda w: ~F.rlike(w, F.lit(r"\d"))))
    each = each.withColumn("words", words).withColumn("nums", tx.numeric_tokens(F.col("part")))
    windows = ln.body_windows(body, *keys).withColumn("w", F.xxhash64("words", "numbers")).select(*keys, "w", F.col("words").alias("have"), "numbers").dropDuplicates([*keys, "w"])
    spoken = each.where(F.size("words") > 0)
    met = spoken.select(*keys, "pos", "at", "nums", F.size("words").alias("n"), F.explode("words").alias("word")).join(windows.select(*keys, "w", "numbers", F.explode("have").alias("word")).hint("merge"), [*keys, "word"])
    met = met.where(F.size(F.array_except("nums", "numbers")) == 0).groupBy(*keys, "pos", "at", "w").agg(F.count("*").alias("hits"), F.first("n").alias("n"))
    there = met.where(F.col("hits") >= PRESENT * F.col("n")).select(*keys, "pos", "at").distinct().withColumn("found", F.lit(True))
    whole = ln.from_lines(body, *keys, name="body").select(*keys, tx.collapse_ws(F.lower("body")).alias("body"))
    literal = each.where((F.size("words") == 0) & (F.size("nums") > 0)).join(whole.hint("merge"), list(keys), "left").where(F.contains("body", tx.collapse_ws(F.lower("part")))).select(*keys, "pos", "at", F.lit(True).alias("literal"))
    judged = each.join(there.hint("merge"), [*keys, "pos", "at"], "left").join(literal.hint("merge"), [*keys, "pos", "at"], "left")
    ok = F.when(F.size("words") > 0, F.col("found")).when(F.size("nums") > 0, F.col("literal")).otherwise(F.lit(True))
    all_ = judged.groupBy(*keys, "pos").agg(F.min(F.coalesce(ok, F.lit(False))).alias("present"))
    out = rows.join(all_.hint("merge"), [*keys, "pos"], "left")
    if furniture is not None:
        out = out.join(furniture.select(*keys, "norm").distinct().withColumn("margin", F.lit(True)).hint("merge"), [*keys, "norm"], "left")
    else:
        out = out.withColumn("margin", F.lit(None).cast("boolean"))
    reason = F.when(again, "repeated phrase").when(F.col("margin"), "margin text").when(F.col("present"), "present")
    return out.select(*keys, "pos", "line", reason.alias("reason"))


def merged_headers(lines: DataFrame, grids: DataFrame, *keys: str) -> DataFrame:
    """(keys, pos, line, table): header rows of written tables that lost labels of their source's header, written anew.

    A table's header is collapsed if it has fewer labels than the source's, all of them labels (or parts of labels) of it, its rows
    have the source's width, and half of the rows of either share a number (or, without numbers, a value) with the other.  Of several
    sources the first by `table` is taken.  grids: (keys, table, rows, num_cols, header_rows)."""
    low = lambda c: F.transform(c, lambda x: F.lower(tx.collapse_ws(x)))
    rows = tb.rows_of(lines, *keys).withColumn("low", low(F.col("cells")))
    own = rows.where("r = 0").select(*keys, "block", "pos", F.filter("low", lambda x: x != "").alias("labels"))
    body = rows.where("r > 0").select(*keys, "block", "r", "low", F.size("cells").alias("wide"), tx.numeric_tokens(F.array_join("low", " ")).alias("nums"))
    shape = body.groupBy(*keys, "block").agg(F.min("wide").alias("least"), F.max("wide").alias("most"), F.count("*").alias("body_rows"))
    g = grids.withColumn("all", gr.stripped(F.col("rows"))).withColumn("heads", gr.header_row_count(F.col("all"), F.col("header_rows"))).withColumn("cols", gr.column_count(F.col("all"), F.col("num_cols"))).where("heads >= 1 and cols >= 1")
    g = g.withColumn("header", gr.merged_header(F.col("all"), F.col("heads"), F.col("cols")))
    pieces = F.array_distinct(F.flatten(F.transform("header", lambda h: F.filter(F.concat(F.array(h), F.split(h, r"(?i)<br\s*/?>", -1)), lambda x: x != ""))))
    g = g.select(*keys, "table", "header", "cols", low(pieces).alias("known"), F.size(F.filter("header", lambda h: h != "")).alias("n"), F.slice("all", F.col("heads") + 1, F.greatest(F.lit(0), F.size("all") - F.col("heads"))).alias("source"))
    met = own.join(shape, [*keys, "block"]).join(g, list(keys))
    met = met.where((F.size("labels") > 0) & (F.size("labels") < F.col("n")) & (F.size(F.array_except("labels", "known")) == 0) & (F.col("least") == F.col("cols")) & (F.col("most") == F.col("cols")))
    each = met.select(*keys, "block", "table", F.posexplode("source").alias("s", "cells")).withColumn("snums", tx.numeric_tokens(F.array_join("cells", " "))).withColumn("vals", F.filter(low(F.col("cells")), lambda x: x != ""))
    token = F.explode(F.when(F.size("snums") > 0, F.transform("snums", lambda x: F.concat(F.lit("n:"), x))).otherwise(F.transform("vals", lambda x: F.concat(F.lit("v:"), x))))
    theirs = body.select(*keys, "block", F.explode(F.concat(F.transform("nums", lambda x: F.concat(F.lit("n:"), x)), F.transform(F.filter("low", lambda x: x != ""), lambda x: F.concat(F.lit("v:"), x)))).alias("token")).distinct()
    hits = each.select(*keys, "block", "table", "s", token.alias("token")).join(theirs, [*keys, "block", "token"], "left_semi").groupBy(*keys, "block", "table").agg(F.countDistinct("s").alias("hits"))
    good = met.join(hits, [*keys, "block", "table"]).where(F.col("hits") >= F.greatest(F.lit(1), F.floor((F.least(F.size("source"), "body_rows") + 1) / 2)))
    best = good.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "block").orderBy("table"))).where("k = 1")
    return best.select(*keys, "pos", tx.render_row(F.col("header")).alias("line"), "table")


def apply_lines(lines: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Lines with others at some positions (keys, pos, line)."""
    met = lines.join(new.select(*keys, "pos", F.col("line").alias("_line")), [*keys, "pos"], "left")
    return met.select(*keys, "pos", F.coalesce("_line", "line").alias("line"))


def mixed_pair(text: Column) -> Column:
    """struct(label, value) of a line that holds both: a rating with its footnote mark before a label, else the longest value before a
    label, else the longest label before a value; a year alone is no value."""
    t = tx.strip(text)
    rating = r"^([A-Z][a-zA-Z]{0,3}[+-]?\d?)\s+(\((?:[A-Za-z]|\d{1,2})\))\s+(.+)$"
    label = F.regexp_extract(t, rating, 3)
    words = F.split(t, r"(?U)\s+", -1)
    n = F.size(words)

    def cut(k: Column) -> Column:
        return F.struct(F.array_join(F.slice(words, F.lit(1), k), " ").alias("a"), F.array_join(F.slice(words, k + 1, n), " ").alias("b"))

    cuts = F.when(n >= 2, F.transform(F.sequence(n - 1, F.lit(1), F.lit(-1)), cut)).otherwise(F.array().cast("array<struct<a:string,b:string>>"))
    fits = lambda value, name: tx.is_value_text(value) & tx.is_label_text(name) & ~tx.is_bare_year(value)
    first, second = F.get(F.filter(cuts, lambda c: fits(c["a"], c["b"])), F.lit(0)), F.get(F.filter(cuts, lambda c: fits(c["b"], c["a"])), F.lit(0))
    pair = lambda name, value: F.struct(name.alias("label"), value.alias("value"))
    rated = F.rlike(t, F.lit(rating)) & tx.is_label_text(label)
    return (
        F.when(rated, pair(label, F.concat_ws(" ", F.regexp_extract(t, rating, 1), F.regexp_extract(t, rating, 2)))).when(first.isNotNull(), pair(first["b"], first["a"])).when(second.isNotNull(), pair(second["a"], second["b"]))
    )


def line_kind(line: Column) -> Column:
    """VALUE, MIXED, LABEL or OTHER: how a loose line takes part in a run of values and labels."""
    content = tx.strip(F.regexp_replace(line, r"^\s*-\s+", ""))
    return F.when(tx.is_value_text(content), "VALUE").when(mixed_pair(content).isNotNull(), "MIXED").when(tx.is_label_text(content), "LABEL").otherwise("OTHER")
