"""Lines of a page taken out and others put in their place: panels as lists, loose pairs, prose out of layout tables, verified
tables over what is left of them, tables that others contain.

Every step finds the positions that go (keys, pos) and the lines that come (keys, pos, part, line); `splice` does the rest in
one window by page.  Tables meet lines over equal cell texts, never by comparing all."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from . import tables as tb
from .lines import island

_BR = r"(?i)<br\s*/?>"
#: Share of a table's cells, cells and distinctive cells that anchor it; fragments and share of the fallback;
#: share of a sectioned table's rows; share of a verified table's rows that back another; rows that are prefixes.
CELLS, SHARE, DISTINCTIVE, FRAGMENTS, FRAGMENT_SHARE, ROWS, BACKED = 2, 0.6, 2, 4, 0.5, 0.5, 0.5


def splice(lines: DataFrame, gone: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Lines without the positions of `gone`, with those of `new` at theirs; numbered anew."""
    kept = lines.join(gone.select(*keys, "pos").distinct(), [*keys, "pos"], "left_anti").select(*keys, "pos", F.lit(-1).alias("part"), "line")
    both = kept.unionByName(new.select(*keys, "pos", F.col("part").cast("int"), "line"))
    return both.select(*keys, (F.row_number().over(Window.partitionBy(*keys).orderBy("pos", "part")) - 1).alias("pos"), "line")


def with_blocks(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.withColumn("block", island(tx.is_pipe_line(F.col("line")), *keys))


def _cell_lines(cell: Column) -> Column:
    """Paragraphs and items of a cell, blank lines between."""
    parts = F.filter(F.transform(F.split(cell, _BR, -1), tx.strip), lambda x: x != "")
    return F.concat(F.flatten(F.transform(parts, lambda x: F.when(F.startswith(x, F.lit("- ")), F.array(x)).otherwise(F.array(x, F.lit(""))))), F.array(F.lit("")))


def unwrapped(blocked: DataFrame, *keys: str) -> DataFrame:
    """(keys, block, pos, lines) of layout tables: under a header of different short labels, each label in bold over its
    column's cells; else the cells row by row."""
    full = blocked.where("block is not null").withColumn("rule", F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z")))
    row = F.when(~F.col("rule"), F.struct(F.col("pos"), tx.split_row(F.col("line")).alias("cells")))
    held = full.groupBy(*keys, "block").agg(F.min("pos").alias("pos"), F.max("rule").alias("ruled"), F.array_sort(F.collect_list(row)).alias("rows"))
    kinds = tb.layout_tables(tb.rows_of(blocked.select(*keys, "pos", "line"), *keys), *keys, "block").where("kind = 'unwrap'")
    held = held.join(kinds, [*keys, "block"], "left_semi").withColumn("rows", F.transform("rows", lambda r: r["cells"]))
    labels = F.transform(F.get("rows", F.lit(0)), tx.collapse_ws)
    held = held.withColumn("labels", F.when(F.col("ruled"), labels).otherwise(F.array().cast("array<string>")))
    named = F.transform(F.filter("labels", lambda x: x != ""), F.lower)
    fits = F.forall("labels", lambda x: (F.length(x) <= 60) & ~tx.is_numeric_cell(x)) & (F.size(named) > 0) & (F.size(F.array_distinct(named)) == F.size(named))
    held = held.withColumn("fits", fits).withColumn("body", F.slice("rows", F.when(F.col("ruled"), 2).otherwise(1), F.size("rows")))
    texts = lambda cells: F.flatten(F.transform(F.filter(cells, lambda c: c != ""), _cell_lines))
    column = lambda x, i: F.when(x == "", F.array().cast("array<string>")).otherwise(F.concat(F.array(F.concat(F.lit("**"), x, F.lit("**")), F.lit("")), texts(F.transform("body", lambda r: F.coalesce(F.get(r, i), F.lit(""))))))
    return held.select(*keys, "block", "pos", F.when(F.col("fits"), F.flatten(F.transform("labels", column))).otherwise(F.flatten(F.transform("body", texts))).alias("lines"))


def reshaped(lines: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gone, new, counts) of panels that become lists, loose values and labels that pair up, and layout tables that become
    prose.  They are apart from each other, so one splice serves them all."""
    blocked = with_blocks(lines, *keys)
    rows = tb.rows_of(lines, *keys)
    listed = tb.panel_lists(rows.select(*keys, "block", "r", "cells"), *keys, "block").withColumnRenamed("pos", "part")
    starts = blocked.where("block is not null").groupBy(*keys, "block").agg(F.min("pos").alias("pos"))
    prose = unwrapped(blocked, *keys).join(listed.select(*keys, "block").distinct(), [*keys, "block"], "left_anti")
    pairs = tb.text_pairs(lines, *keys)
    spans = pairs.groupBy(*keys, "run").agg(F.min("first").alias("a"), F.max("last").alias("b"))
    blocks = listed.select(*keys, "block").distinct().unionByName(prose.select(*keys, "block"))
    gone = blocked.join(blocks, [*keys, "block"], "left_semi").select(*keys, "pos").unionByName(spans.select(*keys, F.explode(F.sequence("a", "b")).alias("pos")))
    new = [
        listed.join(starts, [*keys, "block"]).select(*keys, "pos", "part", "line"),
        prose.select(*keys, "pos", F.posexplode(F.concat(F.array(F.lit("")), "lines")).alias("part", "line")),
        pairs.select(*keys, F.col("first").alias("pos"), F.lit(0).alias("part"), "line"),
    ]
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias("n")).select(*keys, F.lit(name).alias("name"), "n")
    counts = [count(listed.select(*keys, "block").distinct(), "panels_converted"), count(prose, "layout_tables_unwrapped"), count(pairs, "text_pairs")]
    return gone, reduce(DataFrame.unionByName, new), reduce(DataFrame.unionByName, counts)


def _pieces(cells: Column) -> Column:
    """Cell texts and the parts of their lists, lower-cased."""
    low = F.transform(cells, lambda c: F.lower(tx.collapse_ws(c)))
    parts = F.flatten(F.transform(low, lambda c: F.transform(F.split(c, _BR, -1), lambda x: tx.strip(F.regexp_replace(x, r"^-\s+", "")))))
    return F.filter(F.array_distinct(F.concat(low, parts)), lambda x: x != "")


def _fragments(cells: Column) -> Column:
    cut = F.flatten(F.transform(cells, lambda c: F.split(c, r"(?i)<br\s*/?>|[•●▪◦‣■]", -1)))
    plain = F.transform(cut, lambda x: F.lower(tx.collapse_ws(F.regexp_replace(tx.collapse_ws(x), r"^[-*•●▪◦‣■]\s*", ""))))
    return F.filter(F.array_distinct(plain), lambda x: (x != "") & tx.is_distinctive_cell(x))


def place_tables(lines: DataFrame, tables: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gone, new, counts) that put verified tables over what a page still has of them.

    tables: (keys, table, kind, markdown, source, titles): kind is `table` or `sections`; source holds the grid's cells, titles
    those of the sections.  A pipe table anchors one when enough of its cells are cells of it; so do headings and items that
    are one of its texts.  The table goes where its first anchor was.  Without anchors, tables meet over distinctive fragments of
    lists; a table of sections without any anchor is appended, another one never is.  A line goes to the first table that
    claims it."""
    own = F.filter(F.split("markdown", "\n"), lambda x: tx.is_pipe_line(x) & ~F.rlike(tx.strip(x), F.lit(r"^[|\-: ]+\z")))
    t = tables.withColumn("cells", F.concat(F.flatten(F.transform(own, tx.split_row)), F.coalesce("source", F.array().cast("array<string>"))))
    t = t.withColumn("titles", F.transform(F.coalesce("titles", F.array().cast("array<string>")), lambda x: F.lower(tx.collapse_ws(x))))
    words = t.select(*keys, "table", F.explode(F.array_union(_pieces(F.col("cells")), F.col("titles"))).alias("text"))
    blocked = with_blocks(lines, *keys)
    rows = tb.rows_of(lines, *keys)
    cells = rows.select(*keys, "block", F.explode(F.filter("cells", lambda c: c != "")).alias("cell")).withColumn("text", F.lower(tx.collapse_ws(F.col("cell"))))
    sizes = cells.groupBy(*keys, "block").agg(F.count("*").alias("cells"))
    met = cells.groupBy(*keys, "block", "text").agg(F.count("*").alias("n")).join(words, [*keys, "text"])
    met = met.groupBy(*keys, "block", "table").agg(F.sum("n").alias("hits"), F.sum(F.when(tx.is_distinctive_cell(F.col("text")), F.col("n")).otherwise(0)).alias("own")).join(sizes, [*keys, "block"])
    cell_hits = met.where((F.col("hits") >= CELLS) & (F.col("hits") >= SHARE * F.col("cells")) & (F.col("own") >= DISTINCTIVE)).select(*keys, "block", "table")
    # a table of sections is known by whole rows
    low = lambda c: F.transform(c, lambda x: F.lower(tx.collapse_ws(x)))
    banded = t.where("kind = 'sections'").select(*keys, "table", F.explode(F.array_distinct(F.transform(own, lambda x: low(tx.split_row(x))))).alias("cells"))
    row_hits = rows.select(*keys, "block", "r", low(F.col("cells")).alias("cells")).join(banded, [*keys, "cells"]).groupBy(*keys, "block", "table").agg(F.count("*").alias("hits"))
    row_hits = row_hits.join(rows.groupBy(*keys, "block").agg(F.count("*").alias("n")), [*keys, "block"]).where(F.col("hits") >= ROWS * F.col("n")).select(*keys, "block", "table")
    exact = cell_hits.unionByName(row_hits).distinct()
    head, item = F.regexp_extract(tx.strip(F.col("line")), tx.HEADING, 2), F.regexp_extract(tx.strip(F.col("line")), r"^[-*]\s+(.+)$", 1)
    loose = blocked.where("block is null").withColumn("text", F.lower(tx.collapse_ws(F.when(head != "", head).otherwise(F.split(item, ":")[0])))).where("text != ''")
    at_lines = loose.select(*keys, "pos", "text").join(words, [*keys, "text"]).select(*keys, "table", "pos")
    anchors = blocked.join(exact, [*keys, "block"]).select(*keys, "table", "pos").unionByName(at_lines).distinct()
    left = t.join(anchors.select(*keys, "table").distinct(), [*keys, "table"], "left_anti")
    wanted = left.where("kind != 'sections'").withColumn("f", _fragments(F.col("cells"))).where(F.size("f") >= FRAGMENTS).select(*keys, "table", F.explode("f").alias("text"))
    theirs = rows.groupBy(*keys, "block").agg(F.flatten(F.collect_list("cells")).alias("cells")).select(*keys, "block", _fragments(F.col("cells")).alias("f")).withColumn("n", F.size("f"))
    near = theirs.select(*keys, "block", "n", F.explode("f").alias("text")).join(wanted, [*keys, "text"]).groupBy(*keys, "block", "n", "table").agg(F.count("*").alias("hits"))
    near = near.where((F.col("hits") >= FRAGMENTS) & (F.col("hits") >= FRAGMENT_SHARE * F.col("n"))).select(*keys, "block", "table")
    anchors = anchors.unionByName(blocked.join(near, [*keys, "block"]).select(*keys, "table", "pos"))
    anchors = anchors.groupBy(*keys, "pos").agg(F.min("table").alias("table"))
    places = anchors.groupBy(*keys, "table").agg(F.min("pos").alias("pos"))
    ends = lines.groupBy(*keys).agg((F.max("pos") + 1).alias("end"))
    put = t.join(places, [*keys, "table"], "left").join(ends, list(keys), "left").where("pos is not null or kind = 'sections'")
    put = put.withColumn("pos", F.coalesce("pos", "end", F.lit(0)))
    text = F.concat(F.array(F.lit("")), F.split(F.regexp_replace("markdown", r"\n+\z", ""), "\n"), F.array(F.lit("")))
    # two tables may be appended at the same place
    new = put.select(*keys, "pos", "table", F.posexplode(text).alias("at", "line"))
    new = new.withColumn("part", F.row_number().over(Window.partitionBy(*keys, "pos").orderBy("table", "at")) - 1)
    counts = put.groupBy(*keys).agg(F.count("*").alias("n")).select(*keys, F.lit("tables_enforced").alias("name"), "n")
    return anchors.select(*keys, "pos"), new.select(*keys, "pos", "part", "line"), counts


def subset_blocks(lines: DataFrame, tables: DataFrame, *keys: str) -> DataFrame:
    """(keys, block) of tables that are subsets of another table of the page that a verified one backs.  Of two that hold
    each other the earlier goes."""
    rows = tb.rows_of(lines, *keys)
    low = lambda c: F.transform(c, lambda x: F.lower(tx.collapse_ws(x)))
    own = F.filter(F.split("markdown", "\n"), lambda x: tx.is_pipe_line(x) & ~F.rlike(tx.strip(x), F.lit(r"^[|\-: ]+\z")))
    sure = tables.select(*keys, "table", F.explode(F.array_distinct(F.transform(own, lambda x: low(tx.split_row(x))))).alias("cells"))
    all_ = sure.groupBy(*keys, "table").agg(F.count("*").alias("n"))
    met = rows.select(*keys, "block", low(F.col("cells")).alias("cells")).distinct().join(sure, [*keys, "cells"]).groupBy(*keys, "block", "table").agg(F.count("*").alias("hits"))
    backed = met.join(all_, [*keys, "table"]).where(F.col("hits") >= BACKED * F.col("n")).select(F.struct(*keys).alias("_page"), F.col("block").alias("other")).distinct()
    subsets = tb.subset_tables(rows.select(F.struct(*keys).alias("_page"), "block", "cells"), "_page", "block").join(backed, ["_page", "other"])
    back = subsets.select("_page", F.col("other").alias("block"), F.col("block").alias("other"), F.lit(True).alias("mutual"))
    gone = subsets.join(back, ["_page", "block", "other"], "left").where("mutual is null or block < other")
    return gone.select(*[F.col(f"_page.{k}").alias(k) for k in keys], "block").distinct()


@F.pandas_udf(T.BooleanType())
def _shares_a_block(probes: pd.Series, bodies: pd.Series) -> pd.Series:
    """Whether seven tenths of a probe (12 characters or more) stand in the body as one block; the body's index is made once."""
    import difflib

    matcher, seen, out = difflib.SequenceMatcher(None), None, []
    for probe, body in zip(probes, bodies, strict=True):
        if body is None or not probe:
            out.append(False)
            continue
        if body != seen:
            matcher.set_seq2(body)
            seen = body
        matcher.set_seq1(probe)
        out.append(matcher.find_longest_match(0, len(probe), 0, len(body)).size >= max(12, int(len(probe) * 0.7)))
    return pd.Series(out, dtype=bool)


def without_shared_blocks(missing: DataFrame, bodies: DataFrame, *keys: str) -> DataFrame:
    """Missing lines (keys, pos, line) of which no long block stands in the page's body (keys, body).  This is the last of the
    tests, on the few lines that are left."""
    held = missing.join(bodies.select(*keys, F.lower("body").alias("_body")), list(keys), "left")
    return held.where(~_shares_a_block(F.substring(F.lower("line"), 1, 80), "_body")).select(*missing.columns)
