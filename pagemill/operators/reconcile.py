"""Table grids held against the page: rules, words and the recogniser's cells as rows, joined step by step over all tables at once.

Tables are (page, table, rect); cells (page, table, r, c, text, rect, header, row0, row1, col0, col1), where row0 to col1 tell which
rows and columns the cell's owner covers (ends exclusive); lines (page, block, line, text, rect); rules (page, y, x0, x1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from .artifacts import rule_boundaries
from .layout import merge_segments
from .visual import comparison_key, tokens_preserved

#: Thickness and length of a rule, share of a line in its column, of a column's tokens that must be found, grey levels by
#: which a rule differs from what is beside it, distance of the samples in heights of a line.
THIN, LONG, IN_COLUMN, ALIGNED, CONTRAST, OFFSET = 0.008, 0.03, 0.5, 0.8, 18.0, 0.3
T = ("page", "table")


def page_lines(words: DataFrame) -> DataFrame:
    """(page, block, line, text, rect) from words (page, block, line, word, text, x0, y0, x1, y1, page_w, page_h) in their order."""
    w = words.where((F.btrim("text") != "") & (F.col("page_w") > 0) & (F.col("page_h") > 0))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word", "text"))), lambda x: x["text"]), " ")
    sides = F.array(F.min(F.col("x0") / F.col("page_w")), F.min(F.col("y0") / F.col("page_h")), F.max(F.col("x1") / F.col("page_w")), F.max(F.col("y1") / F.col("page_h")))
    return w.groupBy("page", "block", "line").agg(text.alias("text"), sides.alias("rect"))


def dividers(strokes: DataFrame) -> DataFrame:
    """(page, axis, at, lo, hi): thin and long strokes (page, x0, y0, x1, y1, page_w, page_h), pieces of one rule joined."""
    s = strokes.where((F.col("page_w") > 0) & (F.col("page_h") > 0))
    x = [F.least("x0", "x1") / F.col("page_w"), F.greatest("x0", "x1") / F.col("page_w")]
    y = [F.least("y0", "y1") / F.col("page_h"), F.greatest("y0", "y1") / F.col("page_h")]
    axis = F.when((y[1] - y[0] <= THIN) & (x[1] - x[0] >= LONG), "h").when((x[1] - x[0] <= THIN) & (y[1] - y[0] >= LONG), "v")
    at, lo, hi = (F.when(F.col("axis") == "h", a).otherwise(b) for a, b in (((y[0] + y[1]) / 2, (x[0] + x[1]) / 2), (x[0], y[0]), (x[1], y[1])))
    found = s.withColumn("axis", axis).where("axis is not null").select("page", "axis", at.alias("at"), lo.alias("lo"), hi.alias("hi"))
    return merge_segments(found, "page", "axis")


def owners(cells: DataFrame) -> DataFrame:
    """(page, table, row0, col0, row1, col1, text, header, rects): one row for each owner, however many places repeat it."""
    first = F.struct("r", "c")
    key = [*T, F.coalesce("row0", "r").alias("row0"), F.coalesce("col0", "c").alias("col0")]
    return cells.groupBy(*key).agg(
        F.min_by(F.coalesce("row1", F.coalesce("row0", "r") + 1), first).alias("row1"), F.min_by(F.coalesce("col1", F.coalesce("col0", "c") + 1), first).alias("col1"),
        F.min_by(F.coalesce("text", F.lit("")), first).alias("text"), F.min_by(F.coalesce("header", F.lit(False)), first).alias("header"), F.collect_list("rect").alias("rects"),
    )


def single(o: DataFrame) -> DataFrame:
    return o.where(F.col("col1") - F.col("col0") == 1)


def column_intervals(o: DataFrame) -> DataFrame:
    """(page, table, col, left, right): how far the cells of a column reach that cover no other."""
    flat = single(o).select(*T, F.col("col0").alias("col"), F.explode("rects").alias("rect"))
    return flat.groupBy(*T, "col").agg(F.min(F.col("rect")[0]).alias("left"), F.max(F.col("rect")[2]).alias("right"))


def spanned_columns(o: DataFrame, header_rows: DataFrame) -> DataFrame:
    """(page, table, col) that a body cell covers together with another."""
    wide = o.join(header_rows, list(T)).where((F.col("row0") >= F.col("heads")) & (F.col("col1") - F.col("col0") > 1))
    return wide.select(*T, F.explode(F.sequence("col0", F.col("col1") - 1)).alias("col")).distinct()


def bands_of(bounds: DataFrame) -> DataFrame:
    """(page, table, edges): boundaries of a table from top to bottom; those with two or more make bands."""
    return bounds.groupBy(*T).agg(F.array_sort(F.collect_list("y")).alias("edges")).where(F.size("edges") >= 2)


def band_at(y: Column, edges: Column) -> Column:
    """The band that holds a height: the first whose end lies below it, else the last."""
    return F.least(F.size(edges) - 2, F.size(F.filter(F.slice(edges, F.lit(2), F.size(edges) - 1), lambda e: e <= y))).cast("int")


def lines_in_columns(lines: DataFrame, tables: DataFrame, intervals: DataFrame) -> DataFrame:
    """(page, table, col, block, line, text, rect): lines of a table with the column that holds most of them, half at least; the first of
    equals."""
    r, t = F.col("rect"), F.col("own")
    inside = lines.join(tables.select(*T, F.col("rect").alias("own")), "page").where((r[2] > t[0]) & (r[0] < t[2]) & (r[3] > t[1]) & (r[1] < t[3]) & (r[2] > r[0]))
    met = inside.join(intervals, list(T)).withColumn("over", F.least(r[2], "right") - F.greatest(r[0], "left")).where("over > 0")
    best = met.withColumn("k", F.row_number().over(Window.partitionBy(*T, "block", "line").orderBy(F.col("over").desc(), "col"))).where("k = 1")
    return best.where(F.col("over") / (r[2] - r[0]) >= IN_COLUMN).select(*T, "col", "block", "line", "text", "rect")


def components(placed: DataFrame, bands: DataFrame) -> DataFrame:
    """(page, table, col, block, text, rect, band, lines): the lines of one block of the page within one column, between the first and the
    last boundary."""
    r = F.col("rect")
    middle = (r[1] + r[3]) / 2
    met = placed.join(bands, list(T)).where((middle >= F.get("edges", F.lit(0))) & (middle <= F.element_at("edges", -1)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(r[1].alias("top"), r[0].alias("left"), "line", "text"))), lambda x: x["text"]), " ")
    out = met.groupBy(*T, "col", "block").agg(text.alias("text"), F.array(F.min(r[0]), F.min(r[1]), F.max(r[2]), F.max(r[3])).alias("rect"), F.first("edges").alias("edges"), F.count("*").alias("lines"))
    return out.withColumn("band", band_at((F.col("rect")[1] + F.col("rect")[3]) / 2, F.col("edges"))).drop("edges")


def row_bands(o: DataFrame, bands: DataFrame, rows: DataFrame) -> DataFrame:
    """(page, table, r, band): the band of each body row, the middle one of those that its own cells lie in; a row without a place follows
    the one before (the first of the table, at its head).  rows: page, table, r of every body row."""
    at = o.where(F.col("row1") - F.col("row0") == 1).join(bands, list(T)).select(*T, F.col("row0").alias("r"), "col0", F.explode("rects").alias("rect"), "edges")
    of_cell = at.groupBy(*T, "r", "col0", "edges").agg(F.median((F.col("rect")[1] + F.col("rect")[3]) / 2).alias("y"))
    known = of_cell.withColumn("band", band_at(F.col("y"), F.col("edges"))).groupBy(*T, "r").agg(F.floor(F.median("band")).cast("int").alias("band"))
    met = rows.join(known, [*T, "r"], "left")
    order = Window.partitionBy(*T).orderBy("r")
    before = F.last("band", ignorenulls=True).over(order)
    first = F.first("band", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return met.withColumn("band", F.coalesce(before, first)).where("band is not null")


def cuts(bounds: DataFrame, rules: DataFrame, intervals: DataFrame, placed: DataFrame, o: DataFrame, rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(page, table, col, i, y, status): what each inner boundary does to each column.

    A rule that crosses the middle of a column cuts it (rule_crosses).  Elsewhere text within half a line of the boundary blocks it
    (blocked_by_text), a cell that spans it is kept whole (preserved_raw_span), and it cuts where cells of their own lie right above and
    below it (corridor_extended)."""
    edges = bands_of(bounds)
    inner = edges.select(*T, F.posexplode(F.slice("edges", F.lit(2), F.size("edges") - 2)).alias("i", "y"))
    each = inner.join(intervals, list(T)).withColumn("middle", (F.col("left") + F.col("right")) / 2)
    r = rules.select("page", F.col("y").alias("ry"), "x0", "x1")
    low = F.col("ry") - F.col("y")
    crossed = each.join(r, "page").where((F.abs(low) <= 0.004) & (F.col("x0") <= F.col("middle")) & (F.col("middle") <= F.col("x1"))).select(*T, "col", "i").distinct().withColumn("crosses", F.lit(True))
    b = F.col("rect")
    half = placed.groupBy(*T, "col").agg((F.median(b[3] - b[1]) / 2).alias("half"))
    text = each.join(placed.select(*T, "col", "rect"), [*T, "col"]).join(half, [*T, "col"]).where((b[1] - F.col("half") <= F.col("y")) & (F.col("y") <= b[3] + F.col("half"))).select(*T, "col", "i").distinct().withColumn("text", F.lit(True))
    own = single(o).join(heads, list(T)).where("row0 >= heads")
    inside = own.alias("a").join(own.select(*T, "col0", F.col("row0").alias("other"), F.col("text").alias("otext")), [*T, "col0"]).where((F.col("other") > F.col("row0")) & (F.col("other") < F.col("row1")) & (F.btrim("otext") != ""))
    broken = inside.select(*T, "col0", "row0").distinct().withColumn("broken", F.lit(True))  # a span with another cell in it is none
    own = own.join(broken, [*T, "col0", "row0"], "left")
    spans = own.where("row1 - row0 > 1 and broken is null").select(*T, "col0", "row0", F.explode(F.sequence("row0", F.col("row1") - 1)).alias("r")).join(rows, [*T, "r"]).groupBy(*T, "col0", "row0").agg(F.min("band").alias("low"), F.max("band").alias("high"))
    kept = each.join(spans.withColumnRenamed("col0", "col"), [*T, "col"]).where("low <= i and i < high").select(*T, "col", "i").distinct().withColumn("span", F.lit(True))
    lone = own.where("row1 - row0 = 1 or broken").select(*T, F.col("col0").alias("col"), F.col("row0").alias("r")).join(rows, [*T, "r"]).select(*T, "col", "band").distinct()
    above = lone.select(*T, "col", F.col("band").alias("i"), F.lit(True).alias("above"))
    below = lone.select(*T, "col", (F.col("band") - 1).alias("i"), F.lit(True).alias("below"))
    met = each
    for part in (crossed, text, kept, above, below):
        met = met.join(part, [*T, "col", "i"], "left")
    spoken = placed.select(*T, "col").distinct().withColumn("spoken", F.lit(True))
    met = met.join(spoken, [*T, "col"], "left")
    status = (
        F.when(F.col("crosses"), "rule_crosses").when(F.col("text") | F.col("spoken").isNull(), "blocked_by_text").when(F.col("span"), "preserved_raw_span").when(F.col("above") & F.col("below"), "corridor_extended")
        .otherwise("blocked_by_text")
    )
    return met.select(*T, "col", "i", "y", status.alias("status"))


def regions(cut: DataFrame, bands: DataFrame, intervals: DataFrame) -> DataFrame:
    """(page, table, col, band, region): bands of a column between which nothing cuts are one region."""
    n = bands.select(*T, F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("band")).join(intervals.select(*T, "col"), list(T))
    hits = cut.where(F.col("status").isin("rule_crosses", "corridor_extended")).select(*T, "col", (F.col("i") + 1).alias("band"), F.lit(1).alias("new"))
    met = n.join(hits, [*T, "col", "band"], "left")
    return met.withColumn("region", F.sum(F.coalesce("new", F.lit(0))).over(Window.partitionBy(*T, "col").orderBy("band"))).drop("new")


def tokens(text: Column) -> Column:
    """Words of a key, doubled list marks as one."""
    words = F.filter(F.split(text, r"\s+", -1), lambda x: x != "")
    return F.filter(words, lambda x, i: (x != "■") | (i == 0) | (F.get(words, i - 1) != "■"))


def source_proof(o: DataFrame, found: DataFrame, spanned: DataFrame, area: DataFrame, cut: DataFrame, columns: DataFrame, heads: DataFrame) -> DataFrame:
    """(page, table, col, status, reason) of every column: verified where all its tokens occur in order in the text of the page and no block
    of that crosses a cut; empty, span_preserved, or untrusted otherwise."""
    body = single(o).join(heads, list(T)).where("row0 >= heads").withColumn("key", comparison_key("text"))
    raw = body.groupBy(*T, F.col("col0").alias("col")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row0", "key"))), lambda x: tokens(x["key"]))).alias("raw"))
    src = found.withColumn("key", comparison_key("text")).groupBy(*T, "col").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("rect")[1].alias("top"), F.col("rect")[0].alias("left"), "block", "key"))), lambda x: tokens(x["key"]))).alias("source"), F.count("*").alias("blocks")
    )
    ends = cut.where(F.col("status").isin("rule_crosses", "corridor_extended")).select(*T, "col", "y")
    torn = found.join(ends, [*T, "col"]).where((F.col("rect")[1] < F.col("y")) & (F.col("y") < F.col("rect")[3])).select(*T, "col").distinct().withColumn("torn", F.lit(True))
    met = columns.join(raw, [*T, "col"], "left").join(src, [*T, "col"], "left").join(spanned.withColumn("wide", F.lit(True)), [*T, "col"], "left").join(torn, [*T, "col"], "left")
    none = F.array().cast("array<string>")
    kept = tokens_preserved(F.coalesce("raw", none), F.coalesce("source", none))
    status = F.when(F.col("wide"), "span_preserved").when(F.size(F.coalesce("raw", none)) == 0, "empty").when(F.col("blocks").isNull() | ~kept | F.col("torn"), "untrusted").otherwise("verified")
    reason = F.when(F.col("wide"), "horizontal_span").when(F.size(F.coalesce("raw", none)) == 0, None).when(F.col("blocks").isNull(), "no_source_components").when(~kept, "raw_not_source_subsequence").when(F.col("torn"), "source_component_crosses_effective_cut")
    return met.select(*T, "col", status.alias("status"), reason.alias("reason"))


def segments(o: DataFrame, found: DataFrame, proof: DataFrame, area: DataFrame, rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(page, table, col, low, high, home, text): what stands in which bands.  A verified column has the page's own text, a region at a time;
    any other its cells, each in the band of its row."""
    reach = area.groupBy(*T, "col", "region").agg(F.min("band").alias("low"), F.max("band").alias("high"))
    proven = found.join(proof.where("status = 'verified'").select(*T, "col"), [*T, "col"]).join(area, [*T, "col", "band"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("rect")[1].alias("top"), F.col("rect")[0].alias("left"), "block", "text"))), lambda x: x["text"]), " ")
    one = proven.groupBy(*T, "col", "region").agg(text.alias("text")).join(reach, [*T, "col", "region"]).select(*T, "col", "low", "high", F.col("low").alias("home"), "text")
    rest = o.join(heads, list(T)).where("row0 >= heads and btrim(text) != ''").withColumn("col", F.col("col0")).join(proof.where("status != 'verified'").select(*T, "col"), [*T, "col"])
    homes = rest.join(rows.withColumnRenamed("r", "row0"), [*T, "row0"]).select(*T, "col", F.col("band").alias("low"), F.col("band").alias("high"), F.col("band").alias("home"), "text", "row0")
    return one.withColumn("row0", F.lit(None).cast("int")).unionByName(homes)


def collisions(parts: DataFrame) -> DataFrame:
    """(page, table, col, bands): places with two texts of which one belongs to another band."""
    full = parts.where(F.btrim("text") != "").groupBy(*T, "col", F.col("low").alias("band")).agg(F.count("*").alias("n"), F.max(F.col("home") != F.col("low")).alias("moved"))
    return full.where("n >= 2 and moved").groupBy(*T, "col").agg(F.array_sort(F.collect_list("band")).alias("bands"))


def rebuilt(parts: DataFrame, heads: DataFrame, columns: DataFrame) -> DataFrame:
    """(page, table, r, cells): a row for each band that holds a text; a text that covers bands stands in all their rows."""
    spread = parts.select(*T, "col", "row0", "text", F.explode(F.sequence("low", "high")).alias("band"))
    used = parts.where(F.btrim("text") != "").select(*T, F.explode(F.sequence("low", "high")).alias("band")).distinct()
    number = used.withColumn("k", F.row_number().over(Window.partitionBy(*T).orderBy("band")) - 1).join(heads, list(T))
    cell = spread.groupBy(*T, "band", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row0", "text"))), lambda x: x["text"]), " ").alias("text"))
    width = columns.groupBy(*T).agg((F.max("col") + 1).alias("cols"))
    held = number.join(cell, [*T, "band"], "left").join(width, list(T))
    filled = F.map_from_entries(F.collect_list(F.when(F.col("col").isNotNull(), F.struct("col", "text"))))
    rows = held.groupBy(*T, "k", "heads", "cols").agg(filled.alias("m"))
    return rows.select(*T, (F.col("heads") + F.col("k")).alias("r"), F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(""))).alias("cells"))


def reconcile(tables: DataFrame, cells: DataFrame, rules: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verdicts, grids): for every table whether its body follows the page's rules (unchanged), was rebuilt by them (repaired), or can't be
    decided (abstained), and why; and the rows that repaired ones have.

    A table without two rules across half of its width, or without a body, stays as it is.  One whose texts would meet in a place, or
    of which no row has a place, is left alone."""
    from .settle import settle

    heads = cells.groupBy(*T).agg(F.coalesce(F.min(F.when(~F.coalesce("header", F.lit(False)), F.col("r"))), F.max("r") + 1).alias("heads"), F.max("r").alias("last"))
    body_rows = heads.where("last >= heads").select(*T, F.explode(F.sequence("heads", "last")).alias("r"))
    head = heads.select(*T, "heads")
    o = settle(owners(cells), "owners")
    bounds = settle(rule_boundaries(rules, tables), "bounds")
    bands = bands_of(bounds)
    intervals = settle(column_intervals(o), "intervals")
    placed = settle(lines_in_columns(lines, tables, intervals), "placed")
    found = settle(components(placed, bands), "components")
    rows = settle(row_bands(o, bands, body_rows), "row-bands")
    cut = settle(cuts(bounds, rules, intervals, placed, o, rows, head), "cuts")
    area = settle(regions(cut, bands, intervals), "areas")
    columns = cells.select(*T, F.col("c").alias("col")).distinct()
    proof = settle(source_proof(o, found, spanned_columns(o, head), area, cut, columns, head), "proof")
    parts = settle(segments(o, found, proof, area, rows, head), "segments")
    clash = collisions(parts).select(*T).distinct().withColumn("clash", F.lit(True))
    new = settle(rebuilt(parts, head, columns), "rebuilt")
    was = cells.join(head, list(T)).where("r >= heads").groupBy(*T, "r").agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "text"))), lambda x: x["text"]).alias("cells"))
    body = lambda df: df.groupBy(*T).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "cells"))), lambda x: x["cells"]).alias("body"))
    met = tables.select(*T).join(heads, list(T), "left").join(bands.withColumn("banded", F.lit(True)).select(*T, "banded"), list(T), "left").join(rows.select(*T).distinct().withColumn("placed", F.lit(True)), list(T), "left")
    met = met.join(clash, list(T), "left").join(body(was).withColumnRenamed("body", "was"), list(T), "left").join(body(new).withColumnRenamed("body", "now"), list(T), "left")
    status = (
        F.when(F.col("last").isNull() | (F.col("last") < F.col("heads")) | F.col("banded").isNull(), "unchanged").when(F.col("placed").isNull() | F.col("clash") | F.col("now").isNull(), "abstained").when(F.col("was") == F.col("now"), "unchanged")
        .otherwise("repaired")
    )
    why = (
        F.when(F.col("last").isNull() | (F.col("last") < F.col("heads")), "no_body").when(F.col("banded").isNull(), "no_rule_bands").when(F.col("placed").isNull(), "no_row_evidence").when(F.col("clash"), "slot_collision")
        .when(F.col("now").isNull(), "no_content_bands").when(F.col("was") == F.col("now"), "raw_matches_rules")
    )
    verdicts = met.select(*T, status.alias("status"), why.alias("reason"))
    return verdicts, new.join(verdicts.where("status = 'repaired'").select(*T), list(T), "left_semi")


def visible_rules(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """Rules (page, y, x0, x1, height of a line) with `contrast` and `seen`: how far the grey levels on them differ from those beside, sampled
    along the rule on the page's picture (page, wide, high, grey bytes).  A page without a picture says nothing: null."""

    def judge(key: tuple, own: pd.DataFrame, picture: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        own = own.assign(contrast=np.nan)
        if len(picture) and len(own):
            p = picture.iloc[0]
            grey = np.frombuffer(p.grey, np.uint8).reshape(int(p.high), int(p.wide)).astype(float)
            for i, r in enumerate(own.itertuples()):
                off = max(2, round(max(r.height, 0.0) * p.high * OFFSET))
                n = min(64, max(8, int((r.x1 - r.x0) * p.wide) // 6))
                xs = np.clip(np.rint((r.x0 + (r.x1 - r.x0) * (np.arange(n) + 0.5) / n) * p.wide).astype(int), 0, int(p.wide) - 1)
                row = lambda y: grey[int(np.clip(round(y), 0, p.high - 1)), xs]
                y = r.y * p.high
                on, up, down = np.stack([row(y + d) for d in (-1, 0, 1)]), row(y - off), row(y + off)
                ends = np.stack([on.min(axis=0), on.max(axis=0)])
                apart = np.max(np.concatenate([np.abs(ends - up), np.abs(ends - down), np.abs(up - down)[None]]), axis=0)
                own.iloc[i, own.columns.get_loc("contrast")] = float(np.median(apart))
        return own[["page", "y", "x0", "x1", "contrast"]]

    kinds = {f.name: f.dataType.simpleString() for f in rules.schema}
    out = rules.groupBy("page").cogroup(pages.groupBy("page")).applyInPandas(judge, f"page {kinds['page']}, y double, x0 double, x1 double, contrast double")
    contrast = F.nanvl("contrast", F.lit(None).cast("double"))
    return out.withColumn("contrast", contrast).withColumn("seen", F.col("contrast") > CONTRAST)


def grid_rects(known: DataFrame, size: DataFrame) -> DataFrame:
    """(page, table, r, c, rect) of every place of a grid: that of its cell, or what the edges of the grid's other cells give.  An edge is the
    mean of those known there; between two known ones it lies in proportion, beyond them the ends of the table.  known: page, table,
    r, c, rect; size: page, table, rows, cols, rect."""

    def edges(axis: int, count: str, at: str) -> DataFrame:
        low, high = (F.col(at), F.col("rect")[axis]), (F.col(at) + 1, F.col("rect")[axis + 2])
        flat = known.select(*T, F.explode(F.array(*[F.struct(i.alias("i"), x.alias("x")) for i, x in (low, high)])).alias("e")).select(*T, "e.*").groupBy(*T, "i").agg(F.avg("x").alias("x"))
        ends = size.select(*T, F.col(count).alias("n"), F.col("rect")[axis].alias("first"), F.col("rect")[axis + 2].alias("final"))
        every = ends.select("*", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("i")).join(flat, [*T, "i"], "left")
        every = every.withColumn("x", F.coalesce("x", F.when(F.col("i") == 0, F.col("first")).when(F.col("i") == F.col("n"), F.col("final"))))
        w = Window.partitionBy(*T).orderBy("i")
        after = w.rowsBetween(0, Window.unboundedFollowing)
        spot = F.when(F.col("x").isNotNull(), F.struct("i", "x"))
        e = every.withColumn("a", F.last(spot, ignorenulls=True).over(w)).withColumn("b", F.first(spot, ignorenulls=True).over(after))
        part = F.when(F.col("a.i") == F.col("b.i"), F.col("a.x")).otherwise(F.col("a.x") + (F.col("b.x") - F.col("a.x")) * (F.col("i") - F.col("a.i")) / (F.col("b.i") - F.col("a.i")))
        return e.groupBy(*T).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", part.alias("x")))), lambda s: s["x"]).alias(f"e{axis}"))

    every = size.select(*T, F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"), "cols").select(*T, "r", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("c"))
    met = every.join(known.select(*T, "r", "c", F.col("rect").alias("own")), [*T, "r", "c"], "left").join(edges(0, "cols", "c"), list(T)).join(edges(1, "rows", "r"), list(T))
    made = F.array(F.get("e0", F.col("c")), F.get("e1", F.col("r")), F.get("e0", F.col("c") + 1), F.get("e1", F.col("r") + 1))
    return met.select(*T, "r", "c", F.coalesce("own", made).alias("rect"))


def covered(r0: Column, r1: Column, span: Column, at: Column) -> Column:
    """Places that a cell covers along an axis: from its offsets, its span, or just where it is."""
    start = F.coalesce(r0, at)
    return F.sequence(start, F.greatest(start, F.coalesce(r1, start + F.coalesce(span, F.lit(1))) - 1))


def record_bands(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(page, table, record, top, bottom): from where to where the cells of a record reach that belong to no other.  sources: page, table,
    record, r."""
    key = F.transform("rect", lambda x: F.round(x, 6))
    met = cells.withColumn("key", key).join(sources, [*T, "r"])
    own = met.withColumn("least", F.min("record").over(Window.partitionBy(*T, "key"))).withColumn("most", F.max("record").over(Window.partitionBy(*T, "key"))).where("least = most")
    return own.groupBy(*T, "record").agg(F.min(F.col("rect")[1]).alias("top"), F.max(F.col("rect")[3]).alias("bottom"))


def in_reading_order(symbols: DataFrame, *keys: str) -> DataFrame:
    """Symbols (keys, id, rect) numbered from the top down in rows that are half a symbol high, and from left to right in a row."""
    r = F.col("rect")
    heights = symbols.groupBy(*keys).agg(F.array_sort(F.collect_list(r[3] - r[1])).alias("hs"))
    s = symbols.join(heights, list(keys)).withColumn("tol", F.get("hs", F.floor(F.size("hs") / 2).cast("int")) / 2)
    tops = F.array_sort(F.collect_list(F.struct(r[1].alias("y"), "id", "tol")))
    start = F.struct(F.array().cast("array<struct<id:bigint,row:int>>").alias("out"), F.lit(None).cast("double").alias("y"), F.lit(0).alias("row"))

    def step(a: Column, x: Column) -> Column:
        new = a["y"].isNull() | (x["y"] - a["y"] > x["tol"])
        row = a["row"] + F.when(new, 1).otherwise(0)
        return F.struct(F.concat(a["out"], F.array(F.struct(x["id"].cast("bigint").alias("id"), row.alias("row")))).alias("out"), F.when(new, x["y"]).otherwise(a["y"]).alias("y"), row.alias("row"))

    rows = s.groupBy(*keys).agg(F.aggregate(tops, start, step, lambda a: a["out"]).alias("out")).select(*keys, F.explode("out").alias("o")).select(*keys, F.col("o.id").alias("id"), "o.row")
    met = symbols.join(rows, [*keys, "id"])
    return met.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("row", F.col("rect")[0], "id"))).drop("row")


def centre_in(rect: Column, top: Column, bottom: Column, tolerance: float) -> Column:
    return geo.centre_y(rect).between(top - tolerance, bottom + tolerance)
