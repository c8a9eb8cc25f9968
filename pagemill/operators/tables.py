"""Pipe tables as rows: parse, render, repair, classify, split, compare, verify.

A table is rows (keys..., r, cells): r is the row's place from 0, cells an array of strings.  Row 0 is the header unless
said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .lines import island, page


def _rows(*keys: str):
    return Window.partitionBy(*keys).orderBy("r")


def rows_of(lines: DataFrame, *keys: str) -> DataFrame:
    """Data rows of all pipe tables of a page: (keys, block, r, pos, cells); rules are left out."""
    marked = lines.withColumn("block", island(tx.is_pipe_line(F.col("line")), *keys)).where("block is not null")
    kept = marked.where(~F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z")))
    return kept.select(*keys, "block", "pos", (F.row_number().over(page(*keys, "block")) - 1).alias("r"), tx.split_row(F.col("line")).alias("cells"))


def render(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, markdown): header, rule, body; cells escaped; rows padded to the widest."""
    width = F.max(F.size("cells")).over(Window.partitionBy(*keys))
    line = tx.render_row(F.transform(tx.pad_row(F.col("cells"), F.col("width")), tx.escape_cell))
    padded = rows.withColumn("width", width).select(*keys, "r", "width", line.alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("r", "line")))
    lines = F.transform(ordered, lambda x: x["line"])
    rule = tx.separator_row(F.max("width"))
    return padded.groupBy(*keys).agg(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.lit(0), F.size(lines) - 1))), "\n").alias("markdown"))


def normalize(lines: DataFrame, *keys: str) -> DataFrame:
    """Pipe tables of two data rows or more rewritten: one rule, under the header, as wide as the table; ragged rows padded.
    Other lines stay.  Positions keep their order (a rule shares its header's)."""
    marked = lines.withColumn("block", island(tx.is_pipe_line(F.col("line")), *keys))
    marked = marked.withColumn("rule", F.col("block").isNotNull() & F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z"))).withColumn("cells", tx.split_row(F.col("line")))
    block = Window.partitionBy(*keys, "block")
    data = F.when(~F.col("rule"), 1)
    marked = marked.withColumns({"n": F.count(data).over(block), "width": F.max(F.when(~F.col("rule"), F.size("cells"))).over(block), "nth": F.count(data).over(block.orderBy("pos"))})
    table = F.col("block").isNotNull() & (F.col("n") >= 2)
    kept = marked.where(~(table & F.col("rule")))
    new = tx.render_row(tx.pad_row(F.col("cells"), F.col("width")))
    body = kept.select(*keys, "pos", F.lit(0).alias("part"), F.when(table, new).otherwise(F.col("line")).alias("line"))
    rules = kept.where(table & (F.col("nth") == 1)).select(*keys, "pos", F.lit(1).alias("part"), F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.col("width").cast("int"))).alias("line"))
    return body.unionByName(rules)


def panel_stats(rows: DataFrame, *keys: str) -> DataFrame:
    """Shape of each table as a panel of values and captions: counts, ratio, whether value and label rows alternate, and
    whether it is such a panel."""
    full = F.filter(F.transform("cells", tx.strip), lambda c: c != "")
    flags = rows.select(
        *keys, "r", F.size("cells").alias("cols"), F.size(full).alias("filled"), F.size(F.filter(full, tx.is_value_text)).alias("values"),
        F.size(F.filter(full, tx.is_label_text)).alias("labels"), F.size(F.filter(full, lambda c: F.length(c) > tx.KPI_MAX_CHARS)).alias("long"),
    )
    flags = flags.withColumn("v", (F.col("filled") > 0) & (F.col("values") == F.col("filled"))).withColumn("l", (F.col("filled") > 0) & (F.col("labels") == F.col("filled")))
    after = F.lead(F.struct("v", "l")).over(_rows(*keys))
    flags = flags.withColumn("turn", F.coalesce((F.col("v") & after["l"]) | (F.col("l") & after["v"]), F.lit(False)))
    sums = flags.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.max("cols").alias("n_cols"), F.sum("filled").alias("non_empty"), F.sum("values").alias("value_cells"), F.sum("labels").alias("label_cells"),
        F.sum("long").alias("long_cells"), F.max("turn").alias("alternating"),
    )
    ratio = F.when(F.col("non_empty") > 0, F.round((F.col("value_cells") + F.col("label_cells")) / F.col("non_empty"), 3)).otherwise(F.lit(0.0))
    panel = (
        (F.col("n_rows") <= tx.KPI_MAX_ROWS) & (F.col("n_cols") <= tx.KPI_MAX_COLS) & (F.col("value_cells") >= tx.KPI_MIN_VALUES) & (F.col("label_cells") >= tx.KPI_MIN_LABELS)
        & (F.col("signal_ratio") >= tx.KPI_MIN_RATIO) & (F.col("long_cells") == 0) & F.col("alternating")
    )
    return sums.withColumn("signal_ratio", ratio).withColumn("panel", panel)


def panel_lists(rows: DataFrame, *keys: str) -> DataFrame:
    """`- LABEL: value` lines of panels whose rows pair up from the top: (keys, pos, line).  A value row and the label row
    next to it, in either order, pair column by column; the pairing goes on after the pair.  Cells without a partner follow
    as plain items; with less than half of the cells paired, all are plain items."""
    panels = panel_stats(rows, *keys).where("panel").select(*keys)
    full = F.filter(F.transform("cells", tx.strip), lambda c: c != "")
    r = rows.join(panels, list(keys), "left_semi").withColumn("cells", F.transform("cells", tx.strip))
    kind = F.when((F.size(full) > 0) & F.forall(full, tx.is_value_text), "v").when((F.size(full) > 0) & F.forall(full, tx.is_label_text), "l").otherwise("-")
    r = r.withColumn("kind", kind).withColumn("next", F.lead("kind").over(_rows(*keys)))
    # in a run of alternating rows, the first and third and so on lead a pair
    joins = F.concat("kind", F.coalesce("next", F.lit("-"))).isin("vl", "lv")
    chain = F.sum(F.when(F.lag(joins, 1, False).over(_rows(*keys)), 0).otherwise(1)).over(_rows(*keys))
    r = r.withColumn("joins", joins).withColumn("chain", chain)
    nth = F.row_number().over(Window.partitionBy(*keys, "chain").orderBy("r")) - 1
    r = r.withColumn("nth", nth).withColumn("leads", F.col("joins") & (F.col("nth") % 2 == 0))
    r = r.withColumn("lower", F.lead("cells").over(_rows(*keys))).withColumn("upper_leads", F.lag("leads", 1, False).over(_rows(*keys))).withColumn("upper", F.lag("cells").over(_rows(*keys)))
    other = F.when(F.col("leads"), F.col("lower")).when(F.col("upper_leads"), F.col("upper"))
    cell = r.select(*keys, "r", "kind", "leads", F.posexplode("cells").alias("c", "cell"), other.alias("other"))
    cell = cell.withColumn("mate", F.nullif(F.get("other", F.col("c")), F.lit(""))).where("cell != ''")
    whole = Window.partitionBy(*keys)
    cell = cell.withColumn("few", F.count("mate").over(whole) * 2 < F.count("*").over(whole))
    text = F.when(F.col("few") | F.col("mate").isNull(), F.concat(F.lit("- "), F.col("cell"))).when(F.col("kind") == "l", F.concat(F.lit("- "), F.col("cell"), F.lit(": "), F.col("mate"))).otherwise(
        F.concat(F.lit("- "), F.col("mate"), F.lit(": "), F.col("cell"))
    )
    kept = cell.where("few or mate is null or leads")
    late = F.when(~F.col("few") & F.col("mate").isNull(), 1).otherwise(0)
    return kept.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy(late, "r", "c")).alias("pos"), text.alias("line"))


def split_sections(rows: DataFrame, *keys: str) -> DataFrame:
    """Tables banded by title rows, as sections: (keys, section, title, qualifiers, r, cells) for every data row.

    A table qualifies with 3 columns, 4 rows, a header row that is no title and is half filled with short cells, and two
    data rows, of which a titled section holds two."""
    width = F.max(F.size("cells")).over(Window.partitionBy(*keys))
    r = rows.withColumn("width", width).withColumn("cells", F.transform(tx.pad_row(F.col("cells"), F.col("width")), tx.strip))
    r = r.withColumn("title", tx.section_title(F.col("cells")))
    full = F.filter("cells", lambda c: c != "")
    usable = F.col("title").isNull() & (F.size(full) * 2 >= F.size("cells")) & F.forall(full, lambda c: F.length(c) <= 40)
    head = F.max(F.when(F.col("r") == 0, usable)).over(Window.partitionBy(*keys))
    r = r.withColumn("head", head).withColumn("rows", F.count("*").over(Window.partitionBy(*keys))).where("head and width >= 3 and rows >= 4 and r > 0")
    # a title in brackets straight under another title is its qualifier
    before = F.lag("title").over(_rows(*keys))
    qualifier = F.startswith("title", F.lit("(")) & before.isNotNull()
    r = r.withColumn("qualifier", F.coalesce(qualifier, F.lit(False))).withColumn("opens", F.col("title").isNotNull() & ~F.col("qualifier"))
    r = r.withColumn("section", F.count_if("opens").over(_rows(*keys)))
    section = Window.partitionBy(*keys, "section")
    r = r.withColumns(
        {
            "section_title": F.max(F.when(F.col("opens"), F.col("title"))).over(section),
            "qualifiers": F.array_join(F.collect_list(F.when(F.col("qualifier"), F.col("title"))).over(section.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), " "),
            "data": F.count(F.when(F.col("title").isNull(), 1)).over(section),
        }
    )
    gates = Window.partitionBy(*keys)
    r = r.withColumn("all_data", F.count(F.when(F.col("title").isNull(), 1)).over(gates)).withColumn("best", F.max(F.when(F.col("section") > 0, F.col("data"))).over(gates))
    return r.where("title is null and all_data >= 2 and best >= 2").select(*keys, "section", F.col("section_title").alias("title"), "qualifiers", "r", "cells")


def title_detail(rows: DataFrame, *keys: str) -> DataFrame:
    """Records of a table: a row with its first cell alone, followed by a row with more, is one record `title<br>detail`.
    (keys, record, cells, merged).  A record takes two rows at most, so titles in a row pair from where the last pair ended."""
    alone = (F.get("cells", F.lit(0)) != "") & (F.size(F.filter("cells", lambda c: c != "")) == 1)
    detail = (F.get("cells", F.lit(0)) != "") & (F.size(F.filter("cells", lambda c: c != "")) > 1)
    r = rows.where("r > 0").withColumn("cells", F.transform("cells", lambda c: tx.cell_with_bullets(c))).withColumn("alone", alone).withColumn("detail", detail)
    over = _rows(*keys)
    r = r.withColumn("opens", F.col("alone") & F.coalesce(F.lead("detail").over(over), F.lit(False))).withColumn("closes", F.lag("opens", 1, False).over(over)).withColumn("above", F.lag("cells").over(over))
    merged = F.when(F.col("closes"), F.concat(F.array(F.concat(F.get("above", F.lit(0)), F.lit("<br>"), F.get("cells", F.lit(0)))), F.slice("cells", F.lit(2), F.greatest(F.lit(0), F.size("cells") - 1)))).otherwise(F.col("cells"))
    kept = r.where("not opens")
    return kept.select(*keys, (F.row_number().over(over) - 1).alias("record"), F.array_join(merged, "|").alias("cells"), F.col("closes").alias("merged"))


def subset_tables(rows: DataFrame, doc: str, table: str) -> DataFrame:
    """(doc, table, other): tables of which four fifths of the rows are prefixes of rows of another table of the document.

    A prefix has a width: rows of the wider table are cut to each width that narrower tables have, and meet by equality."""
    low = rows.select(doc, table, F.transform("cells", lambda c: F.lower(tx.collapse_ws(c))).alias("cells")).distinct()
    sizes = low.groupBy(doc, table).agg(F.count("*").alias("n"))
    widths = low.groupBy(doc).agg(F.collect_set(F.size("cells")).alias("widths"))
    cut = low.join(widths, doc).select(doc, F.col(table).alias("other"), "cells", F.explode(F.filter("widths", lambda w: w <= F.size("cells"))).alias("w"))
    cut = cut.select(doc, "other", F.slice("cells", F.lit(1), F.col("w")).alias("cells")).distinct()
    met = low.join(cut, [doc, "cells"]).where(F.col(table) != F.col("other")).groupBy(doc, table, "other").agg(F.count("*").alias("hits"))
    return met.join(sizes, [doc, table]).where(F.col("hits") >= 0.8 * F.col("n")).select(doc, table, "other")


def verify(tables: DataFrame) -> DataFrame:
    """Accept or reject transcribed tables: (id, markdown, cells) -> verdict and reason.  No number may be new, nine tenths of
    the numbers must be there, or four fifths of the words where there are no numbers."""
    m, source = F.col("markdown"), F.array_join("cells", "\n")
    rows = F.filter(F.split(m, "\n"), lambda x: F.startswith(tx.strip(x), F.lit("|")) & ~F.rlike(tx.strip(x), F.lit(r"^[|\-: ]+\z")))
    t = tables.withColumns({"rows": F.size(rows), "sn": tx.numeric_tokens(source), "tn": tx.numeric_tokens(m), "sw": tx.word_tokens(source), "tw": tx.word_tokens(m)})
    share = lambda a, b: F.size(F.array_intersect(a, b)) / F.size(a)
    reason = (
        F.when(F.col("rows") < 2, "no_table_structure").when(F.size(F.array_except("tn", "sn")) > 0, "invented_numbers")
        .when((F.size("sn") > 0) & (share("sn", "tn") < 0.9), "missing_numbers").when((F.size("sn") == 0) & (F.size("sw") > 0) & (share("sw", "tw") < 0.8), "missing_words")
    )
    return t.withColumn("reason", reason).withColumn("verified", F.col("reason").isNull())


def layout_tables(rows: DataFrame, *keys: str) -> DataFrame:
    """Which tables are prose in disguise (unwrap), hold nothing (empty), or a header alone (orphan)."""
    cell = F.filter("cells", lambda c: c != "")
    sums = rows.select(
        *keys, "r", F.size("cells").alias("cols"), F.size(cell).alias("filled"), F.aggregate(cell, F.lit(0), lambda a, c: a + F.length(c)).alias("chars"),
        F.coalesce(F.array_max(F.transform(cell, F.length)), F.lit(0)).alias("longest"), F.exists(cell, lambda c: F.rlike(c, F.lit(r"(?i)<br\s*/?>"))).alias("br"),
        F.size(F.filter(cell, tx.is_numeric_cell)).alias("numeric"), (F.array_join(F.transform(cell, lambda c: F.lower(tx.collapse_ws(c))), "|") == "description|management measures").alias("pair"),
    ).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("filled", "chars", "numeric")], F.max("cols").alias("cols"), F.max("longest").alias("longest"), F.max("br").alias("br"), F.max("pair").alias("pair"), F.count("*").alias("n"))
    prose = (F.col("longest") > 200) | F.col("br") | (F.col("chars") > 120 * F.col("filled"))
    kind = (
        F.when(F.col("filled") == 0, "empty").when((F.col("n") == 1) & F.col("pair"), "orphan")
        .when((F.col("cols") <= 3) & (F.col("numeric") < 3) & (F.col("n") - 1 <= 3) & prose, "unwrap").otherwise("table")
    )
    return sums.select(*keys, kind.alias("kind"))


def text_pairs(lines: DataFrame, *keys: str) -> DataFrame:
    """Loose runs of values and labels as bullets: (keys, run, pair, first, last, line), first and last being positions, where a run, broken by other lines, alternates for two
    pairs or more and its values are not years alone."""
    content = tx.strip(F.regexp_replace("line", r"^\s*-\s+", ""))
    full = lines.where(tx.strip(F.col("line")) != "").withColumn("text", content)
    kind = F.when(tx.is_run_breaker(F.col("line")), "-").when(tx.is_value_text(F.col("text")), "v").when(tx.is_label_text(F.col("text")), "l").otherwise("-")
    marked = full.withColumn("kind", kind)
    marked = marked.withColumn("run", island(F.col("kind") != "-", *keys)).where("run is not null")
    run = Window.partitionBy(*keys, "run").orderBy("pos")
    marked = marked.withColumn("i", F.row_number().over(run) - 1).withColumn("first", F.first("kind").over(run))
    fits = (F.col("kind") == F.col("first")) == (F.col("i") % 2 == 0)
    marked = marked.withColumn("broken", F.max(F.when(~fits, 1).otherwise(0)).over(run))
    pairs = marked.withColumn("pair", F.floor(F.col("i") / 2)).groupBy(*keys, "run", "pair").agg(
        F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("broken").alias("broken"), F.max(F.when(F.col("kind") == "v", F.col("text"))).alias("value"), F.max(F.when(F.col("kind") == "l", F.col("text"))).alias("label")
    )
    good = pairs.where("n = 2 and broken = 0")
    whole = Window.partitionBy(*keys, "run")
    good = good.withColumn("count", F.count("*").over(whole)).withColumn("years", F.min(tx.is_bare_year(F.col("value")).cast("int")).over(whole))
    return good.where("count >= 2 and years = 0").select(*keys, "run", "pair", "first", "last", F.concat(F.lit("- "), "label", F.lit(": "), "value").alias("line"))


def align_row(cells: Column, grid_row: Column) -> Column:
    """A row's values at the columns where its source row has them; null where the row can't say.

    Source and row are compared as runs: values that are not empty, equal neighbours as one, since a source repeats a
    spanning value in each column and a writer puts it down once.  With equal runs, column i of the source takes the
    row's text of run number size(runs up to i)."""
    keys, own = F.transform(grid_row, tx.grid_cell_key), F.transform(cells, tx.grid_cell_key)
    values = F.filter(cells, lambda c: c != "")
    texts = F.filter(values, lambda v, i: (i == 0) | (tx.grid_cell_key(v) != tx.grid_cell_key(F.get(values, i - 1))))
    filled = F.size(F.filter(grid_row, lambda c: c != ""))
    placed = F.transform(keys, lambda k, i: F.when(k == "", F.lit("")).otherwise(F.get(texts, F.size(tx.cell_runs(F.slice(keys, F.lit(1), i + 1))) - 1)))
    return F.when((filled > 0) & (filled <= F.size(values)) & (tx.cell_runs(keys) == tx.cell_runs(own)), placed)


def realign(rows: DataFrame, grid: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, r, cells) back on the columns of their source (keys, g, cells): each row meets the first source row with its
    runs that no earlier row has taken; with half of the rows and two of them matched, rows that can be placed move.
    (keys, r, cells, moved, ambiguous)."""
    run_key = lambda c: F.array_join(tx.cell_runs(F.transform(c, tx.grid_cell_key)), "\u0001")
    nth = lambda order: F.row_number().over(Window.partitionBy(*keys, "run").orderBy(order))
    a = rows.withColumn("run", run_key(F.col("cells"))).withColumn("nth", nth("r"))
    b = grid.select(*keys, "g", F.col("cells").alias("source")).withColumn("run", run_key(F.col("source"))).withColumn("nth", nth("g"))
    met = a.join(b, [*keys, "run", "nth"], "left")
    # order of the source must follow the order of the rows
    before = F.max("g").over(_rows(*keys).rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("fits", F.col("g").isNotNull() & (F.col("run") != "") & (F.coalesce(before, F.lit(-1)) < F.col("g")))
    whole = Window.partitionBy(*keys)
    met = met.withColumn("good", F.count_if("fits").over(whole)).withColumn("n", F.count("*").over(whole))
    placed = F.when(F.col("fits") & (F.col("good") >= 2) & (F.col("good") * 2 >= F.col("n")), align_row(F.col("cells"), F.col("source")))
    met = met.withColumn("placed", placed)
    return met.select(
        *keys, "r", F.coalesce("placed", "cells").alias("cells"), F.coalesce(F.col("placed") != F.col("cells"), F.lit(False)).alias("moved"),
        (F.col("fits") & F.col("placed").isNull() & (F.size("cells") != F.size("source"))).alias("ambiguous"),
    )
