"""Table grids as Columns: rows of cell texts with their header rows, classified and normalised to records.

A grid is bounded by what a page holds, so it travels as one value (an array of rows) and its rules are array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx
from .bind import bind

#: Records, columns with content and merged pairs that make a table; length of a header cell; tolerance of a symbol's
#: row; what joins symbols of one cell.
MIN_RECORDS, MIN_CONTENT, MIN_PAIRS, HEADER_CHARS, ROW_TOLERANCE, JOIN = 2, 2, 2, 60, 0.006, ", "
_ROWS, _RECORDS = "array<array<string>>", "array<struct<cells:array<string>,source_rows:array<int>>>"


def stripped(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(r, lambda c: tx.strip(F.coalesce(c, F.lit("")))))


def widest(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))


def column_count(rows: Column, num_cols: Column) -> Column:
    """The stated number of columns, or the widest row where it is missing."""
    return F.coalesce(F.nullif(num_cols, F.lit(0)), widest(rows))


def header_row_count(rows: Column, flagged: Column) -> Column:
    """Header rows: those that were flagged, else the first if it has two cells and all are short."""
    first = F.filter(F.transform(F.get(rows, F.lit(0)), tx.strip), lambda c: c != "")
    looks = (F.size(first) >= 2) & F.forall(first, lambda c: F.length(c) <= HEADER_CHARS)
    return F.when(F.coalesce(flagged, F.lit(0)) >= 1, F.least(flagged, F.size(rows))).when(F.coalesce(looks, F.lit(False)), 1).otherwise(0)


def spanning_label(row: Column) -> Column:
    """The first value that stands in two neighbouring columns; null if none does."""
    twice = F.filter(row, lambda c, i: (c != "") & (F.get(row, i + 1) == c))
    return F.get(twice, F.lit(0))


def merged_header(rows: Column, count: Column, num_cols: Column) -> Column:
    """One header row: the different labels of a column from top to bottom, joined by <br>; an empty first one takes the first
    label that spans columns."""
    block = F.slice(rows, F.lit(1), count)

    def column(j: Column) -> Column:
        labels = F.transform(block, lambda r: tx.strip(F.coalesce(F.get(r, j), F.lit(""))))
        return F.array_join(F.array_distinct(F.filter(labels, lambda x: x != "")), "<br>")

    span = F.get(F.filter(F.transform(block, lambda r: spanning_label(F.transform(r, tx.strip))), lambda x: x.isNotNull()), F.lit(0))
    flat = F.when(num_cols > 0, F.transform(F.sequence(F.lit(0), num_cols - 1), column)).otherwise(F.array().cast("array<string>"))
    return F.transform(flat, lambda x, i: F.when((i == 0) & (x == ""), F.coalesce(span, F.lit(""))).otherwise(x))


def is_title_only(cells: Column) -> Column:
    return F.coalesce((tx.strip(F.get(cells, F.lit(0))) != "") & (F.size(F.filter(cells, lambda c: tx.strip(c) != "")) == 1), F.lit(False))


def is_detail(cells: Column) -> Column:
    return F.coalesce((tx.strip(F.get(cells, F.lit(0))) != "") & (F.size(F.filter(cells, lambda c: tx.strip(c) != "")) > 1), F.lit(False))


def title_detail(title: Column, detail: Column) -> Column:
    t = tx.strip(title)
    return F.when(detail == "", t).when(t == "", detail).otherwise(F.concat(t, F.lit("<br>"), detail))


def content_columns(records: Column, num_cols: Column) -> Column:
    """How many columns hold something in two records or more."""
    filled = lambda j: F.size(F.filter(records, lambda r: tx.strip(F.coalesce(F.get(r["cells"], j), F.lit(""))) != ""))
    return F.when(num_cols > 0, F.size(F.filter(F.sequence(F.lit(0), num_cols - 1), lambda j: filled(j) >= 2))).otherwise(0)


def normalize(rows: Column, num_cols: Column, flagged: Column) -> Column:
    """struct(classification, header, records, num_cols, header_rows, bulleted) of a grid that is a table; else null.

    A row that has only its title joins a detail row right below it; which rows those are follows from the rows alone, as a
    detail row is never a title.  Lists inside cells become fragments."""

    def from_rows(all_rows: Column) -> Column:
        return bind(F.struct(column_count(all_rows, num_cols).alias("cols"), header_row_count(all_rows, flagged).alias("heads")), lambda n: _normalized(all_rows, n["cols"], n["heads"]))

    return bind(stripped(rows), from_rows)


def _normalized(rows: Column, cols: Column, heads: Column) -> Column:
    body = F.transform(F.slice(rows, heads + 1, F.greatest(F.lit(0), F.size(rows) - heads)), lambda r: tx.pad_row(r, cols))

    def from_body(b: Column) -> Column:
        pairs = lambda i: is_title_only(F.get(b, i)) & is_detail(F.get(b, i + 1))

        def record(r: Column, i: Column) -> Column:
            opened = F.coalesce(pairs(i), F.lit(False))
            source = F.when(opened, F.get(b, i + 1)).otherwise(r)
            cells = F.transform(source, tx.cell_with_bullets)
            listed = F.exists(F.zip_with(source, cells, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: tx.became_bullet_list(p["x"], p["y"]))
            first = F.transform(cells, lambda c, j: F.when(opened & (j == 0), title_detail(F.get(r, F.lit(0)), c)).otherwise(c))
            at = F.when(opened, F.array(heads + i, heads + i + 1)).otherwise(F.array(heads + i))
            taken = (i > 0) & F.coalesce(pairs(i - 1), F.lit(False))
            return F.struct(first.alias("cells"), at.alias("source_rows"), listed.alias("listed"), opened.alias("paired"), taken.alias("taken"))

        def from_records(all_: Column) -> Column:
            kept = F.filter(all_, lambda x: ~x["taken"])
            records = F.transform(kept, lambda x: F.struct(x["cells"].alias("cells"), x["source_rows"].alias("source_rows")))
            paired = F.size(F.filter(kept, lambda x: x["paired"]))
            table = F.struct(
                F.when(paired >= MIN_PAIRS, "title_detail_table").otherwise("regular_table").alias("classification"), merged_header(rows, heads, cols).alias("header"), records.alias("records"),
                cols.alias("num_cols"), heads.alias("header_rows"), F.exists(kept, lambda x: x["listed"]).alias("bulleted"),
            )
            good = (cols >= MIN_CONTENT + 1) & (heads >= 1) & (F.size(b) > 0) & (F.size(records) >= MIN_RECORDS) & (content_columns(records, cols) >= MIN_CONTENT)
            return F.when(good, table)

        return bind(F.transform(b, record), from_records)

    return bind(body, from_body)


def coverage_column(table: Column) -> Column:
    """Where symbols belong: the column headed coverage, else a last one that is empty throughout; null if there is none."""
    named = F.array_position(F.transform(table["header"], lambda x: F.contains(F.lower(x), F.lit("coverage"))), True)
    last = table["num_cols"] - 1
    blank = F.forall(table["records"], lambda r: tx.strip(F.coalesce(F.get(r["cells"], last), F.lit(""))) == "")
    return F.when(named > 0, (named - 1).cast("int")).when((last >= 1) & blank, last)


def render(table: Column) -> Column:
    """A normalised table as pipe rows: header, rule, records, pipes escaped."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(F.slice(tx.pad_row(cells, table["num_cols"]), F.lit(1), table["num_cols"]), lambda c: F.replace(c, F.lit("|"), F.lit(r"\|"))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), table["num_cols"]))
    body = F.transform(table["records"], lambda r: line(r["cells"]))
    return F.concat(F.array_join(F.concat(F.array(line(table["header"]), rule), body), "\n"), F.lit("\n"))


def place_value(table: Column, record: Column, column: Column, value: Column) -> Column:
    """struct(placed, table): the table with a value in one cell, if that is blank or holds it; other cells and places never change."""
    inside = (record >= 0) & (record < F.size(table["records"])) & (column >= 0) & (column < table["num_cols"]) & (F.coalesce(value, F.lit("")) != "")
    there = F.coalesce(F.get(F.get(table["records"], record)["cells"], column), F.lit(""))
    placed = F.coalesce(inside & (there.isin("") | (there == value)), F.lit(False))
    cells = lambda r: F.transform(tx.pad_row(r["cells"], column + 1), lambda c, j: F.when(j == column, value).otherwise(c))
    records = F.transform(table["records"], lambda r, i: F.when(placed & (i == record), r.withField("cells", cells(r))).otherwise(r))
    return F.struct(placed.alias("placed"), F.when(placed, table.withField("records", records)).otherwise(table).alias("table"))


def copy_back(rows: Column, source_rows: Column, column: Column, value: Column) -> Column:
    """Source rows of a grid with a value in the last row of a record whose cell at the column is blank; null if none is."""
    blank = F.filter(source_rows, lambda i: tx.strip(F.coalesce(F.get(F.get(rows, i), column), F.lit(""))) == "")
    at = F.element_at(blank, -1)
    put = F.transform(rows, lambda r, i: F.when(i == at, F.transform(tx.pad_row(r, column + 1), lambda c, j: F.when(j == column, value).otherwise(c))).otherwise(r))
    return F.when(F.size(blank) > 0, put)


def body_cells(rows: Column, header_rows: Column, column: Column) -> Column:
    """One column's values below the header, short rows padded."""
    return F.transform(F.slice(rows, header_rows + 1, F.greatest(F.lit(0), F.size(rows) - header_rows)), lambda r: F.coalesce(F.get(r, column), F.lit("")))


def body_words(rows: Column, header_rows: Column) -> Column:
    """Different words of three letters or more below the header."""
    body = F.slice(rows, header_rows + 1, F.greatest(F.lit(0), F.size(rows) - header_rows))
    return tx.distinctive_words(F.array_join(F.flatten(body), " "))


def expected_shape(rows: Column, num_cols: Column, flagged: Column) -> Column:
    """struct(num_cols, labels, least, most): what a transcription of a grid must look like."""

    def shape(r: Column) -> Column:
        cols, heads = column_count(r, num_cols), header_row_count(r, flagged)
        labels = F.transform(F.filter(F.when(heads > 0, merged_header(r, heads, cols)).otherwise(F.array().cast("array<string>")), lambda x: tx.strip(x) != ""), lambda x: F.lower(tx.collapse_ws(x)))
        least = F.coalesce(F.size(normalize(r, num_cols, flagged)["records"]), F.lit(0))
        return F.struct(cols.alias("num_cols"), labels.alias("labels"), F.when(least < 0, 0).otherwise(least).alias("least"), F.greatest(F.size(r) - heads, F.lit(0)).alias("most"))

    return bind(stripped(rows), shape)


def source_corroborated(stats: Column) -> Column:
    """Whether a reconciled grid may be rendered as it is: every column's text was found on the page (or is empty), or one was and
    those that were not stand row for row as before."""
    audit, grid, raw = stats["reconstruction"], stats["grid"], stats["grid_raw"]
    accepted = (audit["status"] == "repaired") | ((audit["status"] == "unchanged") & (audit["reason"] == "raw_matches_rules"))
    columns = F.sequence(F.lit(0), grid["num_cols"] - 1)
    state = lambda j: F.get(audit["source_content"], j)
    known = F.forall(columns, lambda j: F.coalesce(state(j).isin("verified", "empty", "untrusted"), F.lit(False))) & (F.size(audit["source_content"]) == grid["num_cols"])
    loose = F.filter(columns, lambda j: state(j) == "untrusted")
    same = (raw["num_cols"] == grid["num_cols"]) & (F.coalesce(raw["header_rows"], F.lit(0)) == F.coalesce(grid["header_rows"], F.lit(0))) & F.forall(
        loose, lambda j: body_cells(raw["rows"], F.coalesce(raw["header_rows"], F.lit(0)), j) == body_cells(grid["rows"], F.coalesce(grid["header_rows"], F.lit(0)), j)
    )
    proven = F.exists(columns, lambda j: state(j) == "verified") & ((audit["status"] == "unchanged") | F.coalesce(same, F.lit(False)))
    return F.coalesce((grid["num_cols"] > 0) & accepted & known & ((F.size(loose) == 0) | proven), F.lit(False))
