"""Decisions about pages, tables and runs as Columns and joins: is a transcription faithful, does a page need a call, was a repair one,
does a checkpoint fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Tables
from ..functions import grids as gr
from ..functions import markdown as md
from ..functions import symbols as sy
from ..functions import text as tx
from ..functions.bind import bind

TABLES = Tables()  #: settings where none are given
#: Fixed values beside them: share of prose that a transcription must keep; characters of a plain page; share of a page that a repair must
#: keep; versions of what checkpoints hold.
PROSE, PLAIN_CHARS, SHRINK, RECONSTRUCTION_VERSION, SCHEMA_VERSION = 0.85, 300, 0.7, 5, 1
_KPI_LINE = r"^\s*-\s+[^:|]{2,80}:\s*\S"


def _first(*checks: tuple[Column, str]) -> Column:
    out = F.when(F.coalesce(checks[0][0], F.lit(False)), checks[0][1])
    for condition, reason in checks[1:]:
        out = out.when(F.coalesce(condition, F.lit(False)), reason)
    return out


def _numbers(texts: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(texts, tx.numeric_tokens)))


def _coverage(wanted: Column, there: Column) -> Column:
    return F.size(F.array_intersect(wanted, there)) / F.nullif(F.size(wanted), F.lit(0))


def table_fault(text: Column, cells: Column, rows: Column, num_cols: Column, flagged: Column, s: Tables = TABLES) -> Column:
    """First reason to refuse a transcribed table; null for a good one.  `cells` are the texts of its source; where it has a grid (rows),
    columns, header, number of records and prose must fit that too."""
    data = F.transform(F.filter(md.lines_of(text), lambda x: tx.is_pipe_line(x) & ~F.rlike(tx.strip(x), F.lit(r"^[|\-: ]+\z"))), tx.strip)

    def checks(x: Column) -> Column:
        body, shape, words, numbers, own = x["body"], x["shape"], x["words"], x["numbers"], x["own"]
        has = rows.isNotNull() & (F.size(rows) > 0)
        again = F.exists(F.slice(body, F.lit(2), F.greatest(F.lit(0), F.size(body) - 1)), lambda r: (F.size(F.filter(r, lambda c: c != "")) > 0) & (F.size(F.array_except(shape["labels"], F.transform(r, F.lower))) == 0))
        records = F.size(body) - 1
        rules = F.size(F.filter(md.lines_of(text), tx.is_separator_line))
        return _first(
            (F.size(body) < 2, "no_table_structure"), (has & (rules > 1), "multiple_header_blocks"), (has & (shape["num_cols"] != 0) & (gr.widest(body) != shape["num_cols"]), "column_count_mismatch"),
            (has & (F.size(shape["labels"]) > 0) & again, "repeated_header_in_body"),
            (has & (shape["least"] > 0) & ((records < shape["least"]) | (records > F.greatest(shape["most"], shape["least"]))), "record_count_mismatch"),
            (has & (_coverage(words, tx.distinctive_words(text)) < PROSE), "word_coverage_low"), (F.size(F.array_except(own, numbers)) > 0, "invented_numbers"), (_coverage(numbers, own) < s.numeric_coverage_min, "missing_numbers"),
            ((F.size(numbers) == 0) & (_coverage(tx.word_tokens(F.array_join(cells, " ")), tx.word_tokens(text)) < s.word_coverage_min), "missing_words"),
        )

    parts = F.struct(
        F.transform(data, lambda r: F.transform(tx.split_row(r), tx.collapse_ws)).alias("body"), gr.expected_shape(rows, num_cols, flagged).alias("shape"),
        gr.body_words(gr.stripped(rows), F.coalesce(flagged, F.lit(0))).alias("words"), _numbers(cells).alias("numbers"), tx.numeric_tokens(text).alias("own"),
    )
    return bind(parts, checks)


def kpi_fault(text: Column, cells: Column, s: Tables = TABLES) -> Column:
    """First reason to refuse a list of labels and values; null for a good one."""
    lines = md.lines_of(text)
    numbers, own = _numbers(cells), tx.numeric_tokens(text)
    return _first(
        (F.exists(lines, lambda x: F.startswith(F.ltrim(x), F.lit("|"))), "pipe_table"), (F.size(F.filter(lines, lambda x: F.rlike(x, F.lit(_KPI_LINE)))) < 2, "no_kpi_list_structure"),
        (F.size(F.array_except(own, numbers)) > 0, "invented_numbers"), (_coverage(numbers, own) < s.numeric_coverage_min, "missing_numbers"),
    )


def missing_tables(pages: DataFrame, tables: DataFrame, *keys: str) -> DataFrame:
    """(keys, id) of verified tables most of whose rows are not in their page: half of the rows, or six tenths of a list's lines.
    pages: keys, markdown; tables: keys, id, markdown, format, complete."""
    flat = lambda df, *more: df.select(*keys, *more, F.explode(md.lines_of(F.col("markdown"))).alias("line"))
    listed = F.rlike("line", F.lit(_KPI_LINE))
    row = F.when(tx.is_pipe_line(F.col("line")), tx.collapse_ws(F.col("line"))).when(listed, F.lower(tx.collapse_ws(F.col("line"))))
    there = flat(pages).select(*keys, row.alias("row"), tx.is_pipe_line(F.col("line")).alias("pipe")).where("row is not null").distinct().withColumn("hit", F.lit(1))
    good = tables.where(F.col("complete") & (F.coalesce("markdown", F.lit("")) != ""))
    kpi = F.col("format") == "kpi_list"
    rule = F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z"))
    wanted = flat(good, "id", F.coalesce("format", F.lit("")).alias("format")).where(F.when(kpi, listed).otherwise(tx.is_pipe_line(F.col("line")) & ~rule))
    wanted = wanted.select(*keys, "id", "format", row.alias("row"), (~kpi).alias("pipe"))
    met = wanted.join(there, [*keys, "row", "pipe"], "left").groupBy(*keys, "id", "format").agg(F.count("*").alias("n"), F.count("hit").alias("hits"))
    lost = met.where(F.when(kpi, F.col("hits") < 0.6 * F.col("n")).otherwise(F.col("hits") < 0.5 * F.col("n"))).select(*keys, "id")
    empty = good.where("format = 'kpi_list'").select(*keys, "id").join(met.select(*keys, "id"), [*keys, "id"], "left_anti")
    return lost.unionByName(empty)


def is_plain_prose(raw: Column, wanted_pictures: Column, candidates: Column, has_table: Column, reordered: Column) -> Column:
    """A page that no call can improve: long enough, without pictures to describe, tables, or another reading order."""
    return (F.length(tx.strip(raw)) >= PLAIN_CHARS) & (wanted_pictures == 0) & (candidates == 0) & ~has_table & ~reordered


def needs_image(candidates: Column, role: Column) -> Column:
    return (candidates > 0) | (role == "toc")


def needs_repair(guard: Column, missing: Column, symbols: Column, has_table: Column, tables: Column, verified: Column, pictures: Column, values: Column) -> Column:
    """Whether a page goes through repair: content was lost, verified tables or symbols are missing, a table has no verified form, or loose
    values stand beside pictures."""
    return F.coalesce(guard, F.lit(False)) | (F.coalesce(missing, F.lit(0)) > 0) | (F.coalesce(symbols, F.lit(0)) > 0) | (has_table & ((tables == 0) | (verified < tables))) | ((pictures >= 2) & (values >= 3))


def repair_lines(unplaced: Column, summaries: Column, indices: Column) -> Column:
    """What a repair is told: lost lines, and symbols without a place, each once."""
    deficits = F.zip_with(indices, summaries, lambda i, s: sy.deficit_line(i.cast("string"), s))
    return F.array_distinct(F.concat(F.coalesce(unplaced, F.array().cast("array<string>")), deficits))


def without_unplaced(text: Column) -> Column:
    return F.array_join(md.cut_sections(text, r"(?i)^##\s+Unplaced content\s*\z", deepest=2)["kept"], "\n")


def repair_faults(before: Column, after: Column, usage: Column, lost: Column, copies_before: Column, copies_after: Column, loose_before: Column, loose_after: Column, symbols_before: Column, symbols_after: Column) -> Column:
    """All reasons to keep a page as it was before its repair: the call was cut or went wrong, or the page shrank, lost rows or lines,
    repeats itself, or has more rows and symbols without a place.  Counts of lines and copies come from their own operators."""
    old, new = without_unplaced(before), without_unplaced(after)
    flag = lambda k: F.coalesce(usage[k], F.lit(False))
    reasons = [(flag(k), k) for k in ("length_capped", "decoding_anomaly", "context_overflow")]
    reasons += [
        (F.length(new) < SHRINK * F.length(old), "shrunk_output"), (md.pipe_row_count(new) < md.pipe_row_count(old), "fewer_table_rows"), (lost > 0, "content_loss_vs_pre_repair"),
        (copies_after > copies_before, "duplicate_content_added"), (loose_after > loose_before, "ambiguous_table_arity"), (symbols_after > symbols_before, "fewer_table_symbol_instances"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), r) for c, r in reasons]))


def checkpoint_fault(state: Column, pdf_name: Column, pdf_size: Column, page: Column, dpi: Column, page_dir: Column) -> Column:
    """Why a saved page does not belong to a run; null if it does.  Folders compare by their last part, as the same page may lie under
    another root."""
    last = lambda p: F.element_at(F.split(F.regexp_replace(p, r"/+\z", ""), "/", -1), -1)
    return _first(
        (state["schema_version"] != SCHEMA_VERSION, "schema version"), ((state["pdf_name"] != pdf_name) | (state["pdf_size"] != pdf_size), "source"), (state["page"] != page, "page"), (state["dpi"] != dpi, "resolution"),
        (last(state["page_dir"]) != last(page_dir), "page folder"),
    )


def audit_is_current(audit: Column, candidates: Column, table_modes: Column, table_versions: Column, has_file: Column, mode: Column, version: int = 1) -> Column:
    """Whether the saved audit of a page is that of this collector and mode, for the page and every table."""
    tables = F.forall(table_modes, lambda m: m.eqNullSafe(mode)) & F.forall(table_versions, lambda v: v.eqNullSafe(F.lit(version)))
    return F.coalesce(audit["completed"] & (audit["collector_version"] == version) & (audit["mode"] == mode) & (audit["candidate_count"] == candidates) & has_file & tables, F.lit(False))


def is_stale_grid(grids: Column, versions: Column) -> Column:
    """Whether a page holds a grid that another version of the reconciliation made."""
    return F.exists(F.zip_with(grids, versions, lambda g, v: g & ~v.eqNullSafe(F.lit(RECONSTRUCTION_VERSION))), lambda x: x)


def deterministic(kind: Column, verified: Column, format_: Column, own: Column, headerless: Column, kpi: Column, status: Column, table: Column, symbols: Column, inserted: Column, corroborated: Column) -> Column:
    """Whether a table may be rendered from its grid: a normalised one that no other form claims and whose grid stands, and, if it is a
    regular one, that has symbols, lists, inserted values or a proven source."""
    claimed = F.coalesce(headerless, F.lit(False)) | F.coalesce(kpi, F.lit(False)) | (format_.isNotNull() & ~(format_.isin("regular_table", "title_detail_table") & F.coalesce(own, F.lit(False))))
    worth = (table["classification"] != "regular_table") | (symbols > 0) | table["bulleted"] | (F.coalesce(inserted, F.lit(0)) > 0) | corroborated
    return F.coalesce((kind == "grid_table") & ~verified & ~claimed & (F.coalesce(status, F.lit("")) != "abstained") & table.isNotNull() & worth, F.lit(False))
