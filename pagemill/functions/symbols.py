"""Coverage symbols of tables (short codes such as E1): their tokens, the lines that only list them, and how often they stand in tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markdown as md
from . import text as tx
from .pictures import SYMBOL_CODE

_IMAGE, _TRAILER = r"!\[([^\]]*)\]\([^)]*\)", r"(?i)\s*(?:\(from\s+block\b[^)]*\))?\s*"


def _is_code(x: Column) -> Column:
    return F.rlike(x, F.lit(SYMBOL_CODE))


def value_tokens(value: Column) -> Column:
    """Codes of a value; a value that is more than codes is one token, in capitals."""
    flat = F.upper(tx.collapse_ws(value))
    parts = F.filter(F.split(flat, r"[\s,]+", -1), lambda x: x != "")
    return F.when((F.size(parts) > 0) & F.forall(parts, _is_code), parts).when(flat != "", F.array(flat)).otherwise(F.array().cast("array<string>"))


def codes(summaries: Column) -> Column:
    """Different codes among the summaries of a page's symbols."""
    parts = F.flatten(F.transform(summaries, lambda s: F.split(tx.strip(s), r"[\s,]+", -1)))
    return F.array_distinct(F.filter(parts, _is_code))


def budget(summaries: Column) -> Column:
    """Map of code to how many symbols with it are still without a place."""
    all_ = F.filter(F.flatten(F.transform(summaries, value_tokens)), _is_code)
    return F.map_from_entries(F.transform(F.array_distinct(all_), lambda c: F.struct(c.alias("k"), F.size(F.filter(all_, lambda x: x == c)).alias("v"))))


def loose_values(line: Column, known: Column) -> Column:
    """Codes of a line that holds nothing but pictures whose titles are codes, one of them known; empty for any other line."""
    t = tx.strip(line)
    only = F.rlike(t, F.lit(rf"^(?:{_IMAGE}\s*)+{_TRAILER}\z")) & ~tx.is_pipe_line(line)
    titles = F.transform(F.regexp_extract_all(t, F.lit(_IMAGE), F.lit(1)), lambda a: tx.strip(F.regexp_replace(a, r"(?i)^\s*Image summary:\s*", "")))
    parts = F.filter(F.flatten(F.transform(titles, lambda a: F.split(a, r"[\s,]+", -1))), lambda x: x != "")
    good = only & (F.size(parts) > 0) & F.forall(parts, _is_code) & F.arrays_overlap(parts, known)
    return F.when(F.coalesce(good, F.lit(False)), parts).otherwise(F.array().cast("array<string>"))


def is_loose(line: Column, known: Column) -> Column:
    return F.size(loose_values(line, known)) > 0


def is_protected(line: Column, known: Column, missing: Column) -> Column:
    """A loose line that holds a code of a symbol without a place."""
    wanted = F.filter(F.flatten(F.transform(missing, value_tokens)), _is_code)
    return is_loose(line, known) & F.exists(wanted, lambda c: F.rlike(F.upper(line), F.concat(F.lit(r"\b"), c, F.lit(r"\b"))))


def strip_loose(text: Column, known: Column, kept: Column) -> Column:
    """struct(md, removed): the text without loose lines, but for as many with each code as `kept` (a map) allows.  A fold, as every
    line that stays uses up what its codes may."""
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit(0).alias("removed"), kept.alias("left"))

    def step(a: Column, x: Column) -> Column:
        values = F.array_distinct(loose_values(x, known))
        open_ = F.exists(values, lambda v: F.coalesce(F.try_element_at(a["left"], v), F.lit(0)) > 0)
        stays = (F.size(values) == 0) | open_
        left = F.when((F.size(values) > 0) & open_, F.transform_values(a["left"], lambda k, v: F.when(F.array_contains(values, k) & (v > 0), v - 1).otherwise(v))).otherwise(a["left"])
        return F.struct(F.when(stays, F.concat(a["lines"], F.array(x))).otherwise(a["lines"]).alias("lines"), (a["removed"] + F.when(stays, 0).otherwise(1)).alias("removed"), left.alias("left"))

    done = F.aggregate(md.lines_of(text), start, step, lambda a: F.struct(a["lines"].alias("lines"), a["removed"].alias("removed")))
    return F.struct(F.when(done["removed"] > 0, md.joined(done["lines"], text)).otherwise(text).alias("md"), done["removed"].alias("removed"))


def table_counts(text: Column, expected: Column) -> Column:
    """Map of each expected value to how often it stands in cells of pipe tables; pictures in cells do not count."""
    rows = F.filter(md.lines_of(text), lambda x: tx.is_pipe_line(x) & ~F.rlike(tx.strip(x), F.lit(r"^[|\-: ]+\z")))
    cells = F.transform(F.flatten(F.transform(rows, tx.split_row)), lambda c: F.upper(tx.collapse_ws(F.regexp_replace(c, r"!\[[^\]]*\]\([^)]*\)", ""))))
    tokens = F.flatten(F.transform(cells, lambda c: F.regexp_extract_all(c, F.lit(r"\b([A-Z]{1,3}\d{0,2})\b"), F.lit(1))))
    many = lambda v: F.when(_is_code(v), F.size(F.filter(tokens, lambda t: t == v))).otherwise(F.size(F.filter(cells, lambda c: c == v)))
    return F.map_from_entries(F.transform(F.array_distinct(expected), lambda v: F.struct(v.alias("k"), many(v).alias("v"))))


def deficit_line(index: Column, value: Column) -> Column:
    return F.concat(F.lit("table symbol picture_index="), index, F.lit(" value="), tx.strip(value), F.lit(" is not placed"))


def complete_geometry(mode: Column, status: Column, unplaced: Column, expected: Column, placed: Column) -> Column:
    """Whether all symbols of a table have their place: by the audit's verdict where it is enforced, and by the lists of symbols."""
    enforced = F.coalesce((mode == "enforce") & status.isNotNull() & ~status.isin("complete", "not_observed"), F.lit(False))
    none = F.array().cast("array<int>")
    return ~enforced & (F.size(F.coalesce(unplaced, none)) == 0) & (F.size(F.array_except(F.coalesce(expected, none), F.coalesce(placed, none))) == 0)
