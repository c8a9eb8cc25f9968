"""Markdown texts rewritten as Columns: a text becomes its lines, lines are mapped, filtered or folded, and joined again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .html_tables import flatten_html_tables

_LINES = "array<string>"


def lines_of(md: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(md, F.lit("")), r"\n\z", ""), "\n", -1)


def joined(lines: Column, like: Column | None = None) -> Column:
    """Lines as a text, ending in a line break if `like` does."""
    out = F.array_join(lines, "\n")
    return out if like is None else F.when(F.endswith(like, F.lit("\n")), F.concat(out, F.lit("\n"))).otherwise(out)


def tidy(md: Column) -> Column:
    """At most one blank line in a row, none at the ends, one line break at the end (none for an empty text)."""
    t = tx.strip(F.regexp_replace(md, r"\n{3,}", "\n\n"))
    return F.when(t == "", t).otherwise(F.concat(t, F.lit("\n")))


def each_line(md: Column, rule: Callable[[Column], Column], *, tables: bool = False) -> Column:
    """The rule on every line; pipe lines stay unless `tables`."""
    keep = (lambda x: rule(x)) if tables else (lambda x: F.when(tx.is_pipe_line(x), x).otherwise(rule(x)))
    return joined(F.transform(lines_of(md), keep), md)


def collapse_spaces(md: Column) -> Column:
    return each_line(md, lambda x: F.regexp_replace(x, r"(?<=\S) {2,}(?=\S)", " "))


def strip_list_glyphs(md: Column) -> Column:
    """`- • x` as `- x`; legends `- ■ = x` stay."""
    return each_line(md, lambda x: F.regexp_replace(x, rf"^(\s*)-\s+[{tx.STRONG_BULLETS}]\s+(?!=)(\S)", "$1- $2"))


def cell_bullets(md: Column) -> Column:
    """Lists inside cells of pipe tables as fragments."""

    def rule(x: Column) -> Column:
        cells = F.split(x, r"\|", -1)
        n = F.size(cells)
        return F.array_join(F.transform(cells, lambda c, i: F.when((i == 0) | (i == n - 1), c).otherwise(tx.cell_with_bullets(c))), "|")

    return joined(F.transform(lines_of(md), lambda x: F.when(tx.is_pipe_line(x) & ~F.rlike(x, F.lit(r"^\|[\s|:-]+\|?\s*\z")), rule(x)).otherwise(x)), md)


def bullets_and_headings(md: Column) -> Column:
    """Bullets as `- ` items, inline ones on lines of their own; a blank line before each heading."""
    out = F.flatten(F.transform(lines_of(md), lambda x: F.when(~tx.is_pipe_line(x) & F.rlike(x, F.lit(f"[{tx.BULLETS}]")), tx.split_inline_bullets(x)).otherwise(F.array(x))))
    return tidy(F.regexp_replace(F.array_join(out, "\n"), r"(?m)(?<=\S)([ \t]*)\n(?=#{1,6}\s)", "$1\n\n"))


def demote_headings(md: Column) -> Column:
    """Headings that are a label and a number, with nothing under them, as items."""
    point = r"[^:|#\n]{1,40}:\s*[~≈<>+-]?\d[\d.,]*\s*(?:%|€|\$|£|pp|pts?|years?|yrs?|x)?\s*(?:\[[^\]]{1,4}\])?"
    return F.regexp_replace(md, rf"(?m)^#{{1,6}}\s+({point})[ \t]*$(?=\n*(?:#{{1,6}}\s|\z))", "- $1")


def strip_meta(md: Column) -> Column:
    return tidy(F.array_join(F.filter(lines_of(md), lambda x: ~tx.is_meta_note(x)), "\n"))


def strip_breaks(md: Column) -> Column:
    """<br> outside tables as line breaks."""
    cut = lambda x: F.filter(F.split(x, r"(?i)<br\s*/?>", -1), lambda y: tx.strip(y) != "")
    has = lambda x: F.rlike(x, F.lit(r"(?i)<br\s*/?>")) & ~tx.is_pipe_line(x)
    return joined(F.flatten(F.transform(lines_of(md), lambda x: F.when(has(x), cut(x)).otherwise(F.array(x)))), md)


def cut_sections(md: Column, title: str, *, deepest: int | None = None, keep_title: bool = False) -> Column:
    """struct(kept, cut): lines of sections whose heading fits `title`, up to the next heading of that level or higher (or of
    level `deepest`), and all others.  A fold that carries the level of the open section."""
    start = F.struct(F.array().cast(_LINES).alias("kept"), F.array().cast(_LINES).alias("cut"), F.lit(0).alias("level"))

    def step(a: Column, x: Column) -> Column:
        level = F.length(F.regexp_extract(x, tx.HEADING, 1))
        opens = F.rlike(x, F.lit(title))
        closes = (level > 0) & (level <= (F.lit(deepest) if deepest else a["level"]))
        now = F.when(opens, F.greatest(level, F.lit(1))).when((a["level"] > 0) & ~closes, a["level"]).otherwise(0)
        inside = now > 0
        return F.struct(
            F.when(inside, a["kept"]).otherwise(F.concat(a["kept"], F.array(x))).alias("kept"),
            F.when(inside & (~opens | F.lit(keep_title)), F.concat(a["cut"], F.array(x))).otherwise(a["cut"]).alias("cut"),
            now.alias("level"),
        )

    return F.aggregate(lines_of(md), start, step, lambda a: F.struct(a["kept"].alias("kept"), a["cut"].alias("cut")))


def extract_uncertainty(md: Column) -> Column:
    """struct(md, notes) without `Uncertain ...` sections."""
    s = cut_sections(md, r"(?i)^\s*#{1,6}\s*uncertain", keep_title=True)
    return F.struct(tidy(F.array_join(s["kept"], "\n")).alias("md"), tx.strip(F.array_join(s["cut"], "\n")).alias("notes"))


def extract_unplaced(md: Column) -> Column:
    """struct(md, lines) without `## Unplaced content` sections, which end at a heading of level 1 or 2."""
    s = cut_sections(md, r"(?i)^##\s+Unplaced content\s*\z", deepest=2)
    return F.struct(joined(s["kept"], md).alias("md"), F.filter(F.transform(s["cut"], tx.strip), lambda x: x != "").alias("lines"))


def merge_unplaced(md: Column, missing: Column) -> Column:
    """Missing lines as items of one `## Unplaced content` section at the end, without those that the text holds."""
    low = F.lower(md)
    new = F.filter(F.transform(missing, tx.strip), lambda x: (x != "") & ~F.contains(low, F.lower(x)))
    items = F.array_join(F.transform(new, lambda x: F.concat(F.lit("- "), x)), "\n")
    body = F.regexp_replace(md, r"\s+\z", "")
    has = F.rlike(md, F.lit(r"(?im)^\s*## unplaced content\s*$"))
    out = F.when(has, F.concat(body, F.lit("\n"), items, F.lit("\n"))).otherwise(F.concat(body, F.lit("\n\n## Unplaced content\n\n"), items, F.lit("\n")))
    return F.when(F.size(new) > 0, out).otherwise(md)


def normalize_footnotes(df: DataFrame, column: str) -> DataFrame:
    """All `[n] text` definitions, and the lines of Footnotes sections, in one section at the end, each once.  In steps, as
    each part is used more than once and a column is computed once."""
    is_def = lambda x: F.rlike(x, F.lit(tx.FOOTNOTE_DEF))
    s = df.withColumn("_s", cut_sections(F.col(column), r"(?i)^\s*#{1,6}\s*footnotes?\s*\z"))
    s = s.withColumn("_section", F.filter(F.transform("_s.cut", tx.strip), lambda x: x != ""))
    s = s.withColumn("_known", F.transform("_section", F.lower)).withColumn("_defs", F.concat("_section", F.transform(F.filter("_s.kept", is_def), tx.strip)))
    s = s.withColumn("_low", F.transform("_defs", F.lower))
    s = s.withColumn("_once", F.filter("_defs", lambda x, i: F.array_position("_low", F.lower(x)) == i + 1))
    rest = F.filter("_s.kept", lambda x: ~is_def(x) & ((tx.strip(x) == "") | ~F.array_contains("_known", F.lower(tx.strip(x)))))
    s = s.withColumn("_body", tx.strip(F.regexp_replace(F.array_join(rest, "\n"), r"\n{3,}", "\n\n")))
    head = F.when(F.col("_body") == "", "").otherwise(F.concat("_body", F.lit("\n\n")))
    new = F.when(F.size("_defs") > 0, F.concat(head, F.lit("## Footnotes\n"), F.array_join("_once", "\n"), F.lit("\n"))).otherwise(F.col(column))
    return s.withColumn(column, new).drop("_s", "_section", "_known", "_defs", "_low", "_once", "_body")


def value_line_count(md: Column) -> Column:
    return F.size(F.filter(lines_of(md), lambda x: ~F.rlike(tx.strip(x), F.lit("^[#-]")) & (tx.strip(x) != "") & tx.is_value_text(x)))


def pipe_row_count(md: Column) -> Column:
    return F.size(F.filter(lines_of(md), lambda x: tx.is_pipe_line(x) & ~tx.is_separator_line(x)))


def insert_images(md: Column, images: Column) -> Column:
    """Placeholders `<!-- image -->` replaced in order by image blocks; blocks left over are appended, those that the text
    holds already are not repeated."""
    fresh = F.filter(images, lambda x: ~F.contains(md, x))
    parts = F.split(md, r"(?i)<!--\s*image\s*-->", -1)
    filled = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.coalesce(F.get(fresh, i - 1), F.lit("")), p))), "")
    rest = F.slice(fresh, F.size(parts), F.greatest(F.lit(0), F.size(fresh) - F.size(parts) + 1))
    return tidy(F.when(F.size(rest) > 0, F.concat(filled, F.lit("\n\n"), F.array_join(rest, "\n\n"))).otherwise(filled))


def clean(df: DataFrame, column: str, images: str | None = None) -> DataFrame:
    """The rewrites that come before tables are looked at, in their order; `images` names a column of image blocks to insert.  One
    projection a rule: rules use their text more than once, so as one expression they would multiply."""
    for rule in (flatten_html_tables, cell_bullets, strip_list_glyphs, bullets_and_headings, collapse_spaces, demote_headings):
        df = df.withColumn(column, rule(F.col(column)))
    if images:
        df = df.withColumn(column, F.when(F.size(images) > 0, insert_images(F.col(column), F.col(images))).otherwise(F.col(column)))
    df = normalize_footnotes(df.withColumn(column, strip_meta(F.col(column))), column)
    return df.withColumn(column, tx.unescape_entities(F.col(column)))
