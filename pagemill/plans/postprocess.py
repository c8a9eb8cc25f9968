"""The deterministic Markdown plan: a page's text through all rewrites, in their order, as one DataFrame plan.

Texts are rewritten by Columns; tables, panels, furniture, duplicates and completeness by relational operators over the page's
lines.  Input: (doc, page, raw, markdown), and `images` (array of image blocks) if there are any.  Output: the same with
`final`, `unplaced`, `notes` and `warnings` (a map of counts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markdown as md
from ..functions import text as tx
from ..operators import furniture as fu
from ..operators import lines as ln
from ..operators import rewrites as rw
from ..operators import splice as sp
from ..operators import tables as tb
from ..operators.settle import settle

KEYS = ("doc", "page")
#: Text of the header that goes when it stands alone; it is not missed.
_ORPHAN = "description management measures"
_TEXTS = "array<string>"


def tables_step(lines: DataFrame) -> DataFrame:
    """Ragged tables padded; tables without content, and orphan headers, gone."""
    kinds = tb.layout_tables(tb.rows_of(lines, *KEYS), *KEYS, "block")
    blocks = sp.with_blocks(lines, *KEYS)
    kept = blocks.join(kinds.where("kind in ('empty', 'orphan')"), [*KEYS, "block"], "left_anti").select(*KEYS, "pos", "line")
    fixed = tb.normalize(kept, *KEYS)
    order = F.row_number().over(ln.Window.partitionBy(*KEYS).orderBy("pos", "part")) - 1
    return fixed.select(*KEYS, order.alias("pos"), "line")


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*KEYS).agg(F.count("*").alias("n")).select(*KEYS, F.lit(name).alias("name"), "n")


def _content(lines: Column) -> Column:
    """Lines without marks of items; `(none)` is no content."""
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(tx.strip(x), r"^[-*]\s+", "")), lambda x: (x != "") & (F.lower(x) != "(none)"))


def _is_note(line: Column) -> Column:
    """Lines of a section of uncertain mappings that are content: no heading, image or chapter tab."""
    return (line != "") & ~F.startswith(line, F.lit("#")) & ~F.rlike(line, F.lit(tx.IMAGE_LINE)) & ~F.rlike(F.regexp_replace(line, r"^[-*]\s+", ""), F.lit(r"^(?:\d{1,2}|[A-Z])\z"))


def _ordered(*columns: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*columns))), lambda x: x[columns[-1]])


def postprocess(
    pages: DataFrame, furniture: DataFrame | None = None, tables: DataFrame | None = None, *, grids: DataFrame | None = None, headerless: DataFrame | None = None, levels: DataFrame | None = None
) -> DataFrame:
    """All steps.  `furniture`: (doc, page, norm) texts safe to strip.  `tables`: verified tables (doc, page, table, kind,
    markdown, source, titles), see operators.splice.  `grids`: source grids (doc, page, table, rows, num_cols, header_rows) that give
    collapsed headers back; `headerless`: first rows (doc, page, cells) of tables without a header; `levels`: (doc, page, text,
    level) of list items.  Lines that a writer set aside or was unsure of, and lines of the raw text
    that the result lacks, end up under one heading; contents tables get their numbers back instead."""
    images = "images" if "images" in pages.columns else None
    first = md.clean(pages.select(*KEYS, "markdown", *([images] if images else [])), "markdown", images)
    first = first.select(*KEYS, md.extract_unplaced(F.col("markdown")).alias("u"))
    first = settle(first.select(*KEYS, F.col("u.md").alias("md"), _content(F.col("u.lines")).alias("claimed")), "first")
    raw = settle(ln.to_lines(pages, *KEYS, text="raw"), "raw")
    toc = settle(ln.toc_pages(raw, *KEYS).where("toc").select(*KEYS), "toc")

    lines = settle(tables_step(settle(ln.to_lines(first, *KEYS, text="md"), "lines")), "tables")
    warnings = []
    if grids is not None:
        heads = settle(rw.merged_headers(lines, grids, *KEYS), "heads")
        warnings.append(_count(heads, "span_headers_realigned"))
        lines = settle(rw.apply_lines(lines, heads, *KEYS), "headed")
    gone, new, counts = sp.reshaped(lines, *KEYS)
    warnings.append(counts)
    lines = settle(sp.splice(lines, gone, new, *KEYS), "reshaped")
    if headerless is not None:
        lines = settle(rw.add_blank_headers(lines, headerless, *KEYS), "headerless")
    if tables is not None:
        gone, new, counts = sp.place_tables(lines, tables, *KEYS)
        warnings.append(counts)
        lines = settle(sp.splice(lines, gone, new, *KEYS), "placed")
    if levels is not None:
        lines = settle(rw.apply_list_levels(lines, levels, *KEYS), "levels")
    # the numbers of a contents table come from its raw rows
    in_toc = lambda df: df.join(toc, list(KEYS), "left_semi")
    lines = lines.join(toc, list(KEYS), "left_anti").unionByName(ln.restore_toc_numbers(in_toc(lines), in_toc(raw), *KEYS))
    if furniture is not None:
        furniture = settle(furniture, "furniture")
        lines = fu.strip_lines(settle(lines, "numbered"), furniture)
    if tables is not None:
        lines = settle(lines, "stripped")
        subsets = settle(sp.subset_blocks(lines, tables, *KEYS), "subsets")
        warnings.append(_count(subsets, "duplicate_tables_dropped"))
        lines = sp.with_blocks(lines, *KEYS).join(subsets, [*KEYS, "block"], "left_anti").select(*KEYS, "pos", "line")

    split = settle(ln.blocks(lines, *KEYS), "blocks")
    blocks = ln.collapse_duplicates(split, *KEYS)
    warnings.append(_count(split.join(blocks.select(*KEYS, "pos"), [*KEYS, "pos"], "left_anti"), "duplicate_paragraphs_dropped"))
    body = blocks.select(*KEYS, "pos", F.array_join("lines", "\n").alias("t")).groupBy(*KEYS).agg(F.array_join(_ordered("pos", "t"), "\n\n").alias("body"))
    body = body.withColumn("body", md.strip_breaks(F.col("body"))).withColumn("u", md.extract_uncertainty(F.col("body")))
    body = body.select(*KEYS, F.col("u.md").alias("body"), F.col("u.notes").alias("notes"))
    body = body.withColumn("_notes", F.transform(F.split("notes", "\n"), tx.strip))
    back = F.array_join(F.filter("_notes", lambda x: F.rlike(x, F.lit(tx.IMAGE_LINE))), "\n\n")
    body = body.withColumn("body", F.when(back != "", F.concat(F.regexp_replace("body", r"\s+\z", ""), F.lit("\n\n"), back, F.lit("\n"))).otherwise(F.col("body")))
    body = settle(body.select(*KEYS, "body", "notes", _content(F.filter("_notes", _is_note)).alias("unsure")), "body")

    # both sides of the comparison without tags, tables flattened on the raw side too
    shown = lambda c: tx.strip_tags(md.flatten_html_tables(F.col(c)))
    source = ln.to_lines(pages.select(*KEYS, shown("raw").alias("raw")), *KEYS, text="raw").join(toc, list(KEYS), "left_anti")
    if furniture is not None:
        source = fu.strip_lines(source, furniture)
    final_lines = settle(ln.to_lines(body, *KEYS, text="body"), "final")
    seen = final_lines.withColumn("line", tx.strip_tags(F.col("line")))
    missing = sp.without_shared_blocks(ln.missing_lines(source, seen, *KEYS), body, *KEYS)
    missing = settle(missing.where(tx.furniture_text(F.col("line")) != _ORPHAN), "missing")
    near = seen.join(missing.select(*KEYS).distinct(), list(KEYS), "left_semi")  # pages that lack nothing have nothing to look up
    judged = settle(rw.present_parts(missing, near, furniture, *KEYS), "judged")
    warnings.append(_count(judged.where("reason is not null"), "unplaced_lines_filtered"))
    missing = judged.where("reason is null").select(*KEYS, "pos", "line")
    lost = missing.groupBy(*KEYS).agg(_ordered("pos", "line").alias("lost"))
    # a page whose text came out empty has no body, but what was set aside or lost still counts
    none = lambda c: F.coalesce(F.col(c), F.array().cast(_TEXTS))
    out = pages.join(body, list(KEYS), "left").join(lost, list(KEYS), "left").join(first.select(*KEYS, "claimed"), list(KEYS), "left")
    out = out.join(toc.withColumn("_toc", F.lit(True)), list(KEYS), "left").withColumn("body", F.coalesce("body", F.lit("")))
    asides = F.concat(none("unsure"), none("claimed"))
    all_ = F.concat(none("lost"), F.when(F.col("_toc"), F.array().cast(_TEXTS)).otherwise(asides))
    out = out.withColumn("_all", all_).withColumn("_low", F.transform("_all", lambda x: F.lower(tx.collapse_ws(x))))
    plain = tx.collapse_ws(F.lower("body"))
    fresh = F.filter("_all", lambda x, i: (F.array_position("_low", F.get("_low", i)) == i + 1) & ~F.contains(plain, F.get("_low", i)))
    out = out.withColumn("unplaced", F.when(F.size("_all") > 0, fresh).otherwise(F.col("_all")))
    notes = ln.footnotes(final_lines, *KEYS).where(F.size("undefined") + F.size("duplicates") + F.size("gaps") > 0)
    warnings += [_count(notes, "footnotes"), _count(final_lines.where(tx.is_meta_note(F.col("line"))), "meta_commentary")]
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n"))))
    held = reduce(DataFrame.unionByName, warnings).groupBy(*KEYS).agg(entries.alias("warnings"))
    out = out.join(held, list(KEYS), "left").withColumn("warnings", F.coalesce("warnings", F.create_map().cast("map<string,bigint>")))
    return out.select(*pages.columns, md.merge_unplaced(F.col("body"), F.col("unplaced")).alias("final"), "unplaced", "notes", "warnings")
