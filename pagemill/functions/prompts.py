"""Prompts filled as Columns, and the block of verified tables in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import prompts as pr
from . import text as tx

#: How a table of a format is introduced.
_INTRO = {
    "kpi_list": "Panel of values at {}; keep it as a list, never as a table:", "sectioned_table": "Table at {} in titled parts with the same header each; keep all parts in order, each under its heading:",
    "title_detail_table": "Table at {}; first cells join a title and its detail by <br>; keep them whole, and the one header row:", "regular_table": "Table at {}; keep it as one table with its one header row:",
}


def fill(template: str, **values: Column) -> Column:
    """A template with Columns in its places: its pieces in order, so a value that holds braces is never read as one."""
    import string

    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        parts += ([F.lit(text)] if text else []) + ([F.coalesce(values[name], F.lit(""))] if name is not None else [])
    return F.concat(*parts)


def verified_tables(tables: Column) -> Column:
    """Verified tables (array of struct bbox, markdown, format, complete) as text; those whose symbols have no place stay out."""
    good = F.filter(tables, lambda t: t["complete"] & (tx.strip(F.coalesce(t["markdown"], F.lit(""))) != ""))

    def intro(t: Column) -> Column:
        box = F.concat(F.lit("["), F.array_join(F.transform(t["bbox"], lambda x: x.cast("string")), ", "), F.lit("]"))
        say = lambda text: F.concat(F.lit(text.split("{}")[0]), box, F.lit(text.split("{}")[1]))
        out = F.when(F.lit(False), F.lit(""))
        for name, text in _INTRO.items():
            out = out.when(t["format"] == name, say(text))
        return F.concat(out.otherwise(say("Table at {}:")), F.lit("\n"), tx.strip(t["markdown"]))

    return F.when(F.size(good) > 0, F.array_join(F.transform(good, intro), "\n\n")).otherwise("(none)")


def refine_prompt(template: str, markdown: Column, blocks: Column, tables: Column) -> Column:
    return fill(template, source_markdown=markdown, layout_blocks=blocks, verified_tables=verified_tables(tables))


def repair_prompt(template: str, markdown: Column, blocks: Column, tables: Column, lines: Column) -> Column:
    listed = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")
    return fill(template, current_markdown=markdown, layout_blocks=blocks, verified_tables=verified_tables(tables), unplaced_lines=F.when(F.size(lines) > 0, listed).otherwise(F.lit(pr.unplaced_block([]))))
