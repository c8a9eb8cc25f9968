"""HTML tables inside Markdown texts as pipe tables.  Only texts that hold such a table travel to Python."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table, its rows and cells, other tags, superscript marks; widest span of a cell.
TABLE, PART = r"(?is)<table\b.*?</table>", r"(?i)<(/?)(tr|t[dh]|br)\b([^>]*)>"
SPAN, TAG, MARK = r"""(?i)\b{}\s*=\s*["']?\s*(\d+)""", r"<[^>]+>", r"\$\s*\^\{\s*([^}]*?)\s*\}\s*\$"
WIDEST = 1000


def _clean(text: str) -> str:
    text = re.sub(TAG, "", re.sub(MARK, r"\1", html.unescape(re.sub(TAG, "", text))))
    return " ".join(text.split()).replace("|", r"\|")


def cell_rows(table: str) -> list[list[tuple[str, int, int]]]:
    """Rows of (text, columns, rows) of one table; rows without a finished cell are left out."""
    rows: list[list] = []
    open_row, start, spans, text = False, None, (1, 1), ""
    for part in re.finditer(PART, table):
        closes, tag = bool(part[1]), part[2].lower()
        if tag == "br":
            if start is not None:
                text, start = text + table[start : part.start()] + " ", part.end()
        elif tag == "tr":
            open_row = not closes
            if open_row:
                rows.append([])
        elif not closes:
            wide, tall = (int(m[1]) if (m := re.search(SPAN.format(k), part[3])) else 1 for k in ("colspan", "rowspan"))
            start, text, spans = part.end(), "", (min(max(wide, 1), WIDEST), max(tall, 1))
        elif start is not None:
            if not open_row:
                rows.append([])
                open_row = True
            rows[-1].append((_clean(text + table[start : part.start()]), *spans))
            start = None
    return [r for r in rows if r]


def grid_of(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Dense rows: a spanning cell's text stands in every place that it covers, gaps are empty."""
    covered: dict[tuple[int, int], str] = {}
    for r, row in enumerate(rows):
        at = 0
        for text, wide, tall in row:
            while (r, at) in covered:
                at += 1
            for down in range(r, min(r + tall, len(rows))):
                for c in range(at, at + wide):
                    covered[down, c] = text
            at += wide
    width = max((c for _, c in covered), default=-1) + 1
    return [[covered.get((r, c), "") for c in range(width)] for r in range(len(rows))]


def flatten(markdown: str) -> str:
    """Every HTML table as a pipe table under its first row; one without cells stays as it is."""

    def piped(found: re.Match) -> str:
        grid = grid_of(cell_rows(found[0]))
        if not grid:
            return found[0]
        head, *body = [f"| {' | '.join(r)} |" for r in grid]
        return "\n" + "\n".join([head, f"| {' | '.join(['---'] * len(grid[0]))} |", *body]) + "\n"

    return re.sub(TABLE, piped, markdown)


@F.pandas_udf(T.StringType())
def _flattened(texts: pd.Series) -> pd.Series:
    return texts.map(flatten, na_action="ignore")


def flatten_html_tables(md: Column) -> Column:
    return F.coalesce(_flattened(F.when(F.rlike(md, F.lit(r"(?i)<table\b")), md)), md)
