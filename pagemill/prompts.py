"""Prompts as templates with named places, checked before a run starts.

A template may hold braces of its own only if they are doubled; that is found out here, not page by page."""

from __future__ import annotations

import string
from pathlib import Path

#: What each prompt must have places for.
PLACES = {
    "page_refine": ("source_markdown", "layout_blocks", "verified_tables"), "page_repair": ("current_markdown", "layout_blocks", "verified_tables", "unplaced_lines"), "picture": ("context",),
    "picture_triage": (), "picture_table": (), "picture_chart": (), "picture_values": (), "picture_photo": (), "picture_symbol": (), "table_region": ("region_blocks",), "kpi_panel": ("region_blocks",),
}
_TEXTS = {
    "page_refine": """You see a page and a first transcription of it in Markdown.  Correct the transcription against the page: wording, order, headings, lists and tables.
Leave nothing out and add nothing that the page does not show.  Keep every `<!-- image -->` mark where it stands.  Answer with Markdown alone.

Transcription:
{source_markdown}

Blocks of the page with their places:
{layout_blocks}

Tables that were checked already; use them word for word:
{verified_tables}
""",
    "page_repair": """You see a page, its Markdown, and lines of the page that the Markdown lacks.  Put each missing line where it belongs, and change nothing else.
Answer with the whole Markdown.

Markdown:
{current_markdown}

Missing lines:
{unplaced_lines}

Blocks of the page with their places:
{layout_blocks}

Tables that were checked already; use them word for word:
{verified_tables}
""",
    "picture": """Describe what the picture shows in a sentence or two, and write down every number and label that is printed in it.
Start with a line `TYPE: x`, where x is photo, table, chart, kpi, infographic, map or diagram.

Context:
{context}
""",
    "picture_triage": """Say what kind of picture this is: photo, table, kpi, chart, infographic, map, diagram, symbol, decorative or unclear.
Answer with JSON alone, in the form {{"type": "chart", "confidence": 0.9}}.
""",
    "picture_table": "Write the table in the picture as a Markdown table, cell by cell as printed.  Leave empty cells empty.\n",
    "picture_chart": "Write every printed label of the chart with its printed value, one pair a line as `label: value`.  Estimate nothing.\n",
    "picture_values": "Write the groups of labels and values in the picture, one pair a line as `label: value`, under the title of their group.\n",
    "picture_photo": "Say in one sentence what the photo shows.\n",
    "picture_symbol": "Write the code or word that is printed in the symbol, and nothing else.\n",
    "table_region": """Write the table in this part of the page as a Markdown table, cell by cell as printed.  Use no number that is not there.

Texts of the part with their places:
{region_blocks}
""",
    "kpi_panel": """Write the panel of values in this part of the page as a list, one line `- label: value` for each, and no table.

Texts of the part with their places:
{region_blocks}
""",
}


def places(template: str) -> set[str]:
    """Names that a template has places for; a brace that opens none is an error that says so."""
    try:
        return {name for _, name, _, _ in string.Formatter().parse(template) if name is not None}
    except ValueError as e:
        raise ValueError(f"a brace of the prompt is not doubled: {e}") from None


def require(template: str, *names: str) -> str:
    if missing := [n for n in names if n not in places(template)]:
        raise ValueError(f"the prompt has no place for {', '.join(missing)}")
    return template


def formattable(template: str, *names: str) -> str:
    """The template, if it needs nothing but the given names."""
    if strange := sorted(places(template) - set(names)):
        raise ValueError(f"the prompt has places that nothing fills: {', '.join(strange) or '(unnamed)'}; write {{{{ and }}}} for braces")
    return template


def load(name: str, path: str | Path | None = None) -> str:
    """A prompt by name, or one of the caller's own in its place; what that lacks of the required places is appended, but for the text
    that is worked on, which it must have."""
    if name not in _TEXTS:
        raise FileNotFoundError(f"no prompt named {name}")
    need = PLACES[name]
    if path is None:
        return formattable(require(_TEXTS[name], *need), *need)
    text = Path(path).expanduser().read_text(encoding="utf-8")
    if need and need[0].endswith("markdown"):
        require(text, need[0])
    for place in need:
        if place not in places(text):
            text = f"{text.rstrip()}\n\n{place.replace('_', ' ').capitalize()}:\n{{{place}}}\n"
    return formattable(text, *need)


def fill(template: str, **values: str) -> str:
    return template.format(**values)


def unplaced_block(lines: list[str]) -> str:
    return "\n".join(f"- {x}" for x in lines) or "(none: every line has its place; write no section of unplaced content)"
