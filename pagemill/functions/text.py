"""Text rules as Columns: tokens, keys, predicates and rewrites of single lines or texts.

Everything here stays on the JVM.  `(?U)` makes \\s, \\w and \\b Unicode-aware, as the rules need; rules that are
ASCII on purpose do without.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------------------------
BULLETS = "•●▪◦‣·∙"
STRONG_BULLETS = "•●▪◦‣■"
WEAK_BULLETS = "·∙"
STOPWORDS = (
    "the", "and", "for", "with", "that", "this", "from", "are", "was", "were", "our", "your", "their", "its", "has", "have", "had", "not",
    "but", "all", "per", "each", "into", "over", "under", "than", "then", "they", "them", "which", "who", "whom", "will", "shall", "can",
    "may", "these", "those", "of", "to", "in", "on", "at", "by", "as", "is", "be", "or", "an", "a",
)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))  # & last: keeps "&amp;lt;" literal
META_PATTERNS = (
    r"\bas per (?:the )?image\b", r"\bfirst[- ]pass\b", r"\bthe image shows\b", r"\bshould be included\b", r"\bthis text is preserved\b",
    r"\bthe (?:proposed|refined|original) (?:markdown|parse)\b",
)
VALUE_TEXT = (
    r"(?iU)^\s*(?:[~≈<>]\s*)?(?:[+-]\s*)?(?:[$€£]\s*)?\d[\d,.\s]*(?:\s*(?:%|x|pts?|bps?|bn|m|k|stars?))?(?:\s*[$€£])?"
    r"\s*(?:\((?:[A-Za-z]|\d{1,2})\))?\s*\z"
)
SHORT_VALUE = (
    r"(?iU)(?:%|[$€£]|(?:\d[\d,.\s]*)(?:pts?|bps?|bn|m|k|kg|g|t|tons?|tonnes?|co2|co2e|eur|usd|gbp|l|ml|ha|m3)\b|\d+[,.]\d+)"
)
SIGNIFICANT = r"[A-Za-z0-9%€$£.,-]*[A-Za-z0-9][A-Za-z0-9%€$£.,-]*"
NUMBER = r"\d+(?:[.,]\d+)*"
HEADING = r"^(#{1,6})\s+(.*)$"
IMAGE_LINE = r"(?i)^(?:!\[[^\]]*\]\([^)]*\)|<!--\s*image\s*-->|\{\{DOC_IMAGE_[^}]+\}\})\z"
FOOTNOTE_DEF = r"^\s*\[(\d{1,3})\]\s+\S"
SECTION_NUMBER, PAGE_NUMBER, ORDERED_ITEM = r"^\d+(?:\.\d+)+\z", r"^\d{1,3}\z", r"^(\s*)(\d{1,3})[.)]\s+(.+)\z"
LEADER_LINE, CONTENTS = r"\S(?:\.{3,}|\s{2,})\d{1,3}\s*\z", r"(?i)^#{1,6}\s*contents\b"
KPI_MAX_ROWS, KPI_MAX_COLS, KPI_MIN_VALUES, KPI_MIN_LABELS, KPI_MAX_CHARS, KPI_MIN_RATIO = 8, 6, 3, 2, 120, 0.6
# ----------------------------------------------------------------------------------------------------------------


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def strip(text: Column) -> Column:
    """Without white space at either end (Unicode white space too, unlike trim)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def collapse_ws(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def truncate(text: Column, limit: int) -> Column:
    """White space collapsed; beyond the limit, cut and marked by three dots."""
    flat = collapse_ws(text)
    return F.when(F.length(flat) > limit, F.concat(F.rtrim(F.substring(flat, 1, limit - 1)), F.lit("..."))).otherwise(flat)


def block_norm(text: Column) -> Column:
    return collapse_ws(F.lower(text))


def furniture_text(text: Column) -> Column:
    """Signature of repeated margin text: lower case, digits out, white space collapsed."""
    return collapse_ws(F.regexp_replace(F.lower(text), r"(?U)\d+", " "))


def numeric_tokens(text: Column) -> Column:
    """Distinct digit groups, decimal commas as points; never parsed as numbers."""
    return F.array_distinct(F.transform(_all(text, NUMBER), lambda x: F.replace(x, F.lit(","), F.lit("."))))


def significant_words(text: Column) -> Column:
    """Lower-case tokens of 4 characters or more, or with a digit, without stop words; repeats stay.  ASCII letters only."""
    words = F.transform(_all(F.lower(text), SIGNIFICANT), lambda w: F.btrim(w, F.lit(".,")))
    return F.filter(words, lambda w: ((F.length(w) >= 4) | F.rlike(w, F.lit("[0-9]"))) & ~w.isin(*STOPWORDS))


def word_tokens(text: Column, least: int = 4) -> Column:
    """Distinct lower-case words of letters only, of at least so many of them."""
    return F.array_distinct(F.transform(_all(text, rf"\p{{L}}{{{least},}}"), F.lower))


def distinctive_words(text: Column) -> Column:
    return word_tokens(text, 3)


def overlap_tokens(text: Column) -> Column:
    """Words, and numbers with their separators, in order."""
    return _all(F.lower(text), r"\d+(?:[.,]\d+)*|\p{L}+")


def is_value_text(text: Column) -> Column:
    """A short display value: number with sign, currency, unit or footnote mark; years too."""
    fixed = F.replace(F.replace(strip(text), F.lit("â‚¬"), F.lit("€")), F.lit("Â£"), F.lit("£"))
    return (F.length(strip(text)) <= 20) & F.rlike(fixed, F.lit(VALUE_TEXT))


def is_label_text(text: Column) -> Column:
    """A caption in capitals: 8 to 90 characters, two words, seven tenths of the letters capitals; digits only with 3 words."""
    t = strip(text)
    letters, capitals, words = F.regexp_count(t, F.lit(r"\p{L}")), F.regexp_count(t, F.lit(r"\p{Lu}")), F.regexp_count(t, F.lit(r"\p{L}+"))
    return F.length(t).between(8, 90) & (words >= 2) & (capitals >= 0.7 * letters) & (~F.rlike(t, F.lit(r"\d")) | (words >= 3))


def is_letter_rating(text: Column) -> Column:
    return F.rlike(strip(text), F.lit(r"^[A-Z][a-zA-Z]{0,3}[+-]?\d?\z"))


def is_bare_year(text: Column) -> Column:
    return F.rlike(strip(text), F.lit(r"^(?:19|20)\d{2}\z"))


def is_short_value(text: Column) -> Column:
    """A year, or a value with a unit, currency or decimals; a bare number of up to three digits is none."""
    t = strip(text)
    return F.when(is_bare_year(t), True).when(F.rlike(t, F.lit(r"^\d{1,3}\z")), False).otherwise(F.rlike(t, F.lit(SHORT_VALUE)))


def is_run_breaker(line: Column) -> Column:
    """Lines that end a run of loose values and labels."""
    t = strip(line)
    starts = F.rlike(t, F.lit(r"^(?:[#|>]|!\[|<!--|\*\*Image summary:\*\*|\(\w{1,3}\)\s)"))
    return starts | F.rlike(line, F.lit(r"^\s*-\s+.+:\s+")) | ((t != "") & F.rlike(t, F.lit(r"^[|\-: ]+\z")))


def is_chapter_tab_text(text: Column) -> Column:
    return F.rlike(strip(text), F.lit(r"^(?:\d{1,2}|[A-Z]|[-–—])\z"))


def is_distinctive_cell(text: Column) -> Column:
    return (F.length(text) >= 16) | (F.size(_all(text, r"\p{L}{3,}")) >= 3)


def is_numeric_cell(cell: Column) -> Column:
    return F.rlike(cell, F.lit(r"\d")) & (F.length(strip(cell)) <= 20) & (F.regexp_count(cell, F.lit(r"\p{L}")) <= 4)


def is_pipe_line(line: Column) -> Column:
    return F.startswith(strip(line), F.lit("|"))


def is_separator_line(line: Column) -> Column:
    """Rule of a pipe table: needs a dash or colon."""
    t = strip(line)
    return F.rlike(t, F.lit(r"^\|[|\-: ]*\z")) & F.rlike(t, F.lit("[-:]"))


def is_blank_rule(line: Column) -> Column:
    """Pipe row of nothing but rules or blanks."""
    return F.rlike(strip(line), F.lit(r"^\|?[\s|:-]+\|?\z"))


def split_row(line: Column) -> Column:
    """Cells of a pipe row; all outer pipes go, escapes are not honoured."""
    return F.transform(F.split(F.regexp_replace(strip(line), r"^\|+|\|+\z", ""), r"\|", -1), strip)


def escape_cell(text: Column) -> Column:
    return F.replace(collapse_ws(F.coalesce(text, F.lit(""))), F.lit("|"), F.lit(r"\|"))


def render_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def separator_row(width: Column) -> Column:
    return F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width))


def pad_row(cells: Column, width: Column) -> Column:
    return F.concat(cells, F.array_repeat(F.lit(""), F.greatest(F.lit(0), width - F.size(cells)).cast("int")))


def cell_runs(cells: Column) -> Column:
    """Cells that are not empty, with equal neighbours as one."""
    full = F.filter(cells, lambda c: c != "")
    return F.filter(full, lambda c, i: (i == 0) | (c != F.get(full, i - 1)))


def grid_cell_key(text: Column) -> Column:
    """Key of a cell: no emphasis, white space collapsed, lower case."""
    return F.lower(collapse_ws(F.regexp_replace(text, r"\*+|__", "")))


def list_line_text(line: Column) -> Column:
    return collapse_ws(F.regexp_extract(line, r"(?U)^\s*(?:[-*+]|\d+[.)])\s+(.*)$", 1))


def cell_with_bullets(cell: Column) -> Column:
    """A cell that leads with a bullet, or holds two strong ones, as fragments `- item` joined by <br>."""
    t = strip(cell)
    leads, weak = F.rlike(t, F.lit(f"^[{STRONG_BULLETS}{WEAK_BULLETS}]")), F.rlike(t, F.lit(f"^[{WEAK_BULLETS}]"))
    parts = F.when(weak, F.split(t, f"[{STRONG_BULLETS}{WEAK_BULLETS}]", -1)).otherwise(F.split(t, f"[{STRONG_BULLETS}]", -1))
    items = F.transform(F.transform(parts, strip), lambda p, i: F.when((p == "") | ((i == 0) & ~leads), p).otherwise(F.concat(F.lit("- "), p)))
    joined = F.array_join(F.filter(items, lambda p: p != ""), "<br>")
    is_list = leads | (F.regexp_count(t, F.lit(f"[{STRONG_BULLETS}]")) >= 2)
    return F.when(is_list & (joined != ""), joined).otherwise(t)


def became_bullet_list(before: Column, after: Column) -> Column:
    return (after != strip(before)) & (F.startswith(after, F.lit("- ")) | F.contains(after, F.lit("<br>- ")))


def split_inline_bullets(line: Column) -> Column:
    """`Prefix: • a • b` as the lines prefix, `- a`, `- b`."""
    bare = F.regexp_replace(line, rf"(?U)^\s*[{BULLETS}]\s*", "")
    leads = bare != line
    parts = F.transform(F.split(bare, rf"(?U)\s*[{BULLETS}]\s+", -1), strip)
    dash = lambda p: F.concat(F.lit("- "), p)
    many = F.filter(F.transform(parts, lambda p, i: F.when((p == "") | ((i == 0) & ~leads), p).otherwise(dash(p))), lambda p: p != "")
    one = F.when(leads & (parts[0] != ""), F.array(dash(parts[0]))).otherwise(F.array(line))
    return F.when(F.size(parts) == 1, one).when(F.size(many) > 0, many).otherwise(F.array(line))


def unescape_entities(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def clean_ocr(text: Column) -> Column:
    """Superscripts, subscripts, degrees, underlines, caret marks and bare text divisions of a recogniser, as plain text."""
    for pattern, new in (
        (r"\$\s*\\underline\{\\text\{([^}]*)\}\}\s*\$", "$1"), (r"\$\s*\^?\{?\s*\\circ\s*\}?\s*\$", "°"), (r"\$\s*\^\{\s*([^}]*?)\s*\}\s*\$", "$1"),
        (r"\$\s*_\{\s*([^}]*?)\s*\}\s*\$", "$1"), (r"\^(\[[^\]]{1,4}\])", "$1"), (r"(?is)<div[^>]*>\s*([^<>]*?)\s*</div>", "$1"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return text


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]+>", " ")


def clean_cell(text: Column) -> Column:
    """Text of a table cell: marks unwrapped, tags out, white space collapsed, pipes escaped."""
    plain = F.regexp_replace(text, r"\$\s*\^\{\s*([^}]*?)\s*\}\s*\$", "$1")
    return F.replace(collapse_ws(F.replace(strip_tags(plain), F.lit(" "), F.lit(" "))), F.lit("|"), F.lit(r"\|"))


def is_meta_note(line: Column) -> Column:
    """A line about the parse itself: matches a pattern and reads like a note."""
    low = F.regexp_replace(F.lower(strip(line)), r"^[>\-* ]+", "")
    note = F.rlike(low, F.lit(r"^(?:note|footnotes \(as per)|should be included|as per image|this text is preserved"))
    return F.rlike(line, F.lit("(?i)" + "|".join(META_PATTERNS))) & note


def strip_fences(text: Column) -> Column:
    """Without an outer fence of backticks."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```[A-Za-z0-9_-]*\s*\n?", ""), r"\n?```\s*\z", ""))


def redact_url(url: Column) -> Column:
    return F.regexp_replace(url, r"://[^/@]*@", "://")


def token_estimate(text: Column) -> Column:
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(F.greatest(F.lit(1), F.bround(F.length(text) / 4).cast("int")))


def sectioned_heading(title: Column, qualifiers: Column, level: Column) -> Column:
    return F.concat_ws(" ", F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), level))), title, F.array_join(qualifiers, " "))


def section_title(cells: Column) -> Column:
    """Title of a row that spans its table: its first cell alone, or one long value in every filled cell; else null."""
    full = F.filter(cells, lambda c: c != "")
    alone = (F.get(cells, F.lit(0)) != "") & (F.size(full) == 1)
    only = F.get(full, F.lit(0))
    banner = (F.size(full) >= 2) & (F.size(F.array_distinct(full)) == 1) & F.rlike(only, F.lit(r"\p{L}")) & F.length(only).between(20, 120)
    return F.when(alone & (F.length(only) <= 120), only).when(~alone & banner, only)


def picture_placeholder(page: Column, index: Column) -> Column:
    return F.format_string("![Picture p%04d-i%03d]", page, index)


def sequence_repair(kind: Column, confidence: Column) -> Column:
    """Route of a picture by its class and confidence: specialist where sure, skip where a sure photo, else generic."""
    return F.when((kind == "photo") & (confidence >= 0.8), "skip").when(confidence >= 0.65, "specialist").otherwise("generic")
