"""Picture records as Columns: whether a picture is worth a call, what an answer says, and how it stands in a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Pictures
from . import geometry as geo
from . import markdown as md
from . import text as tx

#: Kinds that a triage may name, labels that decide, kinds of summaries, thresholds.
TRIAGE_TYPES = ("photo", "table", "kpi", "chart", "infographic", "map", "diagram", "decorative", "unclear", "symbol")
DECORATIVE = ("icon", "logo", "decorative", "stamp", "background")
SEMANTIC = ("chart", "diagram", "figure", "graph", "map", "table", "infographic")
SUMMARY_TYPES = ("photo", "table", "chart", "kpi", "infographic", "map", "diagram")
SYMBOL_MARGIN, PHOTO_CHARS = 0.005, 400
PICTURES = Pictures()  #: settings where none are given
NAVIGATION, RIGHT_EDGE = ("too_small", "triage_decorative", "triage_photo"), 0.9
SYMBOL_CODE, CODE_SEQUENCE = r"^[A-Z]{1,3}\d{0,2}\z", r"^[EGS]\d{1,2}(?:\s+[EGS]\d{1,2})+\z"
_TYPE_LINE = r"(?i)^\s*TYPE:\s*([a-z]+)\s*\z"


def classification_text(parts: Column) -> Column:
    return F.lower(F.array_join(F.filter(parts, lambda x: x.isNotNull()), " "))


def _haystack(classification: Column, caption: Column) -> Column:
    return F.lower(F.concat(F.coalesce(classification, F.lit("")), F.lit(" "), F.coalesce(caption, F.lit(""))))


def _has_any(text: Column, labels: tuple[str, ...]) -> Column:
    return F.rlike(text, F.lit("|".join(labels)))


def summarize(embedded_in: Column, area: Column, classification: Column, caption: Column, s: Pictures = PICTURES) -> Column:
    """struct(wanted, reason): the first rule that decides whether a picture is described."""
    words = _haystack(classification, caption)
    say = lambda wanted, reason: F.struct(F.lit(wanted).alias("wanted"), F.lit(reason).alias("reason"))
    return (
        F.when(embedded_in == "picture", say(False, "covered_by_parent")).when(embedded_in == "table", say(True, "table_embedded")).when(area < s.min_area_ratio, say(False, "too_small"))
        .when(_has_any(words, DECORATIVE) & (area < s.decorative_max_area_ratio), say(False, "decorative")).when(area >= s.decorative_max_area_ratio, say(True, "large_picture"))
        .when(_has_any(words, SEMANTIC), say(True, "semantic_label")).otherwise(say(False, "not_semantic"))
    )


def triage(answer: Column) -> Column:
    """struct(kind, confidence, warnings) of a model's JSON answer, in fences or among other text."""
    text = tx.strip(md.strip_meta(tx.strip_fences(answer)))
    whole = F.try_parse_json(text)
    inner = F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))
    value = F.coalesce(whole, inner)
    is_object = F.startswith(F.coalesce(F.schema_of_variant(value), F.lit("")), F.lit("OBJECT"))

    def read(v: Column) -> Column:
        named = F.coalesce(F.nullif(F.try_variant_get(v, F.lit("$.type"), "string"), F.lit("")), F.lit("unclear"))
        kind = F.lower(tx.strip(named))
        given = F.try_variant_get(v, F.lit("$.confidence"), "variant")
        number = F.try_variant_get(v, F.lit("$.confidence"), "double")
        wrong = given.isNotNull() & number.isNull()
        warnings = F.filter(F.array(F.when(~kind.isin(*TRIAGE_TYPES), "triage_unknown_type"), F.when(wrong, "triage_invalid_confidence")), lambda x: x.isNotNull())
        known = F.when(kind.isin(*TRIAGE_TYPES), kind).otherwise("unclear")
        return F.struct(known.alias("kind"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(number, F.lit(0.0)))).alias("confidence"), warnings.alias("warnings"))

    bad = lambda why: F.struct(F.lit("unclear").alias("kind"), F.lit(0.0).alias("confidence"), F.array(F.lit(why)).alias("warnings"))
    return F.when(value.isNull(), bad("triage_invalid_json")).when(~is_object, bad("triage_invalid_payload")).otherwise(read(value))


def typed_summary(answer: Column) -> Column:
    """struct(kind, body) of an answer that starts with a line `TYPE: x`; kind is empty where that is missing or unknown."""
    text = tx.strip(answer)
    first, rest = F.substring_index(text, "\n", 1), F.when(F.contains(text, F.lit("\n")), F.regexp_extract(text, r"(?s)^[^\n]*\n(.*)\z", 1)).otherwise("")
    kind = F.lower(F.regexp_extract(first, _TYPE_LINE, 1))
    typed = kind.isin(*SUMMARY_TYPES)
    return F.struct(F.when(typed, kind).otherwise("").alias("kind"), F.when(typed, tx.strip(rest)).otherwise(text).alias("body"))


def symbol_summary(summary: Column) -> Column:
    """Several codes of a symbol with commas between."""
    value = tx.strip(summary)
    return F.when(F.rlike(value, F.lit(CODE_SEQUENCE)), F.regexp_replace(value, r"\s+", ", ")).otherwise(value)


def shape_ok(kind: Column, body: Column, s: Pictures = PICTURES) -> Column:
    """Whether an answer has the shape of its kind: a symbol is one short line, a photo a short text, a table has rows, the rest has
    lines with values."""
    pipes = md.pipe_row_count(body)
    values = F.size(F.filter(md.lines_of(body), lambda x: F.contains(x, F.lit(":")) | tx.is_pipe_line(x)))
    return (
        F.when(F.coalesce(body, F.lit("")) == "", False).when(kind == "symbol", ~F.contains(body, F.lit("\n")) & (F.length(tx.strip(body)) <= s.symbol_max_chars))
        .when(kind == "photo", F.length(body) <= PHOTO_CHARS).when(kind == "table", pipes >= 2).when(kind.isin(*SUMMARY_TYPES), (values >= 2) | (pipes >= 2)).otherwise(True)
    )


def summary_rect(rect: Column, cells: Column, s: Pictures = PICTURES) -> Column:
    """A picture's rectangle grown over the text lines next to it, one after the other, with a margin.  A fold over the cells of
    a page, in their order, as each may bring the next one near."""

    def step(g: Column, c: Column) -> Column:
        wide, high = F.least(g[2], c[2]) - F.greatest(g[0], c[0]), F.least(g[3], c[3]) - F.greatest(g[1], c[1])
        above = (-high <= s.crop_neighbor_gap) & (wide >= 0.5 * (c[2] - c[0]))
        beside = (-wide <= s.crop_neighbor_gap) & (high >= 0.5 * (c[3] - c[1]))
        return F.when(above | beside, F.array(F.least(g[0], c[0]), F.least(g[1], c[1]), F.greatest(g[2], c[2]), F.greatest(g[3], c[3]))).otherwise(g)

    edge = lambda g: F.array(*[F.greatest(F.lit(0.0), g[i] - s.crop_margin) for i in (0, 1)], *[F.least(F.lit(1.0), g[i] + s.crop_margin) for i in (2, 3)])
    return F.when(rect.isNotNull(), F.aggregate(cells, rect, step, edge))


def table_like(area: Column, rect: Column, classification: Column, caption: Column, near: Column, s: Pictures = PICTURES) -> Column:
    """struct(yes, reason, confidence): whether a picture may hold a table; `near` says that structured text is close."""
    words = _haystack(classification, caption)
    aspect = F.when(rect.isNotNull(), geo.aspect(rect)).otherwise(F.lit(0.0))
    low = F.coalesce((aspect >= 1.8) & (rect[1] >= 0.32), F.lit(False))
    semantic = _has_any(words, SEMANTIC)
    why = F.array_join(F.filter(F.array(F.when(aspect >= 2.2, "wide_region"), F.when(low, "lower_wide_region"), F.when(semantic, "semantic_label"), F.when(near, "nearby_structured_text")), lambda x: x.isNotNull()), ",")
    points = F.lit(0.55) + F.when(aspect >= 2.2, 0.15).otherwise(0.0) + F.when(low, 0.1).otherwise(0.0) + F.when(semantic, 0.15).otherwise(0.0) + F.when(near, 0.15).otherwise(0.0)
    say = lambda yes, reason, sure: F.struct(F.lit(yes).alias("yes"), reason.alias("reason"), sure.alias("confidence"))
    no = lambda reason: say(False, F.lit(reason), F.lit(0.0))
    return (
        F.when(area < s.table_min_area_ratio, no("picture_too_small")).when(_has_any(words, DECORATIVE), no("decorative_picture")).when(~(low | semantic | near), no("no_table_signal"))
        .otherwise(say(True, F.when(why == "", "picture_table_signal").otherwise(why), F.round(F.least(points, F.lit(0.95)), 3)))
    )


def reference(page: Column, index: Column, path: Column) -> Column:
    return F.concat(tx.picture_placeholder(page, index), F.lit("("), path, F.lit(")"))


def block(kind: Column, summary: Column, redundant: Column, ref: Column) -> Column:
    """How a picture stands in Markdown: a symbol as its value, else its reference and what its summary adds."""
    text = tx.strip(F.coalesce(summary, F.lit("")))
    return F.when(kind == "symbol", text).when((text != "") & ~redundant, F.concat(ref, F.lit("\n\n**Image summary:** "), text)).otherwise(ref)


def is_navigation(rect: Column, embedded_in: Column, summary: Column, skip_reason: Column, wanted: Column) -> Column:
    """A skipped picture in the right edge: never appended to a page."""
    at_edge = F.coalesce(rect[0] >= RIGHT_EDGE, F.lit(False)) & (F.coalesce(embedded_in, F.lit("")) != "table")
    return at_edge & (tx.strip(F.coalesce(summary, F.lit(""))) == "") & (skip_reason.isin(*NAVIGATION) | ~wanted)


def specialist(kind: Column, prompts: dict[str, str], generic: Column) -> Column:
    """The prompt of a kind of picture, under the line that the answer must start with; the generic one for any other."""
    body = F.create_map(*[F.lit(x) for k, v in prompts.items() for x in (k, v)])[kind]
    head = F.concat(F.lit("The picture is of type "), kind, F.lit(".\nStart the answer with the line `TYPE: "), kind, F.lit("`.\n\n"))
    return F.when(body.isNotNull(), F.concat(head, body)).otherwise(generic)


def figure_marks(text: Column) -> Column:
    """<img> tags of a recogniser as marks on lines of their own: a chart by its name or by four tenths of the width, else a figure."""
    tag = r"(?is)<div[^>]*>\s*(?:<img\b[^>]*/?>)\s*</div>|<img\b[^>]*/?>"
    found, between = F.regexp_extract_all(text, F.lit(f"({tag})"), F.lit(1)), F.split(text, tag, -1)
    wide = lambda t: F.coalesce(F.regexp_extract(t, r'(?i)width="?(\d+)%', 1).try_cast("int"), F.lit(0)) >= 40
    chart = lambda t: F.rlike(F.lower(F.regexp_extract(t, r'(?i)src="?([^"\s>]*)', 1)), F.lit("chart")) | wide(t)
    marks = F.transform(found, lambda t: F.when(chart(t), "[CHART HERE]").otherwise("[FIGURE HERE]"))
    return F.array_join(F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(marks, i), F.lit("")))), "")


def strip_figure_marks(text: Column) -> Column:
    return md.joined(F.filter(md.lines_of(text), lambda x: ~F.rlike(tx.strip(x), F.lit(r"^\[(?:CHART|FIGURE) HERE"))), text)
