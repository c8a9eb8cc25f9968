"""The map of a page that goes into a prompt: blocks with a place, and the text of those that may matter.

Entries are rows (keys, pos, rect, area, kind, type, text, caption, is_picture, is_table, is_heading, list_level, marker, …) made
from items; neighbours are found by grid squares, so a page is not compared pair by pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import items as it
from ..functions import text as tx
from .layout import timeline

#: Expressions of values, distance of neighbours, lengths of texts.
VALUE_SIGNAL = (
    r"(?i)(?:\b(?:19|20)\d{2}\b|\d[\d,.\s]*(?:%|pts?|bps?|bn|m|k|kg|g|t|tons?|tonnes?|co2|co2e|eur|usd|gbp|l|ml|ha|m3)\b|[$€£]\s*\d|\d[\d,.\s]*[$€£])"
)
VALUE_ONLY = r"(?i)^\s*(?:[<>~]?\s*)?(?:\+|-)?(?:\d[\d,.\s]*)(?:%|pts?|bn|m|k|yo|yo\.|€|\$|£|cumulated)?\s*\z"
YEAR, NEAR, SHORT_TEXT, SMALL_AREA, TEXT_CHARS, TABLE_CHARS, LINE_PROBE, REGION_CHARS, TIMELINE = r"^(?:19|20)\d{2}\z", 0.12, 240, 0.03, 240, 500, 120, 300, 0.08
_U = "(?U)"
DIGIT = _U + r"\d"


def has_value_signal(text: Column) -> Column:
    return F.rlike(text, F.lit(_U + VALUE_SIGNAL))


def is_timeline_text(text: Column) -> Column:
    t = tx.strip(text)
    return F.rlike(t, F.lit(YEAR)) | F.rlike(t, F.lit(_U + VALUE_ONLY))


def is_value_cell(text: Column) -> Column:
    """A value alone, or a short text with one; white space at the ends counts for the length only."""
    short = (F.length(text) <= 160) | (F.length(tx.strip(text)) <= 160)
    return F.rlike(text, F.lit(_U + VALUE_ONLY)) | (short & has_value_signal(text))


def is_table_like(kind: Column) -> Column:
    return kind.isin("table", "table_cell", "caption") | F.contains(kind, F.lit("table"))


def matches_unplaced(text: Column, lines: Column) -> Column:
    """Whether a text lies in a line that was lost, or the start of one in it."""
    low = F.lower(text)
    full = F.filter(F.transform(lines, lambda x: tx.strip(F.lower(x))), lambda x: x != "")
    return F.coalesce((text != "") & F.exists(full, lambda x: F.contains(x, low) | F.contains(low, F.substring(x, 1, LINE_PROBE))), F.lit(False))


def neighbours(entries: DataFrame, *keys: str) -> DataFrame:
    """Entries with `structural`: how many others within NEAR are pictures, tables, headings, captions, values or points of a time
    line.  Centres are dealt to squares of that size, and each meets its own square and those around it."""
    r = F.col("rect")
    at = lambda x: F.floor(x / NEAR).cast("int")
    own = entries.where("rect is not null").select(*keys, "pos", geo.centre_x(r).alias("x"), geo.centre_y(r).alias("y"), "structure")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    left = own.select(*keys, F.col("pos").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), around.alias("d"))
    left = left.select(*keys, "a", "ax", "ay", (at(F.col("ax")) + F.col("d.dx")).alias("gx"), (at(F.col("ay")) + F.col("d.dy")).alias("gy"))
    right = own.where("structure").select(*keys, F.col("pos").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), at(F.col("x")).alias("gx"), at(F.col("y")).alias("gy"))
    met = left.join(right, [*keys, "gx", "gy"]).where((F.col("a") != F.col("b")) & (F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2)) <= NEAR))
    counts = met.groupBy(*keys, F.col("a").alias("pos")).agg(F.count("*").alias("structural"))
    return entries.join(counts, [*keys, "pos"], "left").withColumn("structural", F.coalesce("structural", F.lit(0)))


def entries_of(items: DataFrame, page_w: Column, page_h: Column, unplaced: Column | None = None) -> DataFrame:
    """Entries from items (keys, pos, item): those with a place, and those without whose text must not be lost."""
    item, lost = F.col("item"), F.array().cast("array<string>") if unplaced is None else unplaced
    box = it.bbox(item)
    bottom = F.coalesce(F.upper(it.box_origin(box)) == "BOTTOMLEFT", F.lit(False))
    rect = geo.from_points(box["l"], box["t"], box["r"], box["b"], page_w, page_h, bottom)
    e = items.withColumns(
        {
            "id": F.format_string("b%04d", F.col("pos") + 1), "kind": it.kind(item), "type": it.prompt_type(item), "rect": rect, "text": it.text_of(item), "caption": it.caption_of(item),
            "area": F.coalesce(geo.area_ratio(box["l"], box["t"], box["r"], box["b"], page_w, page_h), F.lit(0.0)), "is_picture": it.is_picture(item), "is_table": it.is_table(item),
            "is_heading": it.is_heading(item), "is_list": it.is_list_item(item), "marker": it.marker(item),
        }
    )
    critical = (F.col("text") != "") & (has_value_signal(F.col("text")) | matches_unplaced(F.col("text"), lost))
    return e.where(F.col("rect").isNotNull() | critical).withColumn("unplaced_match", matches_unplaced(F.col("text"), lost))


def in_context(entries: DataFrame, *keys: str) -> DataFrame:
    """Entries with in_timeline, structural, and `included`: whether their text belongs in the prompt."""
    points = timeline(entries.where("rect is not null").where(is_timeline_text(F.col("text"))), TIMELINE, *keys).select(*keys, "pos", F.lit(True).alias("in_timeline"))
    e = entries.join(points, [*keys, "pos"], "left").withColumn("in_timeline", F.coalesce("in_timeline", F.lit(False)))
    structure = F.col("is_picture") | F.col("is_table") | F.col("is_heading") | (F.col("kind") == "caption") | F.col("in_timeline") | has_value_signal(F.col("text"))
    return neighbours(e.withColumn("structure", structure), *keys).withColumn("included", should_include())


def should_include() -> Column:
    """Why a text may matter: a heading, part of a table, a value, short and small, near structure, lost before, or on a time line."""
    text = tx.strip(F.col("text"))
    small = (F.length(text) <= SHORT_TEXT) & (F.col("area") <= SMALL_AREA)
    any_ = F.col("is_heading") | is_table_like(F.col("kind")) | has_value_signal(text) | small | (F.col("structural") > 0) | F.col("unplaced_match") | F.col("in_timeline") | is_timeline_text(text)
    return F.coalesce((text != "") & any_, F.lit(False))


def blocks(entries: DataFrame, pictures: DataFrame | None, *keys: str) -> DataFrame:
    """Blocks of a page's map: (keys, pos, block), a struct with what each type needs.  pictures: (keys, pos, picture_index, value)."""
    e = entries if pictures is None else entries.join(pictures, [*keys, "pos"], "left")
    if pictures is None:
        e = e.withColumns({"picture_index": F.lit(None).cast("int"), "value": F.lit(None).cast("string")})
    if "list_level" not in e.columns:
        e = e.withColumn("list_level", F.lit(0))
    grid = F.col("item")["grid"]
    limit = F.when(F.col("is_table"), TABLE_CHARS).otherwise(TEXT_CHARS)
    cut = lambda c, n: F.when(F.length(tx.collapse_ws(c)) > n, F.concat(F.rtrim(F.substring(tx.collapse_ws(c), F.lit(1), n - 1)), F.lit("..."))).otherwise(tx.collapse_ws(c))
    text = F.when(F.col("is_list"), tx.truncate(F.col("text"), 500)).when(~F.col("is_picture") & F.col("included"), cut(F.col("text"), limit))
    symbol = F.col("is_picture") & (F.coalesce("value", F.lit("")) != "")
    headerless = F.col("is_table") & it.is_headerless(grid)
    block = F.struct(
        "id", "type", F.col("rect").alias("bbox"), F.when(F.col("is_picture"), F.col("picture_index")).alias("picture_index"),
        F.when(F.col("is_picture") & (F.col("caption") != ""), tx.truncate(F.col("caption"), 240)).alias("caption"), F.when(symbol, "table_symbol").alias("role"), F.when(symbol, F.col("value")).alias("value"),
        F.when(F.col("is_list"), F.coalesce("list_level", F.lit(0))).alias("list_level"), F.when(F.col("is_list") & (F.col("marker") != ""), F.col("marker")).alias("marker"),
        F.when(headerless, True).alias("headerless"), F.when(headerless, it.first_row(grid)).alias("first_row"), F.when(F.col("is_table") & (F.size(grid) > 0), it.grid_rows(grid)).alias("grid_rows"), text.alias("text"),
    )
    return e.select(*keys, "pos", block.alias("block"))


def page_map(found: DataFrame, *keys: str) -> DataFrame:
    """(keys, blocks, layout_block_count, layout_text_block_count): a page's blocks in order, with the counts of its map."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "block"))), lambda x: x["block"])
    has = F.col("block.text").isNotNull() & (F.col("block.text") != "") | (F.coalesce("block.caption", F.lit("")) != "")
    return found.groupBy(*keys).agg(ordered.alias("blocks"), F.count("*").alias("layout_block_count"), F.count_if(has).alias("layout_text_block_count"))


def annotate(maps: DataFrame, values: DataFrame, *keys: str) -> DataFrame:
    """Maps whose picture blocks have the symbol values (keys, values: map of picture index to value) that are known now, and no others."""
    met = maps.join(values.withColumnRenamed("values", "known"), list(keys), "left")

    def one(b: Column) -> Column:
        value = F.nullif(tx.strip(F.try_element_at("known", b["picture_index"])), F.lit(""))
        listed = F.map_contains_key(F.col("known"), b["picture_index"])
        new = b.withField("value", value).withField("role", F.when(value.isNotNull(), "table_symbol"))
        return F.when(F.coalesce(b["picture_index"].isNotNull() & listed, F.lit(False)), new).otherwise(b)

    return met.withColumn("blocks", F.transform("blocks", one)).drop("known")


def map_json(page_w: Column, page_h: Column) -> Column:
    """The map as compact JSON; fields that a block does not have are left out, and nothing private was ever in it."""
    return F.to_json(F.struct(F.array(F.round(page_w, 3), F.round(page_h, 3)).alias("page_size"), F.col("blocks").alias("blocks")))


def region_json(cells: Column) -> Column:
    """Cells (id, rect, text) of a region as compact JSON, texts cut."""
    return F.to_json(F.transform(cells, lambda c: F.struct(c["id"].alias("id"), c["rect"].alias("bbox"), tx.truncate(c["text"], REGION_CHARS).alias("text"))))


def cells_of_map(maps: DataFrame, *keys: str) -> DataFrame:
    """Cells for the region search from a saved map, whose texts may be cut."""
    b = maps.select(*keys, F.posexplode("blocks").alias("pos", "b"))
    text = tx.collapse_ws(F.coalesce("b.text", F.lit("")))
    good = ~F.col("b.type").isin("picture", "table", *it.NON_CELL_KINDS) & (text != "") & F.col("b.bbox").isNotNull()
    return b.where(good).select(*keys, "pos", F.col("b.id").alias("id"), F.col("b.bbox").alias("rect"), text.alias("text"), F.col("b.type").isin(*it.HEADINGS).alias("is_heading"))
