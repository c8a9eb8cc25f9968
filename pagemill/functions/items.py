"""Fields of layout items as Columns.

An item is a struct of label, class_name, content_layer, text, orig, caption, marker, parent_ref, level, prov (array of
page_no and bbox) and grid (rows of cells).  Accessors take that struct; missing fields are nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import geometry as geo
from . import text as tx

BBOX = "struct<l:double,t:double,r:double,b:double,origin:string>"
CELL = (
    f"struct<text:string,column_header:boolean,bbox:{BBOX},start_row_offset_idx:int,end_row_offset_idx:int,start_col_offset_idx:int,end_col_offset_idx:int,row_span:int,col_span:int>"
)
ITEM = (
    "struct<label:string,class_name:string,content_layer:string,text:string,orig:string,caption:string,marker:string,parent_ref:string,level:int,"
    f"prov:array<struct<page_no:int,bbox:{BBOX}>>,grid:array<array<{CELL}>>>"
)
#: Bounds of the grid views (rows, columns, characters of a cell) and kinds that are no cells of a page.
PROMPT_GRID, SECTION_GRID, WHOLE_GRID = (12, 8, 80), (200, 32, 300), (200, 32, 10000)
NON_CELL_KINDS = ("footnote", "page_footer", "page_header")
LIST_KINDS, HEADINGS = ("list_item", "listitem"), ("title", "section_header")
NO_PARENT = "__no_parent__"


def _last_part(name: Column) -> Column:
    return F.lower(F.element_at(F.split(name, r"\.", -1), -1))


def kind(item: Column) -> Column:
    """Last part of the label, else the class name without a final Item, in lower case."""
    by_class = F.lower(F.regexp_replace(F.coalesce(item["class_name"], F.lit("")), r"(?i)item\z", ""))
    return F.when(F.coalesce(item["label"], F.lit("")) != "", _last_part(item["label"])).otherwise(by_class)


def layer(item: Column) -> Column:
    return F.coalesce(_last_part(item["content_layer"]), F.lit(""))


def page_number(item: Column) -> Column:
    """Page of the first place of an item; null without one."""
    return F.try_element_at(item["prov"], F.lit(1))["page_no"]


def bbox(item: Column) -> Column:
    return F.try_element_at(item["prov"], F.lit(1))["bbox"]


def bbox_of_values(values: Column) -> Column:
    """Four numbers as a box; null where there are fewer."""
    return F.when(F.size(values) >= 4, F.struct(*[F.get(values, i).cast("double").alias(c) for i, c in enumerate("ltrb")], F.lit(None).cast("string").alias("origin")))


def box_origin(box: Column) -> Column:
    return F.element_at(F.split(box["origin"], r"\.", -1), -1)


def _class_has(item: Column, part: str) -> Column:
    return F.contains(F.lower(F.coalesce(item["class_name"], F.lit(""))), F.lit(part))


def is_furniture(item: Column) -> Column:
    return kind(item).isin("page_header", "page_footer") | (layer(item) == "furniture")


def is_picture(item: Column) -> Column:
    return _class_has(item, "picture") | (kind(item) == "picture")


def is_table(item: Column) -> Column:
    return _class_has(item, "table") | (kind(item) == "table")


def is_heading(item: Column) -> Column:
    return _class_has(item, "title") | _class_has(item, "sectionheader") | kind(item).isin(*HEADINGS)


def is_list_item(item: Column) -> Column:
    return kind(item).isin(*LIST_KINDS)


def text_of(item: Column) -> Column:
    """The first of text, orig and caption that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(tx.strip(item[c]), F.lit("")) for c in ("text", "orig", "caption")], F.lit(""))


def caption_of(item: Column) -> Column:
    return F.coalesce(tx.strip(item["caption"]), F.lit(""))


def marker(item: Column) -> Column:
    return F.coalesce(tx.strip(item["marker"]), F.lit(""))


def parent_key(item: Column) -> Column:
    return F.coalesce(item["parent_ref"], F.lit(NO_PARENT))


def heading_level(item: Column) -> Column:
    """1 to 6: a section header's own level plus one, at least 2; a title is 1, anything without a level 2."""
    given = F.when(item["level"] != 0, item["level"])
    clamp = lambda x, least: F.greatest(F.lit(least), F.least(F.lit(6), x))
    return F.when(given.isNotNull(), F.when(kind(item) == "section_header", clamp(given + 1, 2)).otherwise(clamp(given, 1))).when(_class_has(item, "title") | (kind(item) == "title"), 1).otherwise(2)


def prompt_type(item: Column) -> Column:
    return F.when(is_picture(item), "picture").when(is_table(item), "table").when(kind(item) == "text", "paragraph").otherwise(kind(item))


def markdown(item: Column, level: Column, has_record: Column, table_md: Column) -> Column:
    """An item as a line: pictures that were saved leave their placeholder, tables their rendering or text."""
    body = text_of(item)
    return (
        F.when(is_picture(item), F.when(has_record, "<!-- image -->").otherwise("")).when(is_table(item), F.coalesce(F.nullif(table_md, F.lit("")), body)).when(body == "", "")
        .when(is_heading(item), F.concat(F.repeat(F.lit("#"), heading_level(item)), F.lit(" "), body)).when(is_list_item(item), F.concat(F.repeat(F.lit("  "), level), F.lit("- "), body)).otherwise(body)
    )


def items_of(documents: DataFrame, *keys: str) -> DataFrame:
    """A row for each item of a document, in order: (keys, pos, item, page)."""
    return documents.select(*keys, F.posexplode("items").alias("pos", "item")).withColumn("page", page_number(F.col("item")))


def body_and_furniture(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    return items.where(~is_furniture(F.col("item"))), items.where(is_furniture(F.col("item")))


def list_levels(items: DataFrame, *keys: str) -> DataFrame:
    """Rows of list items with `list_level`: 1 for items with a marker whose group has items without, 0 for the latter; null in
    groups where all have one.  One window by parent."""
    lists = items.where(is_list_item(F.col("item"))).withColumn("marked", marker(F.col("item")) != "")
    some = F.min("marked").over(Window.partitionBy(*keys, parent_key(F.col("item"))))
    return lists.withColumn("list_level", F.when(~some, F.col("marked").cast("int"))).drop("marked")


# --- table grids of items -----------------------------------------------------------------------------------------


def cell_text(cell: Column) -> Column:
    return F.coalesce(tx.strip(cell["text"]), F.lit(""))


def grid_rows(grid: Column, bounds: tuple[int, int, int] = PROMPT_GRID) -> Column:
    """A bounded view of a grid: so many rows, columns and characters a cell, white space collapsed."""
    rows, cols, chars = bounds
    view = lambda cell: F.substring(tx.collapse_ws(cell_text(cell)), 1, chars)
    return F.coalesce(F.transform(F.slice(grid, 1, rows), lambda r: F.transform(F.slice(r, 1, cols), view)), F.array().cast("array<array<string>>"))


def header_rows(grid: Column) -> Column:
    """Leading rows that hold a column header; none in a grid of one row."""
    flags = F.transform(grid, lambda r: F.exists(r, lambda c: F.coalesce(c["column_header"], F.lit(False))))
    first = F.array_position(flags, False)
    return F.when((F.size(grid) >= 2) & (F.size(F.get(grid, F.lit(0))) > 0), F.when(first > 0, first - 1).otherwise(F.size(grid)).cast("int")).otherwise(0)


def is_headerless(grid: Column) -> Column:
    """Several header rows whose first one repeats in two cells further down: no header at all."""
    later = F.transform(F.flatten(F.slice(grid, F.lit(2), F.greatest(F.lit(0), F.size(grid) - 1))), cell_text)
    again = F.filter(F.transform(F.get(grid, F.lit(0)), cell_text), lambda x: (x != "") & F.array_contains(later, x))
    return F.coalesce((header_rows(grid) > 1) & (F.size(again) >= 2), F.lit(False))


def first_row(grid: Column) -> Column:
    return F.transform(F.get(grid, F.lit(0)), cell_text)


def structured(grid: Column) -> Column:
    """struct(rows, num_cols, header_rows, cells): the whole grid with the place and spans of every cell."""
    rows = grid_rows(grid, WHOLE_GRID)
    some = F.transform(F.slice(grid, 1, WHOLE_GRID[0]), lambda r: F.slice(r, 1, WHOLE_GRID[1]))
    fields = ("bbox", "column_header", "start_row_offset_idx", "end_row_offset_idx", "start_col_offset_idx", "end_col_offset_idx", "row_span", "col_span")
    one = lambda r, i: F.transform(
        r, lambda c, j: F.struct(i.alias("r"), j.alias("c"), F.substring(tx.collapse_ws(cell_text(c)), 1, WHOLE_GRID[2]).alias("text"), *[c[f].alias(f) for f in fields])
    )
    return F.struct(rows.alias("rows"), F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0)).alias("num_cols"), header_rows(grid).alias("header_rows"), F.flatten(F.transform(some, one)).alias("cells"))


def detection_cells(items: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """Cells of a page for the region search: items with text and a place that are neither picture, table nor margin text."""
    item = F.col("item")
    box = bbox(item)
    rect = geo.from_points(box["l"], box["t"], box["r"], box["b"], page_w, page_h, F.coalesce(F.upper(box_origin(box)) == "BOTTOMLEFT", F.lit(False)))
    rows = items.withColumn("rect", rect).withColumn("text", tx.collapse_ws(text_of(item)))
    rows = rows.where(~is_picture(item) & ~is_table(item) & ~kind(item).isin(*NON_CELL_KINDS) & (F.col("text") != "") & F.col("rect").isNotNull())
    return rows.withColumn("id", F.format_string("b%04d", F.col("pos") + 1)).withColumn("is_heading", is_heading(item))


def assert_items(df: DataFrame) -> DataFrame:
    """The table itself, if it has items to read."""
    if "items" not in df.columns:
        raise TypeError("the source has no items column")
    return df
