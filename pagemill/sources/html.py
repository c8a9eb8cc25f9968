"""Web pages as layout items: the scan of a document source, on the JVM.

Tags that open a block cut the page into pieces; each piece is an item with kind, text and level.  Scripts, styles and
comments are no content.  Navigation, footer and advertising pieces carry the edge band that a page layout would give
them; the rest is body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

_BLOCK = r"(?is)<(h[1-6]|p|li|nav|footer|article|div|table|tr)\b([^>]*)>"


def items(pages: DataFrame, *, doc: Column | None = None) -> DataFrame:
    """(doc, page, pos, kind, level, band, text), pos from 0 in document order; pieces without text are left out.

    A null or empty page has no items.  `doc` names the document that a page belongs to (by default, its host)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1))
    clean = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!--.*?-->", "")
    marked = F.regexp_replace(clean, _BLOCK, "\u0001$1 $2\u0002")
    marked = F.regexp_replace(marked, r"(?is)</(nav|footer|article)>", "\u0001end $1\u0002")
    pieces = pages.select((host if doc is None else doc).alias("doc"), F.col("page_id").alias("page"), F.posexplode(F.split(marked, "\u0001")).alias("at", "piece"))
    tag = F.lower(F.regexp_extract("piece", r"(?s)^([A-Za-z0-9]+) [^\u0002]*\u0002", 1))
    rest = F.lower(F.regexp_extract("piece", r"(?s)^[A-Za-z0-9]+ ([^\u0002]*)\u0002", 1))
    body = F.regexp_replace("piece", r"(?s)^[A-Za-z0-9]+ [^\u0002]*\u0002", "")
    text = tx.collapse_ws(tx.unescape_entities(F.regexp_replace(F.regexp_replace(body, r"(?i)<br\s*/?>", " "), r"(?s)<[^>]*>", " ")))
    from ..operators.lines import page

    cut = pieces.select("doc", "page", F.col("at").alias("pos"), tag.alias("tag"), rest.alias("rest"), text.alias("text"))
    region = F.when(F.col("tag").isin("nav", "footer"), F.col("tag")).when(F.col("tag").isin("end", "article"), "body").when((F.col("tag") == "div") & F.contains("rest", F.lit('"ad"')), "ad")
    region = region.otherwise(F.when(F.col("tag") == "div", "body"))
    inside = F.last(region, ignorenulls=True).over(page("doc", "page"))
    kind = F.when(F.rlike("tag", F.lit("^h[1-6]$")), "section_header").when(F.col("tag") == "li", "list_item").when(F.col("tag") == "footer", "page_footer").otherwise("paragraph")
    band = F.when(inside == "nav", "top").when(inside == "footer", "bottom").when(inside == "ad", "right").otherwise("body")
    out = cut.withColumn("band", band).withColumn("kind", kind).withColumn("level", F.when(F.col("kind") == "section_header", F.substring("tag", 2, 1).cast("int")))
    out = out.where("text != ''").withColumn("pos", F.row_number().over(page("doc", "page")) - 1)
    return out.select("doc", "page", "pos", "kind", "level", "band", "text")


def item_markdown(kind: Column, level: Column, text: Column) -> Column:
    """Markdown line of an item."""
    return F.when(kind == "section_header", F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), level))), F.lit(" "), text)).when(kind == "list_item", F.concat(F.lit("- "), text)).otherwise(text)


def page_markdown(found: DataFrame) -> DataFrame:
    """(doc, page, markdown): items in order, a blank line between."""
    lines = F.array_sort(F.collect_list(F.struct("pos", item_markdown(F.col("kind"), F.col("level"), F.col("text")).alias("md"))))
    return found.groupBy("doc", "page").agg(F.concat(F.array_join(F.transform(lines, lambda x: x["md"]), "\n\n"), F.lit("\n")).alias("markdown"))


def block_rows(found: DataFrame) -> DataFrame:
    """Block records of each page: id, type, heading path, text (its first 500 characters) and text_full.

    The path keeps the headings before a level by position: path[:level - 1] plus the new one.  That is a fold over the
    page's headings; it runs per page on headings alone, and blocks look up the path of the last one at or before them."""
    from pyspark.sql import Window

    from ..operators.lines import page

    heads = found.where("kind = 'section_header'")
    so_far = F.collect_list(F.struct("level", "text")).over(page("doc", "page"))
    path = F.aggregate(so_far, F.array().cast("array<string>"), lambda p, x: F.concat(F.slice(p, F.lit(1), F.greatest(F.lit(0), x["level"] - 1)), F.array(x["text"])))
    heads = heads.select("doc", "page", "pos", path.alias("own_path"))
    rows = found.join(heads, ["doc", "page", "pos"], "left")
    last = F.last("own_path", ignorenulls=True).over(page("doc", "page").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "doc", "page", F.format_string("p%04d-b%04d", F.col("page"), F.col("pos") + 1).alias("block_id"), F.col("kind").alias("type"), F.array_join(F.coalesce(last, F.array().cast("array<string>")), " > ").alias("heading_path"),
        F.substring("text", 1, 500).alias("text"), F.col("text").alias("text_full"), F.length("text").alias("n_chars"),
    )
