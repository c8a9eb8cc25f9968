"""Page furniture: text at the edges that repeats over pages.

Entries are rows (doc, page, pos, text, band); band is top, bottom, right or body.  A signature counts once a page;
the threshold follows the number of pages of the document, pages without entries included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: Width of the edge bands, pages that confirm, pages and share of a short run, tokens and length of a prefix.
BAND, MIN_PAGES, SHORT_RUN, SHORT_SHARE, PREFIX_TOKENS, PREFIX_CHARS = 0.08, 3, 12, 0.25, 4, 12


def band(rect: Column) -> Column:
    """Edge band of a normalised rectangle [left, top, right, bottom]."""
    return (
        F.when(rect.isNull() | (F.size(rect) < 4), "body").when(rect[1] <= BAND, "top").when(rect[3] >= 1 - BAND, "bottom").when(rect[0] >= 1 - BAND, "right").otherwise("body")
    )


def signature(text: Column, where: Column) -> Column:
    """Normalised text of an entry outside the body, if it has a letter; else null."""
    norm = tx.furniture_text(text)
    return F.when((where != "body") & F.rlike(norm, F.lit(r"\p{L}")), norm)


def prefix(text: Column, where: Column) -> Column:
    """First tokens of a longer entry outside the body; else null."""
    tokens = F.split(tx.furniture_text(text), " ")
    head = F.array_join(F.slice(tokens, 1, PREFIX_TOKENS), " ")
    return F.when((where != "body") & (F.size(tokens) > PREFIX_TOKENS) & (F.length(head) >= PREFIX_CHARS) & F.rlike(head, F.lit(r"\p{L}")), head)


def _threshold(pages: Column) -> Column:
    return F.when(pages < 2, F.lit(None)).when(pages >= SHORT_RUN, MIN_PAGES).otherwise(F.greatest(F.lit(2), F.ceil(pages * SHORT_SHARE)))


def repeated(entries: DataFrame, pages: DataFrame, key: Column) -> DataFrame:
    """(doc, key, band, pages) seen on enough pages of the document.  `pages`: doc, page of every page.

    Distinct (doc, key, band, page) first, so a line that fills every page still aggregates partially on the map side."""
    total = pages.groupBy("doc").agg(F.countDistinct("page").alias("total"))
    seen = entries.select("doc", "page", "band", key.alias("key")).where("key is not null").distinct().groupBy("doc", "key", "band").agg(F.count("*").alias("pages"))
    return seen.join(total, "doc").where(F.col("pages") >= _threshold(F.col("total"))).select("doc", "key", "band", "pages")


def signatures(entries: DataFrame, pages: DataFrame) -> DataFrame:
    return repeated(entries, pages, signature(F.col("text"), F.col("band")))


def prefixes(entries: DataFrame, pages: DataFrame) -> DataFrame:
    return repeated(entries, pages, prefix(F.col("text"), F.col("band")))


def split_furniture(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """All entries with `furniture`: a repeated signature, a repeated prefix, or a chapter tab at the right edge."""
    e = entries.withColumn("sig", signature(F.col("text"), F.col("band"))).withColumn("pre", prefix(F.col("text"), F.col("band")))
    sigs = signatures(entries, pages).select("doc", F.col("key").alias("sig"), "band", F.lit(True).alias("by_sig"))
    pres = prefixes(entries, pages).select("doc", F.col("key").alias("pre"), "band", F.lit(True).alias("by_pre"))
    met = e.join(sigs, ["doc", "sig", "band"], "left").join(pres, ["doc", "pre", "band"], "left")
    tab = (F.col("band") == "right") & tx.is_chapter_tab_text(F.col("text"))
    flag = F.coalesce("by_sig", F.lit(False)) | F.coalesce("by_pre", F.lit(False)) | tab
    return met.withColumn("furniture", flag).withColumn("tab", tab & F.col("by_sig").isNull() & F.col("by_pre").isNull()).drop("sig", "pre", "by_sig", "by_pre")


def strip_texts(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, page, norm) safe to strip from a page by text alone: furniture there, and no other entry of the page."""
    flagged = split_furniture(entries, pages).withColumn("norm", tx.furniture_text(F.col("text"))).where("norm != '' and not tab")
    return flagged.groupBy("doc", "page", "norm").agg(F.min("furniture").alias("all_furniture")).where("all_furniture").drop("all_furniture")


def strip_lines(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines (doc, page, pos, line) without those that equal a furniture text of their page, alone or with up to three that
    follow; pipe lines never match."""
    from .lines import page

    plain = F.when(tx.is_pipe_line(F.col("line")), None).otherwise(F.nullif(tx.furniture_text(F.regexp_replace(tx.strip(F.col("line")), r"^#{1,6}\s+", "")), F.lit("")))
    full = lines.where(tx.strip(F.col("line")) != "").withColumn("norm", plain)
    order = page("doc", "page")
    full = full.select("doc", "page", *[F.lead("norm", i).over(order).alias(f"n{i}") for i in range(4)], F.array(*[F.lead("pos", i).over(order) for i in range(4)]).alias("at"))
    names = [f"n{i}" for i in range(4)]
    joined = [F.when(_all_there([F.col(c) for c in names[: n + 1]]), F.concat_ws(" ", *names[: n + 1])) for n in range(4)]
    spans = full.select("doc", "page", "at", F.posexplode(F.array(*joined)).alias("more", "norm"))
    hit = spans.join(texts, ["doc", "page", "norm"], "left_semi").select("doc", "page", F.explode(F.slice("at", F.lit(1), F.col("more") + 1)).alias("pos")).distinct()
    return lines.join(hit, ["doc", "page", "pos"], "left_anti")


def _all_there(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c.isNotNull()
    return out
