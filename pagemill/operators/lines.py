"""Texts as tables of lines, and back; islands of neighbouring lines.

The line table (keys..., pos, line) is the working form of all operators that look at neighbours: position is an
explicit column, so order survives shuffles, and windows are partitioned by page.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.bind import bind

PICTURE = r"^!\[[^\]]*\]\([^)]*\)\z"


def to_lines(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row a line, pos from 0.  A final line break opens no further line; a null or empty text has no lines."""
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r?\n\z", "")
    lines = F.when(body != "", F.split(body, r"\r?\n", -1)).otherwise(F.array().cast("array<string>"))
    return df.select(*keys, F.posexplode(lines).alias("pos", "line"))


def from_lines(lines: DataFrame, *keys: str, name: str = "text") -> DataFrame:
    """Lines joined in order of pos."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias(name))


def page(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("pos")


def island(member: Column, *keys: str) -> Column:
    """Number of the island of consecutive member rows that a row belongs to; null for others."""
    breaks = F.sum(F.when(member, 0).otherwise(1)).over(page(*keys))
    return F.when(member, breaks)


def pipe_blocks(lines: DataFrame, *keys: str) -> DataFrame:
    """Spans [start, stop) of consecutive pipe lines, with their cells (rules left out), lower-cased and collapsed."""
    marked = lines.withColumn("block", island(tx.is_pipe_line(F.col("line")), *keys)).where("block is not null")
    rule = F.rlike(tx.strip(F.col("line")), F.lit(r"^[|\-: ]+\z"))
    cells = F.transform(tx.split_row(F.col("line")), lambda c: F.lower(tx.collapse_ws(c)))
    rows = F.array_sort(F.collect_list(F.when(~rule, F.struct(F.col("pos"), cells.alias("cells")))))
    return marked.groupBy(*keys, "block").agg(
        F.min("pos").alias("start"), (F.max("pos") + 1).alias("stop"), F.transform(rows, lambda r: r["cells"]).alias("rows")
    ).drop("block")


def blocks(lines: DataFrame, *keys: str) -> DataFrame:
    """Blocks of lines between blank lines: block number from 0, first pos, lines, norm and kind."""
    full = tx.strip(F.col("line")) != ""
    marked = lines.withColumn("island", island(full, *keys)).where("island is not null")
    held = marked.groupBy(*keys, "island").agg(F.min("pos").alias("pos"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("lines"))
    first = F.get("lines", F.lit(0))
    image = F.forall("lines", lambda x: F.rlike(tx.strip(x), F.lit(tx.IMAGE_LINE)) | F.startswith(tx.strip(x), F.lit("**Image summary:**")))
    kind = (
        F.when(F.startswith(F.ltrim(first), F.lit("|")), "table")
        .when((F.size("lines") == 1) & F.rlike(first, F.lit(tx.HEADING)), "heading")
        .when(image, "image")
        .otherwise("text")
    )
    numbered = held.withColumn("norm", tx.block_norm(F.array_join("lines", " "))).withColumn("kind", kind)
    return numbered.withColumn("block", F.row_number().over(page(*keys)) - 1).drop("island")


def repeated_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """How far each page repeats its lines of over 20 characters: total, repeated_ratio, anomalous.

    Rules of pipe tables, and the header above one, are structure and don't count.  Partial aggregation by
    (page, line) comes first, so a page of one line repeated a million times is one row before the second step."""
    t = tx.strip(F.col("line"))
    rule = F.rlike(t, F.lit(r"^\|?[\s|:-]+\|?\z"))
    marked = lines.select(*keys, "pos", t.alias("line"), rule.alias("rule")).withColumn("under", F.lead("rule", 1, False).over(page(*keys)))
    kept = marked.where(~F.col("rule") & ~(F.col("under") & F.startswith("line", F.lit("|"))) & (F.length("line") > 20))
    counts = kept.groupBy(*keys, "line").agg(F.count("*").alias("n"))
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.max("n").alias("most"))
    ratio = 1 - F.col("distinct") / F.col("total")
    return sums.select(*keys, "total", F.round(ratio, 3).alias("repeated_ratio"), (((F.col("total") >= 8) & (ratio > 0.5)) | (F.col("most") >= 5)).alias("anomalous"))


def duplicate_paragraphs(blocked: DataFrame, *keys: str) -> DataFrame:
    """Further occurrences of text blocks of 80 characters or more, for each page that has such blocks."""
    counts = blocked.where((F.col("kind") == "text") & (F.length("norm") >= 80)).groupBy(*keys, "norm").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("duplicates"))


def collapse_duplicates(blocked: DataFrame, *keys: str) -> DataFrame:
    """Blocks that stay when later copies of eligible paragraphs go (80 characters or 15 words): equal to an earlier one, or a
    suffix (80 characters or more) of one.

    Equal copies fall to a window.  A suffix must share its last 80 characters with the paragraph that it ends, so
    suffixes are found by an equi-join on those instead of comparing all pairs."""
    norm = F.col("norm")
    eligible = (F.col("kind") == "text") & ((F.length("norm") >= 80) | (F.size(F.split("norm", " ")) >= 15))
    ranked = blocked.withColumn("eligible", eligible).withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "norm", "eligible").orderBy("pos")))
    first = ranked.where("eligible and nth = 1").where(F.length("norm") >= 80).withColumn("tail", F.substring(norm, -80, 80))
    late, early = first.alias("late"), first.select(*keys, "tail", F.col("pos").alias("early_pos"), F.col("norm").alias("early_norm")).alias("early")
    suffix = late.join(early, [*keys, "tail"]).where("early_pos < pos").where(F.endswith(F.col("early_norm"), F.col("late.norm")) & (F.col("early_norm") != F.col("late.norm")))
    gone = suffix.select(*keys, "pos").distinct()
    return ranked.where("not (eligible and nth > 1)").join(gone, [*keys, "pos"], "left_anti").drop("nth", "eligible")


def body_windows(lines: DataFrame, *keys: str, window: int = 3) -> DataFrame:
    """For each line that is not blank: distinct significant words and numeric tokens of it and the next ones."""
    full = lines.where(tx.strip(F.col("line")) != "")
    near = page(*keys).rowsBetween(0, window - 1)
    out = full.withColumn("w", tx.significant_words(tx.strip(F.col("line")))).withColumn("n", tx.numeric_tokens(F.col("line")))
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c).over(near)))
    return out.select(*keys, "pos", union("w").alias("words"), union("n").alias("numbers"))


def _content(line: Column) -> Column:
    """A stripped line without marks of lists, headings, quotes and tables."""
    t = F.regexp_replace(line, r"^[#>\-*|\s]+", "")
    return F.regexp_replace(tx.strip(F.replace(t, F.lit("|"), F.lit(" "))), r"^-{2,}\z", "")


def content_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines with content: three significant words or more, or a standalone value."""
    t = _content(tx.strip(F.col("line")))
    kept = lines.where(~F.rlike(tx.strip(F.col("line")), F.lit(PICTURE))).withColumn("line", t).where("line != ''")
    return kept.where((F.size(tx.significant_words(F.col("line"))) >= 3) | tx.is_short_value(F.col("line")))


def _wanted(lines: Column) -> Column:
    """The content lines of a page that have significant words: pos, line, sig and nums.  Each step is an array of its own, so that no
    pattern runs twice over a line."""
    bare = F.transform(lines, lambda x: F.struct(x["pos"].alias("pos"), tx.strip(x["line"]).alias("line")))
    named = F.filter(F.transform(F.filter(bare, lambda x: ~F.rlike(x["line"], F.lit(PICTURE))), lambda x: F.struct(x["pos"].alias("pos"), _content(x["line"]).alias("line"))), lambda x: x["line"] != "")
    worded = F.transform(named, lambda x: F.struct(x["pos"].alias("pos"), x["line"].alias("line"), tx.significant_words(x["line"]).alias("words")))
    kept = F.filter(worded, lambda x: (F.size(x["words"]) >= 3) | ((F.size(x["words"]) > 0) & tx.is_short_value(x["line"])))
    return F.transform(kept, lambda x: F.struct(x["pos"].alias("pos"), x["line"].alias("line"), F.array_distinct(x["words"]).alias("sig"), tx.numeric_tokens(x["line"]).alias("nums")))


def _held(lines: Column) -> Column:
    """Significant words and numeric tokens of the lines of a page that are not blank."""
    full = F.filter(F.transform(lines, lambda x: tx.strip(x["line"])), lambda t: t != "")
    return F.transform(full, lambda t: F.struct(tx.significant_words(t).alias("words"), tx.numeric_tokens(t).alias("numbers")))


def _bits(words: Column) -> Column:
    """256 bits as four longs; each word sets one."""
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))
    part = lambda ats, q: F.aggregate(F.filter(ats, lambda at: F.floor(at / 64) == q), F.lit(0).cast("long"), lambda bits, at: bits.bitwiseOR(one(at % 64)))
    return bind(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(256))), lambda ats: F.array(*[part(ats, q) for q in range(4)]))


def _windows(held: Column, window: int = 3) -> Column:
    """Distinct words and numbers of each line and the next ones, and bits of the words."""
    union = lambda i, name: F.array_distinct(F.flatten(F.transform(F.slice(held, i + 1, window), lambda x: x[name])))
    each = F.transform(held, lambda _, i: F.struct(union(i, "words").alias("words"), union(i, "numbers").alias("numbers")))
    return F.transform(each, lambda w: F.struct(w["words"].alias("words"), w["numbers"].alias("numbers"), _bits(w["words"]).alias("bits")))


def missing_lines(source: DataFrame, body: DataFrame, *keys: str, threshold: float = 0.6) -> DataFrame:
    """Content lines of `source` that `body` (line tables of the same pages) lacks.

    A line is there if one window of three body lines holds the threshold of its words and, if it has numbers, one of
    them, or if its first 80 characters occur in the body.  Lines travel once, as they are, to their page; words are made and compared
    there, as a row for each word and window is many times the text.  A line that is not there literally looks into the windows only
    if the whole page holds enough of its words, and compares words only where bits allow it: a window without a bit lacks a word."""
    both = source.select(*keys, F.struct("pos", "line").alias("of"), F.lit(True).alias("wanted"))
    known = body.dropna(subset=list(keys))  # a page without a key has no body
    both = both.unionByName(known.select(*keys, F.struct("pos", "line").alias("of"), F.lit(False).alias("wanted")))
    side = lambda mine: F.sort_array(F.collect_list(F.when(mine, F.col("of"))))
    pages = both.groupBy(*keys).agg(side(F.col("wanted")).alias("source"), side(~F.col("wanted")).alias("body"))
    enough = lambda x, words: F.size(F.array_intersect(words, x["sig"])) >= F.size(x["sig"]) * threshold
    numbered = lambda x, w: (F.size(x["nums"]) == 0) | F.arrays_overlap(x["nums"], w["numbers"])

    def reworded(left: Column, held: Column) -> Column:
        shared = F.array_intersect(F.flatten(F.transform(held, lambda w: w["words"])), F.flatten(F.transform(left, lambda x: x["sig"])))
        near = bind(shared, lambda words: F.transform(left, lambda x: enough(x, words)))
        lacks = lambda bits, w: reduce(add, [F.bit_count(bits[q].bitwiseAND(F.bitwise_not(w["bits"][q]))) for q in range(4)])
        spare = lambda x: F.size(x["sig"]) - F.size(x["sig"]) * threshold
        held_by = lambda x, bits, most: lambda w: (lacks(bits, w) <= most) & numbered(x, w) & enough(x, w["words"])
        seen = lambda x, windows: bind(_bits(x["sig"]), lambda bits: bind(spare(x), lambda most: F.exists(windows, held_by(x, bits, most))))
        seek = lambda at, windows: F.filter(left, lambda x, i: ~(F.get(at, i) & seen(x, windows)))
        return bind(near, lambda at: F.when(F.exists(at, lambda a: a), bind(_windows(held), lambda windows: seek(at, windows))).otherwise(left))

    def lost(wanted: Column) -> Column:
        whole = F.lower(F.array_join(F.transform("body", lambda x: x["line"]), "\n"))
        literal = lambda x, text: F.contains(text, F.substring(F.lower(x["line"]), 1, 80))
        left = bind(whole, lambda text: F.filter(wanted, lambda x: ~literal(x, text)))
        return bind(left, lambda some: F.when(F.size(some) > 0, bind(_held(F.col("body")), lambda held: reworded(some, held))))

    found = pages.select(*keys, F.explode_outer(bind(_wanted(F.col("source")), lost)).alias("x"))  # outer: a filter for empty lists would do all the work twice
    return found.where("x is not null").select(*keys, "x.pos", "x.line")


def heading_levels(lines: DataFrame, *keys: str) -> DataFrame:
    found = lines.withColumn("level", F.length(F.regexp_extract("line", tx.HEADING, 1))).where("level > 0")
    return found.groupBy(*keys).agg(F.array_sort(F.collect_set("level")).alias("levels"))


def footnotes(lines: DataFrame, *keys: str) -> DataFrame:
    """Labels of definitions and references of each page: duplicate definitions, references without one, gaps."""
    plain = F.translate("line", "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789")
    label = F.regexp_extract(plain, tx.FOOTNOTE_DEF, 1)
    rows = lines.select(*keys, label.alias("defined"), F.when(label == "", F.regexp_extract_all(plain, F.lit(r"\[(\d{1,3})\]"), F.lit(1))).alias("refs"))
    defs = rows.where("defined != ''").groupBy(*keys, "defined").agg(F.count("*").alias("n"))
    defs = defs.groupBy(*keys).agg(F.array_sort(F.collect_set("defined")).alias("defs"), F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("defined")))).alias("duplicates"))
    refs = rows.select(*keys, F.explode("refs").alias("ref")).groupBy(*keys).agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    both = defs.join(refs, list(keys), "full")
    none = F.array().cast("array<string>")
    both = both.select(*keys, *[F.coalesce(c, none).alias(c) for c in ("refs", "defs", "duplicates")])
    numbers = F.array_sort(F.transform("defs", lambda x: x.cast("int")))
    gaps = F.when(F.size("defs") > 0, F.array_except(F.sequence(F.array_min(numbers), F.array_max(numbers)), numbers)).otherwise(F.array().cast("array<int>"))
    return both.withColumn("undefined", F.array_sort(F.array_except("refs", "defs"))).withColumn("gaps", gaps)


def toc_pages(lines: DataFrame, *keys: str) -> DataFrame:
    """Is a page a table of contents?  Rows that end in a page number, and lines with leaders, are numbered; it is one with 8
    of them and a Contents heading, or 15, or four fifths of the table rows."""
    t = tx.strip(F.col("line"))
    table = F.startswith(t, F.lit("|")) & ~F.rlike(t, F.lit(r"^[|\-: ]+\z"))
    cells = F.filter(tx.split_row(F.col("line")), lambda c: c != "")
    is_number = lambda c: F.rlike(c, F.lit(tx.PAGE_NUMBER))
    row = table & (F.size(cells) >= 2) & is_number(F.try_element_at(cells, F.lit(-1))) & F.exists(F.slice(cells, F.lit(1), F.greatest(F.lit(0), F.size(cells) - 1)), lambda c: ~is_number(c))
    contents = F.rlike(t, F.lit(tx.CONTENTS))
    flags = lines.select(*keys, contents.alias("contents"), (table & ~contents).alias("row"), F.when(contents, False).when(table, row).otherwise(F.rlike(t, F.lit(tx.LEADER_LINE))).alias("numbered"))
    sums = flags.groupBy(*keys).agg(F.count_if("numbered").alias("numbered"), F.count_if("row").alias("table_rows"), F.max("contents").alias("contents"))
    enough = F.col("contents") | (F.col("numbered") >= 15) | ((F.col("table_rows") > 0) & (F.col("numbered") >= 0.8 * F.col("table_rows")))
    return sums.withColumn("toc", (F.col("numbered") >= 8) & enough)


def toc_sections(lines: DataFrame, *keys: str) -> DataFrame:
    """(page, title, number): section numbers of a contents table by normalised title; the first occurrence wins."""
    cells = lines.where(F.startswith(tx.strip(F.col("line")), F.lit("|"))).withColumn("cells", tx.split_row(F.col("line")))
    at = cells.select(*keys, "pos", "cells", F.posexplode("cells").alias("at", "cell"))
    later = F.filter(F.slice("cells", F.col("at") + 2, F.size("cells")), lambda c: (c != "") & ~F.rlike(c, F.lit(tx.PAGE_NUMBER)))
    apart = F.rlike("cell", F.lit(tx.SECTION_NUMBER))
    inline = r"^(\d+(?:\.\d+)+)\s+(\S.*)$"
    found = at.select(
        *keys, "pos", "at",
        F.when(apart, F.col("cell")).otherwise(F.regexp_extract("cell", inline, 1)).alias("number"),
        F.lower(tx.collapse_ws(F.when(apart, F.get(later, F.lit(0))).otherwise(F.regexp_extract("cell", inline, 2)))).alias("title"),
    ).where("number != '' and title != ''")
    first = Window.partitionBy(*keys, "title").orderBy("pos", "at")
    return found.withColumn("n", F.row_number().over(first)).where("n = 1").select(*keys, "title", "number")


def restore_toc_numbers(lines: DataFrame, raw: DataFrame, *keys: str) -> DataFrame:
    """Ordered items become plain ones, under the section number that the raw contents table gives their title."""
    indent, title = F.regexp_extract("line", tx.ORDERED_ITEM, 1), tx.strip(F.regexp_extract("line", tx.ORDERED_ITEM, 3))
    item = lines.withColumn("item", F.rlike("line", F.lit(tx.ORDERED_ITEM))).withColumn("title", F.when(F.col("item"), F.lower(tx.collapse_ws(title))))
    met = item.join(toc_sections(raw, *keys), [*keys, "title"], "left")
    new = F.concat(indent, F.lit("- "), F.when(F.col("number").isNotNull(), F.concat("number", F.lit(" "))).otherwise(""), title)
    return met.select(*keys, "pos", F.when(F.col("item"), new).otherwise(F.col("line")).alias("line"))
