"""Personal data by bootstrapped contextual extraction.

Seeds are the spans of four kinds that exact expressions and checks find (email, ip, card, phone), and long hexadecimal
runs as secrets.  Each of them, and each other token that looks like an identifier (it holds a digit or an @), is an
instance; the word before it together with the marks between them is its pattern.  The graph of patterns and instances is
scored in rounds until the scores stand: a pattern's confidence for a kind is the share of its occurrences whose instance is
believed to be of that kind (less certain for rare patterns), an unseen instance is believed as far as its best pattern.
Occurrences of patterns that end with a confidence of SURE or more, and at least SUPPORT different seeds behind them,
are added as spans of that kind; so are the secrets themselves.

All of it is DataFrame operations.  Positions come from splitting a text by the expression that also extracts its
matches: the lengths of parts and matches, in turn, add up to code points.  Running values go through arrays in chunks,
so the work follows the number of matches.  Expressions are written so that the JVM neither recurses nor rescans a run:
possessive repeats, and a start only at the start of a run or where the last match ended; neither changes what
matches, since what follows a repeat is never in its class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize

#: Kinds of base spans, and all kinds, in the order of spans.
KINDS, SECRET = ("email", "ip", "card", "phone"), "secret"
ALL = (*KINDS, SECRET)
#: Confidence and different seeds that a pattern needs, change of a confidence that counts, rounds after which that is an error,
#: occurrences added to the denominator of a confidence.
SURE, SUPPORT, SETTLED, ROUNDS, DOUBT = 0.8, 5, 1e-3, 50, 1.0
CHUNK = 256  #: matches that a fold holds at once

#: The expressions of the kinds, in the form described above.
_LOCAL, _ID = "A-Za-z0-9._%+-", "A-Za-z0-9@._%+-"
EXPRESSIONS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9])",
}
#: A token that may be an identifier: a run with a digit or @ in it, from its start to its last letter or digit.
CANDIDATE = rf"(?<![{_ID}])(?=[A-Za-z._%+-]*+[0-9@])[{_ID}]*[A-Za-z0-9]"
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
_MATCH = "struct<start:bigint,end:bigint,value:string,gap:string>"
_INSTANCE = "struct<start:bigint,k:int,end:bigint,kind:string,value:string,pattern:string>"


def scan(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str) -> Column:
    """An array of what `step` makes of each item: from a running state and the item to the next state and a value of type
    `out`.  Values gather in chunks, so nothing long is copied for each of them."""

    def one(a: Column, x: Column) -> Column:
        after, value = step(a["s"], x)
        return F.struct(after.alias("s"), F.concat(a["out"], F.array(value)).alias("out"))

    def many(acc: Column, chunk: Column) -> Column:
        start = F.struct(acc["s"].alias("s"), F.array().cast(f"array<{out}>").alias("out"))
        return F.aggregate(chunk, start, one, lambda a: F.struct(a["s"].alias("s"), F.concat(acc["done"], F.array(a["out"])).alias("done")))

    def run(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")))
        zero = F.struct(state.alias("s"), F.array().cast(f"array<array<{out}>>").alias("done"))
        return F.aggregate(F.transform(starts, lambda c: F.slice(found, c * CHUNK + 1, F.lit(CHUNK))), zero, many, lambda acc: F.flatten(acc["done"]))

    return F.get(F.transform(F.array(items), run), F.lit(0))  # bound once: what makes the items is not run again for each chunk


def matches(text: Column, expression: str) -> Column:
    """All matches, leftmost and not overlapping, as array of (start, end, value) in code points, with the text in `gap` that lies
    between the match and the one before."""
    found, between = F.regexp_extract_all(text, F.lit(f"({expression})"), F.lit(1)), F.split(text, expression, -1)
    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        return end.cast("bigint"), F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), pair["value"].alias("value"), pair["gap"].alias("gap"))

    return F.when(F.regexp_like(text, F.lit(expression)), scan(pairs, F.lit(0).cast("bigint"), step, _MATCH)).otherwise(F.array().cast(f"array<{_MATCH}>"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def digit(i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), digit), F.lit(0), lambda a, x: a + x) % 10 == 0


def _pattern(gap: Column) -> Column:
    """The word before a match, lower-cased, and the marks between; null without a word that near."""
    parts = F.regexp_extract(gap, r"(?<!\p{L})(\p{L}++[^\p{L}\p{N}]{1,4})\z", 1)
    return F.nullif(F.lower(F.regexp_replace(parts, r"\s+", " ")), F.lit(""))


def _instance(x: Column, k: int, kind: Column) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), kind.alias("kind"), x["value"].alias("value"), _pattern(x["gap"]).alias("pattern"))


def spans_of(text: Column, kind: str) -> Column:
    """Spans of a kind that pass its check, in order."""
    digits = lambda x: F.regexp_replace(x["value"], "[^0-9]", "")
    checks = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.rlike(x["value"], F.lit(rf"^{_OCTET}(?:\.(?=[0-9]){_OCTET}){{3}}$")),
        "card": lambda x: F.length(digits(x)).between(13, 19) & F.when(F.length(digits(x)).between(13, 19), luhn(digits(x))).otherwise(False),
        "phone": lambda x: F.length(digits(x)).between(9, 15),
        "secret": lambda x: F.rlike(x["value"], F.lit("[0-9]")) & F.rlike(x["value"], F.lit("[A-Fa-f]")),
    }
    hints = {"email": "@", "ip": ".", "card": "", "phone": "+", "secret": ""}
    found = F.filter(matches(text, EXPRESSIONS[kind]), checks[kind])
    named = F.transform(found, lambda x: _instance(x, ALL.index(kind), F.lit(kind)))
    return F.when(F.contains(text, F.lit(hints[kind])), named).otherwise(F.array().cast(f"array<{_INSTANCE}>"))


def _apart(spans: Column, candidates: Column) -> Column:
    """Candidates that overlap no span.  In order of their starts, an earlier span overlaps a candidate if the furthest end so far
    lies behind its start, a later one if the next start lies before its end: a scan each way."""
    merged = F.array_sort(F.concat(spans, candidates))
    is_span = lambda x: x["kind"].isNotNull()

    def forth(end: Column, x: Column) -> tuple[Column, Column]:
        return F.when(is_span(x), F.greatest(end, x["end"])).otherwise(end), F.struct(x.alias("x"), (x["start"] < end).alias("hit"))

    def back(start: Column, y: Column) -> tuple[Column, Column]:
        x = y["x"]
        hit = F.struct(x.alias("x"), (y["hit"] | (start < x["end"])).alias("hit"))
        return F.when(is_span(x), x["start"]).otherwise(start), hit

    kind = f"struct<x:{_INSTANCE},hit:boolean>"
    first = scan(merged, F.lit(-1).cast("bigint"), forth, kind)
    both = scan(F.reverse(first), F.lit(2**62).cast("bigint"), back, kind)
    return F.transform(F.filter(both, lambda y: ~y["hit"] & ~is_span(y["x"])), lambda y: y["x"])


def sure_patterns(instances: DataFrame) -> DataFrame:
    """(pattern, found) with a high confidence once the scores of the pattern-instance graph stand."""
    seen = instances.where("pattern is not null")
    edges = materialize(seen.groupBy("pattern", F.lower("value").alias("value")).agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "pii-edges")
    whole = edges.groupBy("pattern").agg(F.sum("n").alias("all"))
    seeds = edges.where("kind is not null").select("value", "kind", F.lit(1.0).alias("p")).distinct()
    support = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    belief, before = seeds, None
    for _ in range(ROUNDS):
        weight = edges.select("pattern", "value", "n").join(belief, "value").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("p")).alias("w"))
        scored = materialize(weight.join(whole, "pattern").select("pattern", "kind", (F.col("w") / (F.col("all") + DOUBT)).alias("p")), "pii-patterns")
        if before is not None:
            both = scored.join(before.withColumnRenamed("p", "was"), ["pattern", "kind"], "full")
            if (both.agg(F.max(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))).first()[0] or 0.0) < SETTLED:
                break
        before = scored
        unseen = edges.where("kind is null").select("pattern", "value").join(scored.where("p >= 0.5"), "pattern").groupBy("value", "kind").agg(F.max("p").alias("p"))
        belief = seeds.unionByName(unseen.join(seeds.select("value").distinct(), "value", "left_anti"))
    else:
        raise RuntimeError(f"pattern scores did not settle in {ROUNDS} rounds")
    best = scored.join(support, ["pattern", "kind"]).where((F.col("p") >= SURE) & (F.col("seeds") >= SUPPORT))
    return best.groupBy("pattern").agg(F.max_by("kind", F.struct("p", "kind")).alias("found"))


def find(docs: DataFrame, *, keep: bool = False) -> DataFrame:
    """Rows with doc_id, base (their base spans), added (the spans that the method adds, by kind, then start; empty
    where it adds none) and, if asked for, all their own columns in a struct `kept`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *kept).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("base", F.concat(*[spans_of(F.col("text"), k) for k in KINDS])).withColumn("secret", spans_of(F.col("text"), SECRET))
    none = F.lit(None).cast("string")
    candidates = F.transform(matches(F.col("text"), CANDIDATE), lambda x: _instance(x, len(ALL), none))
    rows = rows.withColumn("seeds", F.concat("base", "secret")).withColumn("candidates", candidates)
    loose = F.when(F.size("seeds") > 0, _apart(F.col("seeds"), F.col("candidates"))).otherwise(F.col("candidates"))
    # the written table keeps the numbers of the rows
    found = materialize(rows.select("row", "doc_id", *["kept"] * keep, "base", "secret", F.concat("seeds", loose).alias("instances")), "pii-found")
    instances = found.select("row", F.explode("instances").alias("x")).select("row", "x.*")
    sure = instances.where("kind is null and pattern is not null").join(sure_patterns(instances), "pattern")
    order = (F.array_position(F.array(*map(F.lit, ALL)), F.col("found")) - 1).cast("int")
    span = F.struct(order.alias("k"), "start", "end", F.col("found").alias("kind"))
    added = materialize(sure.groupBy("row").agg(F.collect_set(span).alias("learned")), "pii-added")
    known = F.transform("secret", lambda x: F.struct(x["k"].alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    more = F.coalesce("learned", F.array().cast("array<struct<k:int,start:bigint,end:bigint,kind:string>>"))
    return found.join(added, "row", "left").select("doc_id", *["kept"] * keep, "base", F.array_sort(F.concat(known, more)).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _all_spans() -> Column:
    """Base and added spans as (k, start, end, kind)."""
    return F.concat(F.transform("base", lambda x: F.struct(x["k"].alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))), F.col("added"))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data of every document.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (base and added, by kind, then start) and private
    (whether there is any).  The counts and the digest are those of base spans.  A null text is an empty one; a null id
    stays null; repeated rows come back as often; other columns are ignored; an empty table stays empty.
    """
    counts = [_count(k) for k in KINDS]
    spans = F.array_sort(_all_spans())
    return find(docs).select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(spans).alias("spans"), (F.size("base") + F.size("added") > 0).alias("private"))


def op8_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data(documents(spark, sf_dir))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first.  A chunk of
    spans cuts its own piece of the text, so positions are counted from near."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        # a span inside what is covered goes; one that reaches further only covers more: both show as an end
        return F.greatest(at, x["end"]), F.struct(x["start"].alias("start"), F.greatest(at, x["end"]).alias("end"), F.when(x["start"] >= at, x["kind"]).alias("kind"))

    ends = scan(F.array_sort(spans), F.lit(0).cast("bigint"), step, "struct<start:bigint,end:bigint,kind:string>")

    def chunk_text(chunk: Column, at: Column) -> Column:
        piece = F.substring(text, (at + 1).cast("int"), (F.element_at(chunk, -1)["end"] - at).cast("int"))

        def one(p: Column) -> Column:
            def clear(x: Column, i: Column) -> Column:
                last = F.when(i == 0, at).otherwise(F.get(chunk, i - 1)["end"])
                gap = F.substring(p, (last - at + 1).cast("int"), (x["start"] - last).cast("int"))
                return F.when(x["kind"].isNull(), F.lit("")).otherwise(F.concat(gap, F.lit("["), F.upper(x["kind"]), F.lit("]")))

            return F.array_join(F.transform(chunk, clear), "")

        return F.get(F.transform(F.array(piece), one), F.lit(0))

    def whole(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int"))
        at = lambda c: F.when(c == 0, F.lit(0).cast("bigint")).otherwise(F.get(found, c * CHUNK - 1)["end"])
        parts = F.transform(starts, lambda c: chunk_text(F.slice(found, c * CHUNK + 1, F.lit(CHUNK)), at(c)))
        return F.concat(F.array_join(parts, ""), F.substring(text, (F.element_at(found, -1)["end"] + 1).cast("int"), F.length(text)))

    return F.get(F.transform(F.array(ends), whole), F.lit(0))


def stage_pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span becomes its kind in brackets (overlapping spans become one, named by the first); n_chars follows.  Rows without
    a span, null texts among them, stay as they are; repeated rows, extra columns and empty tables as in `personal_data`."""
    rows = find(docs, keep=True).withColumn("n", F.size("base") + F.size("added"))
    spans = F.transform(_all_spans(), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    rows = rows.withColumn("masked", F.when(F.col("n") > 0, masked(F.col("kept.text"), spans)))
    new = {"text": F.coalesce("masked", "kept.text"), "n_chars": F.when(F.col("masked").isNotNull(), F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("kept.n_chars"))}
    return rows.select(*[new.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns])
