"""SimHash near-duplicates by tiled exact comparison.

Fingerprints of 64 bits are compared exactly: numpy exclusive-or and bit counts over tiles of rows, where a pair
of tiles is skipped when its population counts differ by more than the radius.  To keep this from comparing every
tile with every other, rows are first dealt into buckets: of radius + m bands of bits, two fingerprints within the
radius agree on m bands at least, so comparing inside buckets of every choice of m bands loses no link.  m is the
smallest number for which a bucket is expected to hold no more than BASE fingerprints; it changes the work, never the
links.  Only distinct fingerprints are compared (a group of exact copies is one row), a bucket above BASE rows is
split by its base rows over tasks, and a task reports a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, discard, documents, materialize

#: Rows of a tile, base rows of a task in a large bucket, and rows compared at once in a partition.
TILE, BASE, BUFFER = 1024, 8192, 65536

#: The stage of the pipeline: words of a shingle, least similarity (as a fraction), differing bits of fingerprints that make a candidate
#: at once, sets sampled for the order of shingles, how many of them make a shingle common, base rows of a task, rows of a batch.
SHINGLE, SIMILAR, RADIUS, SAMPLE, OFTEN, BASE_SETS, SET_BATCH = 5, (4, 5), 3, 4096, 8, 256, 500


def fingerprint(text: str | None, *, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of word shingles, repeats counted; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, n)
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[shingle - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, n - shingle + 1
    starts = starts[:total].tolist()
    spans = (slice(at, at + TILE * 16) for at in range(0, total, TILE * 16))
    return majority((np.array([digest(joined[a:b], seed) for a, b in zip(starts[x], ends[x], strict=True)], dtype="<u8") for x in spans), total)


def majority(hashes: Iterable[np.ndarray], total: int) -> int:
    """SimHash of `total` hashes that come in blocks: bits set in more than half of them."""
    counts = np.zeros(64, np.int64)
    for block in hashes:
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


class _Forest:
    """Union-find over row numbers, by arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while (up := self.parent[found]).tobytes() != found.tobytes():
            found = up
        return found

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def forest_of(group: np.ndarray, prints: np.ndarray, base: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside groups.  Rows are sorted by group, then population count; of a linked
    pair one row at least must be a base row.  Tiles of base rows meet the tiles of rows, base and other apart, whose
    population counts come within the radius of theirs: work follows base rows times rows."""
    forest, bits = _Forest(len(prints)), np.bitwise_count(prints).astype(np.int64)
    number = np.cumsum(np.r_[False, group[1:] != group[:-1]][: len(group)])
    place = 128 * number + bits  # rises with the rows; groups are further apart than any radius
    own, other = np.flatnonzero(base), np.flatnonzero(~base)
    for i in range(0, len(own), TILE):
        a = own[i : i + TILE]
        low, high = place[a[0]] - radius, place[a[-1]] + radius
        for rows, start in ((own, i), (other, int(np.searchsorted(place[other], low)))):
            stop = int(np.searchsorted(place[rows], high, "right"))
            for j in range(start, stop, TILE):
                b = rows[j : min(stop, j + TILE)]
                near = np.bitwise_count(prints[a, None] ^ prints[None, b]) <= radius
                near &= number[a, None] == number[None, b]
                x, y = np.nonzero(near)
                once = (a[x] < b[y]) | ~base[b[y]]
                forest.link(a[x][once], b[y][once])
    rows = np.arange(len(prints))
    roots = forest.roots(rows)
    return rows[roots != rows], roots[roots != rows]


def _compare(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)]

        def flush(upto: int):
            group, prints, base = (x[:upto] for x in held)
            child, root = forest_of(group, prints, base, radius)
            held[:] = [x[upto:] for x in held]
            return pa.record_batch([pa.array(prints[child].view(np.int64)), pa.array(prints[root].view(np.int64))], names=["u", "v"])

        for batch in batches:
            new = [batch.column("grp").to_numpy(), batch.column("fp").to_numpy().view(np.uint64), batch.column("base").to_numpy(zero_copy_only=False)]
            held[:] = [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]) >= BUFFER and len(other := np.flatnonzero(held[0] != held[0][-1])):
                yield flush(int(other[-1]) + 1)
        if len(held[0]):
            yield flush(len(held[0]))

    return links


def agreeing_bands(count: int, radius: int, base: int = BASE) -> int:
    """Bands that must agree: the fewest with which `count` evenly spread fingerprints put at most `base` in a bucket (with all
    bits in the bands, a bucket is one fingerprint)."""
    return next((m for m in range(1, 64 - radius) if count <= base * 2 ** (64 * m // (radius + m))), 64 - radius)


def simhash_links(prints: DataFrame, radius: int = 3, agree: int = 1) -> DataFrame:
    """Links (u, v) that connect all fingerprints `fp` (distinct longs) within the radius.  Of radius + `agree` bands, a
    bucket is a choice of `agree` bands and their bits."""
    bands = radius + agree
    cuts = [round(64 * k / bands) for k in range(bands + 1)]
    masks = [sum((1 << cuts[k + 1]) - (1 << cuts[k]) for k in chosen) for chosen in itertools.combinations(range(bands), agree)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    rows = prints.select("fp", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)])).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BASE).cast("int")
    rows = rows.join(sizes, "bucket").withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("fp"), "parts"))
    rows = rows.select("fp", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = rows.select(F.xxhash64("bucket", "part").alias("grp"), "fp", (F.col("own") == F.col("part")).alias("base"), F.bit_count("fp").alias("bits"))
    return rows.repartition("grp").sortWithinPartitions("grp", "bits").select("grp", "fp", "base").mapInArrow(_compare(radius), "u long, v long")


def components(links: DataFrame, *, most: int = 60) -> DataFrame:
    """(node, root) of every linked node: root is the smallest node it reaches.  Alternates large-star and
    small-star steps until the links no longer change; each round is cut by a written table."""

    def summary(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        near = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = near.join(least, "u")
        if both:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = materialize(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = summary(edges)
    for _ in range(most):
        if not before[0]:
            break
        edges = materialize(star(star(edges, True), False), "links")
        if (now := summary(edges)) == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate component of every row.

    Returns doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links of at most
    `radius` differing bits).  Null and wordless texts have fingerprint zero and link like any other.  A null id
    never names a component: component_id is null only where no linked row has an id.  Repeated rows come back as
    often as they came; other columns are ignored; an empty table gives an empty table.
    """
    slim = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), _fingerprints(F.col(text_col).cast("string")).alias("fp")), "simhash")
    return _linked(slim, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _linked(slim: DataFrame, radius: int) -> DataFrame:
    """A written table of doc_id and fp with component_id: the smallest doc_id reachable over links of fingerprints."""
    nodes = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "prints")
    kinds, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    roots = components(simhash_links(nodes.select("fp"), radius, agreeing_bands(kinds, radius)))  # how many bands agree only shifts work
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.select("fp", "root", "n").join(named, "root").select("fp", "component_id", "n")
    return attach(slim, named, "fp", total)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(documents(spark, sf_dir))


def shingle_set(text: str | None, *, shingle: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of word shingles; a shorter text is one shingle, a text without words has none."""
    words = (text or "").encode().lower().split()
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1) if words else 0
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + shingle]), seed) for i in range(n)), np.uint64, n).view(np.int64))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingle_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t) for t in texts], dtype=object)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Bits that a set's hashes touch, twice as many as hashes at least (a power of two), packed."""
    bits = np.zeros(max(64, 1 << (2 * len(found) - 1).bit_length()), bool)
    bits[found & (len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little")


def _marks(common: np.ndarray, weight: np.ndarray):
    """Of a text's set: a hash that names it, its size, its SimHash, its bitmap, and its prefix in the order of weight (0 unless common),
    then hash: all but as many as similar sets must share, and one."""

    @F.pandas_udf("node long, size long, fp long, bits binary, prefix array<long>")
    def marks(texts: pd.Series) -> pd.DataFrame:
        out = []
        for s in map(shingle_set, texts):
            at = np.minimum(np.searchsorted(common, s), len(common) - 1)
            rank = np.where(common[at] == s, weight[at], 0)
            node = int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64))
            fp = majority((s[i : i + TILE * 16] for i in range(0, len(s), TILE * 16)), len(s))
            out.append((node, len(s), int(np.uint64(fp).astype(np.int64)), bitmap(s).tobytes(), s[np.lexsort((s, rank))[: len(s) + 1 + -len(s) * SIMILAR[0] // SIMILAR[1]]]))
        return pd.DataFrame(out, columns=["node", "size", "fp", "bits", "prefix"])

    return marks


def often_shared(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that OFTEN or more of a sample of texts hold, sorted, and how many do."""
    texts = texts.withColumn("h", F.xxhash64("text"))
    rate = max(1, texts.agg(F.approx_count_distinct("h")).first()[0] // SAMPLE)
    some = texts.where(F.pmod("h", F.lit(rate)) == 0).dropDuplicates(["h"]).select(F.explode(_shingle_sets("text")).alias("x"))
    often = some.groupBy("x").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).toPandas().sort_values("x")
    return tuple(often[c].to_numpy(np.int64) if len(often) else np.zeros(1, np.int64) for c in ("x", "n"))


def _forest_by(sizes: np.ndarray, base: np.ndarray, shared) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of which one is a base row and that are similar if `shared(i, rows)` hashes are shared; rows come
    by size.  Pairs that are already connected or differ too much in size are not compared."""
    n, (a, b) = len(sizes), SIMILAR
    forest, rows = _Forest(n), np.arange(n)
    ends = np.searchsorted(sizes, sizes * b // a, side="right")
    for i in range(n):
        near = rows[i + 1 : ends[i]]
        near = near if base[i] else near[base[near]]
        if len(near):
            near = near[forest.roots(near) != forest.roots(rows[i : i + 1])]
        for k in range(0, len(near), TILE):
            some = near[k : k + TILE]
            some = some[(a + b) * shared(i, some) >= a * (sizes[i] + sizes[some])]
            forest.link(np.full(len(some), i), some)
    roots = forest.roots(rows)
    return rows[roots != rows], roots[roots != rows]


def similar_in(sets: list[np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The forest of similar sets."""
    sizes = np.array([len(s) for s in sets], np.int64)

    def shared(i: int, some: np.ndarray) -> np.ndarray:
        values = np.concatenate([sets[j] for j in some])
        at = np.minimum(np.searchsorted(sets[i], values), sizes[i] - 1)
        return np.add.reduceat(sets[i][at] == values, np.cumsum(sizes[some]) - sizes[some], dtype=np.int64)

    return _forest_by(sizes, base, shared)


def perhaps_similar_in(sizes: np.ndarray, bits: list[np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The forest of sets that can be similar by their bitmaps: a bit that only one of two sets has is a hash that only it has."""
    wide, maps = np.array([len(x) for x in bits]), {}
    place = np.empty(len(bits), np.int64)
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == w)
        place[rows] = np.arange(len(rows))
        maps[w] = np.stack([bits[j] for j in rows]).view(np.uint64)

    def shared(i: int, some: np.ndarray) -> np.ndarray:
        out, own = np.empty(len(some), np.int64), maps[int(wide[i])][place[i]]
        for w in np.unique(wide[some]).tolist():
            at = np.flatnonzero(wide[some] == w)
            other = maps[w][place[some[at]]]
            while other.shape[1] > len(own):  # fold to the narrower one
                half = other.shape[1] // 2
                other = other[:, :half] | other[:, half:]
            only = [np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (own & ~other, other & ~own)]
            out[at] = np.minimum(sizes[i] - only[0], sizes[some[at]] - only[1])
        return out

    return _forest_by(sizes, base, shared)


def _by_group(column: str, forest) -> object:
    """Forests of groups (grp, node, base, size, `column`), sorted by group and size."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def flush():
            nodes, base, sizes = (np.array(x, kind) for x, kind in zip(list(zip(*held, strict=True))[:3], (np.int64, bool, np.int64), strict=True))
            child, root = forest(sizes, [x[3] for x in held], base)
            return pa.record_batch([pa.array(nodes[child]), pa.array(nodes[root])], names=["u", "v"])

        for batch in batches:
            data = batch.column(column)
            lists = pa.types.is_list(data.type)
            values, cuts = (data.values.to_numpy(), data.offsets.to_numpy()) if lists else (None, None)
            for k, (grp, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("grp", "node", "base", "size")), strict=True)):
                if held and grp != last:
                    yield flush()
                    held = []
                last = grp
                held.append((*row, values[cuts[k] : cuts[k + 1]].copy() if lists else np.frombuffer(data[k].as_py(), np.uint8)))
        if held:
            yield flush()

    return links


def _compare_in(rows: DataFrame, data: DataFrame, column: str, forest) -> DataFrame:
    """Links inside groups: rows of node, key and parts (tasks of a group, each with its own base rows) meet data of node, size and column."""
    own = F.pmod(F.xxhash64("node"), "parts")
    rows = rows.select("node", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = rows.select(F.xxhash64("key", "part").alias("grp"), "node", (F.col("own") == F.col("part")).alias("base"))
    met = rows.join(data, "node").repartition("grp").sortWithinPartitions("grp", "size").select("grp", "node", "base", "size", column)
    return met.mapInArrow(_by_group(column, forest), "u long, v long")


def similar_links(nodes: DataFrame, sets_of) -> DataFrame:
    """Links (u, v) that connect all similar sets; nodes is a written table of node, size, fp, bits and prefix, one row a set, and
    sets_of(table of node) gives node, size and set.

    Sets whose fingerprints lie within RADIUS bits are candidates by the tiles of SimHash.  Similar sets can have fingerprints
    further apart, so what that leaves apart meets exactly: two similar sets share a shingle of their prefixes in any order of
    shingles, and the order, rarest first by a sample of sets, keeps buckets small.  A bucket that SimHash has put together as a
    whole is done; of others with the same members one is compared, by bitmaps that bound what two sets can share.  Sets that
    either way connects meet once, to be compared exactly."""
    parts = F.ceil(F.col("n") / BASE_SETS).cast("int").alias("parts")
    near = _linked(nodes.select(F.col("node").alias("doc_id"), "fp"), RADIUS).select(F.col("doc_id").alias("node"), F.col("component_id").alias("head"))
    near = materialize(near, "near")
    keys = nodes.select("node", F.explode("prefix").alias("key"))
    shared = keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")  # few of the keys
    shared = materialize(shared.join(near, "node").select("node", "key", "n", "head"), "shared")
    one, two = (F.bit_xor(F.xxhash64("node", F.lit(k))) for k in (1, 2))
    sizes = shared.groupBy("key", "n").agg(one.alias("one"), two.alias("two"), F.min("head").alias("low"), F.max("head").alias("high")).where("low < high")
    sizes = sizes.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key", parts)
    perhaps = _compare_in(shared.drop("head").join(sizes, "key"), nodes.select("node", "size", "bits"), "bits", perhaps_similar_in)
    loose = components(perhaps.unionByName(near.where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v"))))
    blocks = loose.select("node", F.col("root").alias("key")).unionByName(loose.select(F.col("root").alias("node"), F.col("root").alias("key")).distinct())
    blocks = materialize(blocks.join(blocks.groupBy("key").agg(F.count("*").alias("n")).select("key", parts), "key"), "blocks")
    return _compare_in(blocks, sets_of(blocks.select("node")), "set", lambda sizes, sets, base: similar_in(sets, base))


def stage_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component over links of similar texts: the one with its smallest doc_id (once, if the row
    is repeated; of several texts under that id, one).  Texts are similar when SIMILAR (four fifths) of their distinct five-word shingles are shared; texts
    without words are alike.  Of documents without any id in their component one stays."""
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SET_BATCH))  # what comes back has no Python left to run
    try:
        return _one_of_each(docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def _one_of_each(docs: DataFrame) -> DataFrame:
    """Sets are made twice, once for their marks and once where they must be compared: stored, they would be larger than the texts."""
    keyed = docs.withColumn("_pm_key", F.concat_ws(":", F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.xxhash64("text").cast("string"))))
    texts = keyed.select("_pm_key", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = texts.select("_pm_key", "doc_id", _marks(*often_shared(texts.select("text")))("text").alias("m")).select("_pm_key", "doc_id", "m.*")
    marks = materialize(marks, "marks")
    best = lambda c: F.min(c).alias("best")
    named = materialize(marks.groupBy("node").agg(best(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_pm_key"))), "named")
    nodes = materialize(marks.where("size > 0").select("node", "size", "fp", "bits", "prefix").dropDuplicates(["node"]), "nodes")
    discard(marks)  # as large as a part of the texts

    def sets_of(wanted: DataFrame) -> DataFrame:
        chosen = materialize(named.join(wanted, "node", "left_semi").select("node", "best._pm_key"), "chosen")
        sets = texts.join(chosen, "_pm_key").select("node", _shingle_sets("text").alias("set")).dropDuplicates(["node"])
        return sets.select("node", F.size("set").cast("long").alias("size"), "set")

    roots = components(similar_links(nodes, sets_of))
    discard(nodes)
    kept = named.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(best("best"))
    return keyed.join(kept.select("best._pm_key"), "_pm_key", "left_semi").dropDuplicates(["_pm_key"]).select(docs.columns)
