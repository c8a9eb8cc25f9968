"""Best-fit packing by a grouping genetic algorithm.

Documents become token pieces of at most `capacity` tokens; pieces are packed whole into sequences.  A piece as long as
a sequence is one.  The others are dealt by hash into regions of about REGION pieces; each region is solved by ISLANDS
islands, Spark groups with seeds of their own.  An island's individuals are partitions of the region's pieces into
bins, at first in random order.  Crossover injects the best-filled bins of one parent whole into the other, removes the
bins there that share a piece with them, and best-fits the displaced pieces, largest first; mutation dissolves the
worst-filled bins, and some by chance, likewise.  After each epoch the islands of a region exchange their elites, and the
last exchange picks the fewest bins.  Sequences that stay half empty are taken out of all regions and evolved together.

Every island runs all its generations, whatever bound it meets; what it took is reported with each piece.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize

CAPACITY, END = 2048, 0
#: Pieces of a region, islands of a region, epochs, generations of an epoch, individuals, share of bins that move.
REGION, ISLANDS, EPOCHS, GENERATIONS, POPULATION, INJECT, DISSOLVE = 8192, 2, 2, 5, 4, 0.3, 0.4


def tokenizer_files(name: str = "byte_bpe_50k") -> dict[str, str]:
    """Paths of a byte-level vocabulary: of `tokenizers`, and the same vocabulary as ranks of `tiktoken`."""
    import public_tokenizers

    return {"json": public_tokenizers.path(f"{name}.json"), "ranks": public_tokenizers.path(f"{name}.tiktoken")}


class Encoder:
    """Ids by `tokenizers`.  Texts within Latin-1, where both libraries split words by the same letters, go through
    `tiktoken` over the same vocabulary, which gives the same ids in a quarter of the time; all others, and all texts
    where no ranks are given, go through `tokenizers` itself."""

    def __init__(self, files: dict[str, str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(files["json"])
        self.slow.encode_special_tokens = True  # their names in a text are ordinary text
        self.fast = None
        if files.get("ranks"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(files["ranks"], "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                text.encode("latin-1")
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
            except UnicodeEncodeError:
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first one takes the rest, all others are full."""
    first = length % capacity or capacity
    return [(0, min(first, length)), *((at, capacity) for at in range(first, length, capacity))]


def _pieces(files: dict[str, str], capacity: int, end: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(files)
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), np.array([end], "<u4"))
                for i, (start, n) in enumerate(cut(len(ids), capacity)):
                    for col, x in zip(out, (doc, i, start, n, zlib.crc32(ids[start : start + n].astype("<u4").tobytes())), strict=True):
                        col.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return pieces


class Bins:
    """An assignment of items (by length, each at most the capacity) to bins, with best fit by a bit set of free sizes."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []

    def copy(self) -> Bins:
        new = Bins(self.sizes, self.capacity)
        new.items, new.free = [list(x) for x in self.items], list(self.free)
        return new

    def best_fit(self, loose: list[int], largest_first: bool = True) -> None:
        """Put items where they leave the least room; ties to the bin opened last."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for b, room in enumerate(self.free):
            by_room[room].append(b)
            mask |= 1 << room
        for item in sorted(loose, key=self.sizes.__getitem__, reverse=True) if largest_first else loose:
            n = self.sizes[item]
            if above := mask >> n:
                room = n + (above & -above).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    mask &= ~(1 << room)
                self.items[b].append(item)
                room -= n
                self.free[b] = room
            else:
                b, room = len(self.items), self.capacity - n
                self.items.append([item])
                self.free.append(room)
            by_room[room].append(b)
            mask |= 1 << room

    def keep(self, which: list[int]) -> None:
        self.items, self.free = [self.items[b] for b in which], [self.free[b] for b in which]

    def fitness(self) -> tuple[int, float]:
        """Fewer bins, then fuller ones (the sum of squared fills)."""
        return -len(self.items), sum((self.capacity - f) ** 2 for f in self.free)

    def dissolve(self, share: float, rng: np.random.Generator) -> None:
        order = sorted(range(len(self.items)), key=self.free.__getitem__)
        cutoff = len(order) - max(2, round(share * len(order)))
        gone = set(order[max(0, cutoff) :]) | {int(x) for x in rng.integers(len(order), size=max(1, round(share * len(order) / 2)))}
        loose = [i for b in gone for i in self.items[b]]
        self.keep([b for b in range(len(self.items)) if b not in gone])
        self.best_fit(loose)

    def cross(self, giver: Bins, share: float, rng: np.random.Generator) -> Bins:
        """A child of self with whole well-filled bins of the giver."""
        order = sorted(range(len(giver.items)), key=giver.free.__getitem__)[: max(1, len(giver.items) // 2)]
        picked = [order[int(x)] for x in np.unique(rng.integers(len(order), size=max(1, round(share * len(order)))))]
        held = {i for b in picked for i in giver.items[b]}
        child = Bins(self.sizes, self.capacity)
        loose: list[int] = []
        for b, items in enumerate(self.items):
            if held.isdisjoint(items):
                child.items.append(list(items))
                child.free.append(self.free[b])
            else:
                loose += [i for i in items if i not in held]
        child.items += [list(giver.items[b]) for b in picked]
        child.free += [giver.free[b] for b in picked]
        child.best_fit(loose)
        return child

    def numbers(self) -> np.ndarray:
        out = np.empty(len(self.sizes), np.int64)
        for b, items in enumerate(self.items):
            out[items] = b
        return out

    @classmethod
    def of(cls, sizes: list[int], capacity: int, numbers: np.ndarray) -> Bins:
        new = cls(sizes, capacity)
        new.items = [[] for _ in range(int(numbers.max()) + 1)]
        for item, b in enumerate(numbers.tolist()):
            new.items[b].append(item)
        new.free = [capacity - sum(sizes[i] for i in x) for x in new.items]
        return new


@dataclass
class Evolved:
    """The bin of each item in the best individual of an epoch, and what it took."""

    numbers: np.ndarray
    generations: int
    crossovers: int


def evolve(sizes: list[int], capacity: int, elites: list[np.ndarray], seed: int, generations: int = GENERATIONS) -> Evolved:
    """One epoch of an island.  Individuals that no elite fills start from a random order, each item put where it leaves
    the least room.  Every epoch runs all its generations; the population's worse half is replaced by children."""
    rng = np.random.default_rng(seed)
    population = [Bins.of(sizes, capacity, e) for e in elites]
    while len(population) < POPULATION:
        one = Bins(sizes, capacity)
        one.best_fit(rng.permutation(len(sizes)).tolist(), largest_first=False)
        population.append(one)
    crossovers = 0
    for _ in range(generations):
        population.sort(key=Bins.fitness, reverse=True)
        for worst in range(len(population) // 2, len(population)):
            a, b = rng.choice(len(population) // 2 + 1, 2, replace=False)
            child = population[int(a)].cross(population[int(b)], INJECT, rng)
            child.dissolve(DISSOLVE, rng)
            population[worst] = child
            crossovers += 1
    return Evolved(max(population, key=Bins.fitness).numbers(), generations, crossovers)


_ORDER = ["row", "doc_id", "piece", "start", "length", "ids_crc32", "region"]
_SOLVED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, region long, island int, bin long, generations long, crossovers long"


def _island(capacity: int, epoch: int):
    def island(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32", "row"], kind="stable").reset_index(drop=True)
        elites, before = [], (0, 0)
        if epoch:
            stacked = np.array(pdf["elites"].tolist(), dtype=np.int64)
            elites, before = [stacked[:, i] for i in range(stacked.shape[1])], (pdf["generations"].max(), pdf["crossovers"].max())
        best = evolve(pdf["length"].tolist(), capacity, elites, int(key[0]) * 1009 + int(key[1]) * 31 + epoch)
        pdf["bin"], pdf["generations"], pdf["crossovers"] = best.numbers, before[0] + best.generations, before[1] + best.crossovers
        return pdf[[*_ORDER, "island", "bin", "generations", "crossovers"]]

    return island


def _evolved(dealt: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """Pieces with a region, and the bin of each in its region's best individual."""
    each = F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))
    solved = materialize(dealt.withColumn("island", each).groupBy("region", "island").applyInPandas(_island(capacity, 0), _SOLVED), "pack-epoch")
    for epoch in range(1, epochs):
        bins = F.transform(F.array_sort(F.collect_list(F.struct("island", "bin"))), lambda x: x["bin"]).alias("elites")
        met = solved.groupBy(*_ORDER).agg(bins, F.max("generations").alias("generations"), F.max("crossovers").alias("crossovers"))
        solved = materialize(met.withColumn("island", each).groupBy("region", "island").applyInPandas(_island(capacity, epoch), _SOLVED), "pack-epoch")
    bins = solved.groupBy("region", "island").agg((F.max("bin") + 1).alias("bins"))
    chosen = bins.groupBy("region").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    return solved.join(chosen, ["region", "island"], "left_semi")


def pack(
    docs: DataFrame, *, capacity: int = CAPACITY, files: dict[str, str] | None = None, end: int = END, region: int = REGION, islands: int = ISLANDS, epochs: int = EPOCHS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset for each piece, and the generations and
    crossovers that its island went through (null for a piece that fills a sequence).  A null or empty text is its
    end token alone; a null id stays null; repeated rows are documents of their own; other columns are ignored; an
    empty table gives an empty table.
    """
    files = tokenizer_files() if files is None else files
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    cut_up = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_pieces(files, capacity, end), schema)
    # a number of its own for each piece, kept by the written table: tells repeated rows apart and spreads them
    pieces = materialize(cut_up.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    short = pieces.where(F.col("length") < capacity)
    regions = max(1, -(-short.count() // region))
    dealt = short.withColumn("region", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(regions)))
    first = materialize(_evolved(dealt, capacity, islands, epochs).withColumn("free", capacity - F.sum("length").over(Window.partitionBy("region", "bin"))), "pack-regions")
    # what the regions left half empty meets in regions of its own, numbered behind the others
    loose = first.where(F.col("free") * 2 >= capacity) if regions > 1 else first.limit(0)
    more = max(1, -(-loose.count() // region))
    again = _evolved(loose.select(*_ORDER).withColumn("region", regions + F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(more))), capacity, islands, 1)
    solved = (first.where(F.col("free") * 2 < capacity) if regions > 1 else first).drop("free").unionByName(again)
    within = Window.partitionBy("region", "bin").orderBy(F.col("length").desc(), "doc_id", "piece", "row")
    packed = solved.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (2 * (F.col("bin") * (regions + more) + F.col("region"))).alias("sequence_id"),
        (F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"), "generations", "crossovers",
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("generations", "crossovers")]
    full = pieces.where(F.col("length") == capacity)
    full = full.select("doc_id", "piece", "start", "length", "ids_crc32", (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *none)
    return packed.unionByName(full)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document, packed."""
    return pack(documents(spark, sf_dir))


def stage_pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed: null, empty and very long texts, repeated rows, extra columns and empty tables as in `pack`."""
    return pack(docs)
