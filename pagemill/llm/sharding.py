"""Sampled splitters: range-partition documents into shards of equal bytes.

Records are ordered by a key (leading 60 bits of md5 of the text, doc_id, number of the row), so equal texts lie next to
each other and every record can be told from every other, identical ones too.

1. A weighted sample of keys is drawn: a record enters with a probability that is half its share of the bytes and
   half its share of the rows, so neither a few huge nor many empty documents can overfill a range.
2. Quantiles of the sample are the splitters of fine ranges.  A text that holds a third of all rows is split like any
   other, by doc_id and number.
3. A range is overfull if it holds much more than its part, or if the border of a shard falls inside it and it is larger
   than TOLERANCE allows.  Overfull ranges are sampled again, denser by as much as they are smaller, and subdivided
   until none is left.
4. A shard takes whole ranges, up to the splitter nearest to its border.  So the splitters decide where a shard ends; sizes
   differ by the tolerance, or by a record that is larger than it.

A window inside each range numbers its records; totals of the ranges give the offsets of the slots.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize

#: Fine ranges, sampled keys a range, how much of the mean a range may hold, share of a shard that a border may be off.
RANGES, PER_RANGE, OVERFULL, TOLERANCE = 2048, 16, 4, 0.0005
_LOWEST = -(2**63)
_KEY = ["key", "tie", "row"]


def _quantiles(sample: pd.DataFrame, parts: int) -> list[tuple[int, ...]]:
    """Keys at the inner quantiles of a weighted sample."""
    if sample.empty or parts < 2:
        return []
    sample = sample.sort_values(_KEY, kind="stable")
    total = sample["weight"].sum()
    at = np.searchsorted(sample["weight"].cumsum().to_numpy(), total * np.arange(1, parts) / parts)
    picked = sample.iloc[np.unique(np.minimum(at, len(sample) - 1))]
    return sorted(set(zip(*(picked[c].tolist() for c in _KEY), strict=True)))


def _place(splitters: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """How many splitters are at or below each row, both given column by column."""
    high = np.searchsorted(splitters[0], rows[0], "right")
    if len(splitters) == 1:
        return high
    out = np.searchsorted(splitters[0], rows[0], "left")
    for first in np.unique(out[high > out]):  # rows whose first column is that of a splitter
        met = (out == first) & (high > out)
        own = slice(first, high[met][0])
        out[met] = first + _place([s[own] for s in splitters[1:]], [r[met] for r in rows[1:]])
    return out


def _range_of(splitters: list[tuple[int, ...]]):
    columns = [np.array(c, dtype=np.int64) for c in zip(*splitters, strict=True)]

    @F.pandas_udf("int")
    def range_of(key: pd.Series, tie: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(_place(columns, [x.to_numpy(dtype=np.int64) for x in (key, tie, row)]).astype(np.int32))

    return range_of


def _sample(slim: DataFrame, wanted: int, total: int, rows: int, seed: int) -> pd.DataFrame:
    """About `wanted` keys, independent of how many rows are alike."""
    share = F.col("size") / F.lit(2.0 * max(total, 1)) + F.lit(0.5 / max(rows, 1))
    draw = F.pmod(F.xxhash64(F.lit(seed), *_KEY), F.lit(2**40)) / F.lit(float(2**40))
    weighed = slim.withColumn("w", share * wanted).where(draw < F.col("w"))
    return weighed.select(*_KEY, F.greatest(F.col("w"), F.lit(1.0)).alias("weight")).toPandas()


def _overfull(sums: pd.DataFrame, shards: int, total: int, rows: int, ranges: int, tolerance: float) -> pd.Series:
    """Which ranges (b bytes and n rows after b0 bytes) must be subdivided."""
    large = ((sums.b > OVERFULL * total / ranges) | (sums.n > OVERFULL * rows / ranges)) & (rows > ranges)
    border = np.floor(sums.b0 * shards / max(total, 1)) != np.ceil((sums.b0 + sums.b) * shards / max(total, 1)) - 1
    return (sums.n > 1) & (large | (border & (sums.b > tolerance * total / shards)))


def split(slim: DataFrame, shards: int, total: int, rows: int, *, ranges: int = RANGES, tolerance: float = TOLERANCE, seed: int = 17) -> tuple[list[tuple[int, ...]], pd.DataFrame]:
    """The splitters, and for each range its bytes b and rows n, those before it (b0, n0), and its shard."""
    splitters = _quantiles(_sample(slim, ranges * PER_RANGE, total, rows, seed), min(ranges, max(1, rows)))
    while True:
        seed += 1
        ranged = slim.withColumn("range", _range_of(splitters)(*_KEY)) if splitters else slim.withColumn("range", F.lit(0))
        sums = ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas().sort_values("range").reset_index(drop=True)
        sums["b0"], sums["n0"] = sums.b.cumsum() - sums.b, sums.n.cumsum() - sums.n
        full = sums[_overfull(sums, shards, total, rows, ranges, tolerance)]
        if full.empty:
            break
        inside = ranged.where(F.col("range").isin([int(x) for x in full["range"]]))
        more = _sample(inside, max(ranges, 4 * len(full)) * PER_RANGE, int(full.b.sum()), int(full.n.sum()), seed)
        # as many new splitters as keep ranges fine; keys are all different, so some key divides every range of two rows or more
        splitters = sorted({*splitters, *_quantiles(more, max(ranges, 4 * len(full)))})
    # a range belongs to the shard in which its middle lies: its borders are splitters, those nearest to the shard's
    sums["shard"] = np.minimum(((sums.b0 + sums.b / 2) * shards // max(total, 1)).astype(int), shards - 1)
    return splitters, sums


def shard_by_splitters(
    docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, tolerance: float = TOLERANCE, seed: int = 17
) -> DataFrame:
    """Deal documents out to shards of near equal bytes.

    Returns id, size (UTF-8 bytes plus 1; a null text has none), text_crc32, shard and slot (from 0 without gaps).
    A null text counts as an empty one; a null id sorts first; repeated rows are rows of their own; other columns
    are ignored; an empty table gives an empty table; with fewer rows than shards some shards stay empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
        F.monotonically_increasing_id().alias("row"),  # kept by the written table: tells identical records apart
    ).withColumn("tie", F.coalesce("doc_id", F.lit(_LOWEST)))
    slim = materialize(slim, "shard-keys")
    total, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    splitters, sums = split(slim, shards, total, rows, ranges=ranges, tolerance=tolerance, seed=seed)
    starts = sums.groupby("shard").n0.min()
    offsets = docs.sparkSession.createDataFrame(
        [(int(r), int(s), int(n - starts[s])) for r, s, n in zip(sums["range"], sums.shard, sums.n0, strict=True)], "range int, shard int, n0 long"
    )
    ranged = slim.withColumn("range", _range_of(splitters)(*_KEY)) if splitters else slim.withColumn("range", F.lit(0))
    in_range = Window.partitionBy("range").orderBy(*_KEY)
    placed = ranged.withColumn("n", F.row_number().over(in_range) - 1).join(F.broadcast(offsets), "range")  # a row for each range: bounded by the parameters
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("n") + F.col("n0")).cast("long").alias("slot"))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 8 shards under the law `bytes`."""
    return shard_by_splitters(documents(spark, sf_dir), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
