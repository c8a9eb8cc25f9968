"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Largest inner product is turned into nearest by one more component that lifts all points to one length; among points of
one length, the nearest is the one with the largest inner product, so graphs are built and searched by it alone.

Shards are cells around centroids, fitted to a bounded sample of points; a cell above its size is split by hash into
parts.  A shard holds as many points as SHARD and SHARD_BYTES allow.  A query goes to the parts of the cells whose
centroids are nearest.  How many of them is measured: as few as hold COVER of the neighbours of sampled queries in
the sample.  Where vectors have a structure that is few; where they have none it is nearly all, as no part can be left out.

A shard's graph is built by insertion.  Points come in batches that at most double what is there: each batch searches the
graph so far, layer by layer from the top, for candidates, its own earlier points are candidates too, and links are
picked from them by the diversity rule, and set back, with full lists pruned by the same rule.  The graph is stored as
flat arrays: one of neighbours of fixed width for each layer, padded by -1.

Equal vectors are one point of the index (with the smallest ids that can come up), so a vector that a third of the
rows share neither clogs a graph nor fills a shard.  Every query row is a query of its own.  Scores of what is found
are computed in double precision on the original vectors, and the best of all shards are merged for each query.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Points of a shard and bytes of their vectors at most, cells of a table, sampled points a cell, sampled queries, share of their
#: neighbours that the cells a query visits must hold.
SHARD, SHARD_BYTES, CELLS, PER_CELL, ASKED, COVER = 8192, 1 << 26, 2048, 64, 256, 0.98
#: Links of a point above the lowest layer (twice as many there), candidates of an insertion, points inserted at once,
#: new links that a point weighs at once, rows left in a step, beam of a search, queries of a block and of a walk.
LINKS, BUILD, BATCH, BACK, STRIDE, BEAM, BLOCK, WALK = 16, 64, 256, 24, 4, 160, 8192, 256


def lift(points: np.ndarray, scale: float, longest: float) -> np.ndarray:
    """Points over `scale`, with one more component that brings their squared length to `longest`."""
    own = points / scale
    return np.hstack([own, np.sqrt(np.maximum(longest - (own**2).sum(axis=1), 0))[:, None]]).astype(np.float32)


def _walk(points: np.ndarray, flat: np.ndarray, place: np.ndarray | None, queries: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` best rows for each query that its walk over one layer from its start meets, best first (padded by len(points)),
    and their inner products.  All queries take a step at a time, each from the STRIDE best rows it has not left yet."""
    m, n = len(queries), len(points)
    beam = min(beam, n)
    stride = min(STRIDE, beam)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = seen[np.arange(m), starts] = True
    ids, score, done = np.full((m, beam), n, np.int32), np.full((m, beam), -np.inf, np.float32), np.ones((m, beam), bool)
    ids[:, 0], score[:, 0], done[:, 0] = starts, np.einsum("qd,qd->q", points[starts], queries), False
    live = np.arange(m)
    while len(live):
        waiting = np.where(done[live], np.float32(-np.inf), score[live])
        best = np.argpartition(-waiting, stride - 1, axis=1)[:, :stride]
        open_ = np.take_along_axis(waiting, best, 1) > -np.inf
        some = open_.any(axis=1)
        live, best, open_ = live[some], best[some], open_[some]
        if not len(live):
            break
        at = np.where(open_, ids[live[:, None], best], n)
        done[live[:, None], best] = True
        near = flat[np.minimum(at, n - 1) if place is None else place[np.minimum(at, n - 1)]]
        near = np.where((near < 0) | (at == n)[:, :, None], n, near).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        fresh = ~seen[live[:, None], near]
        near, fresh = near[:, fresh.any(axis=0)], fresh[:, fresh.any(axis=0)]
        seen[live[:, None], near] = True
        got = np.where(fresh, np.einsum("qkd,qd->qk", points[np.where(fresh, near, 0)], queries[live]), np.float32(-np.inf))
        both = np.concatenate([score[live], got], axis=1)
        keep = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
        score[live] = np.take_along_axis(both, keep, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, n).astype(np.int32)], axis=1), keep, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), keep, 1)
    order = np.lexsort((ids, -score), axis=1)
    return np.take_along_axis(ids, order, 1).astype(np.int64), np.take_along_axis(score, order, 1)


def _diverse(points: np.ndarray, near: np.ndarray, gain: np.ndarray, links: int) -> np.ndarray:
    """Of candidates (best first, padded by -1 with a gain of minus infinity) those to link, padded by -1: each is nearer to its
    point than to any picked before; the rest fill up in order."""
    m, c = near.shape
    v = points[np.maximum(near, 0)]
    picked, most, count = np.zeros((m, c), bool), np.full((m, c), -np.inf, np.float32), np.zeros(m, int)
    for i in range(c):
        new = (most[:, i] <= gain[:, i]) & (near[:, i] >= 0) & (count < links)
        if new.any():
            picked[new, i] = True
            count[new] += 1
            most[new] = np.maximum(most[new], np.einsum("qkd,qd->qk", v[new], v[new, i]))
    rank = np.where(near < 0, 2 * c, np.where(picked, 0, c)) + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :links]
    out = np.take_along_axis(near, order, 1)
    return np.pad(out, ((0, 0), (0, max(0, links - out.shape[1]))), constant_values=-1)


def _set_back(points: np.ndarray, flat: np.ndarray, rows: np.ndarray, place: np.ndarray | None, chosen: np.ndarray) -> None:
    """Links from `rows` to `chosen` set in the other direction; lists that overflow are pruned."""
    source, target = np.repeat(rows, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    gain = np.einsum("id,id->i", points[source], points[target])
    order = np.lexsort((-gain, target))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, int)
    nth = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
    source, target, nth = source[nth < BACK], target[nth < BACK], nth[nth < BACK]
    owners, number = np.unique(target, return_inverse=True)
    new = np.full((len(owners), BACK), -1)
    new[number, nth] = source
    at = owners if place is None else place[owners]
    near = np.concatenate([flat[at], new], axis=1)
    value = np.where(near >= 0, np.einsum("qkd,qd->qk", points[np.maximum(near, 0)], points[owners]), -np.inf).astype(np.float32)
    order = np.argsort(-value, axis=1, kind="stable")
    near, value = np.take_along_axis(near, order, 1), np.take_along_axis(value, order, 1)
    width = flat.shape[1]
    full = (near >= 0).sum(axis=1) > width
    flat[at[~full]] = near[~full, :width]
    flat[at[full]] = _diverse(points, near[full], value[full], width)


def build(points: np.ndarray, seed: int = 0) -> dict:
    """The graph over lifted points: for each layer, its members and their neighbours (rows of `points`), and the entry."""
    n, rng = len(points), np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(int), 6)
    levels[0] = levels.max()  # the first point is the entry
    top = int(levels[0])
    members = [np.flatnonzero(levels >= k) for k in range(top + 1)]
    places = [None, *(np.full(n + 1, -1) for _ in range(top))]
    for k in range(1, top + 1):
        places[k][members[k]] = np.arange(len(members[k]))
    flats = [np.full((len(members[k]), LINKS * (1 if k else 2)), -1, np.int64) for k in range(top + 1)]
    start = 1
    while start < n:
        stop = min(n, start + min(BATCH, start))
        rows = np.arange(start, stop)
        queries, at = points[rows], np.zeros(len(rows), int)
        inside = queries @ queries.T
        inside[np.triu_indices(len(rows))] = -np.inf  # earlier points of the batch only
        found = []
        for k in range(top, -1, -1):
            ids, score = _walk(points[:start], flats[k], places[k], queries, at, BUILD if (levels[rows] >= k).any() else 1)
            at = ids[:, 0]
            own = levels[rows] >= k
            near = np.concatenate([np.where(ids[own] < start, ids[own], -1), np.where(levels[rows][None] >= k, rows[None], -1).repeat(own.sum(), 0)], axis=1)
            gain = np.where(near >= 0, np.concatenate([score[own], inside[own]], axis=1), -np.inf)
            near = np.where(gain > -np.inf, near, -1)
            order = np.argsort(-gain, axis=1, kind="stable")[:, :BUILD]
            found.append((k, rows[own], np.take_along_axis(near, order, 1), np.take_along_axis(gain, order, 1).astype(np.float32)))
        for k, mine, near, gain in found:
            if len(mine):
                chosen = _diverse(points, near, gain, LINKS)
                flats[k][mine if places[k] is None else places[k][mine], :LINKS] = chosen
                _set_back(points, flats[k], mine, places[k], chosen)
        start = stop
    return {"layers": [(m.astype(np.int32), f.astype(np.int32)) for m, f in zip(members, flats, strict=True)], "entry": 0}


def search(points: np.ndarray, graph: dict, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Rows of the lifted points found for each lifted query, best first by single precision, padded by len(points)."""
    out = []
    for start in range(0, len(queries), WALK):
        block = queries[start : start + WALK]
        at = np.full(len(block), graph["entry"])
        for k in range(len(graph["layers"]) - 1, -1, -1):
            members, flat = graph["layers"][k]
            place = None
            if k:
                place = np.full(len(points) + 1, -1)
                place[members] = np.arange(len(members))
            ids, _ = _walk(points, flat, place, block, at, 1 if k else beam)
            at = ids[:, 0]
        out.append(ids)
    return np.concatenate(out)


# --- shards -------------------------------------------------------------------------------------------------------


def shard_size(width: int, shard: int = SHARD) -> int:
    return max(64, min(shard, SHARD_BYTES // (8 * max(1, width))))


def centroids(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of lifted points, of the points' length, by rounds of assignment and means; a cell that goes empty starts anew."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), cells, replace=False)]
    length = float(np.sqrt((sample**2).sum(axis=1).mean()))
    for _ in range(rounds):
        own = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros((cells, sample.shape[1]))
        np.add.at(sums, own, sample)
        size = np.sqrt((sums**2).sum(axis=1))
        empty = size == 0
        sums[empty], size[empty] = sample[rng.choice(len(sample), int(empty.sum()))], length
        centres = (sums / size[:, None] * length).astype(np.float32)
    return centres


def visited(sample: np.ndarray, centres: np.ndarray, k: int, seed: int = 0) -> int:
    """How many nearest cells hold COVER of the k nearest of sampled queries.  Neighbours in a sample are further away than
    those in the table, so this errs to more cells."""
    rows = np.random.default_rng(seed).choice(len(sample), min(ASKED, len(sample)), replace=False)
    aimed = _aim(sample[rows, :-1].astype(np.float64))
    gains = aimed @ sample.T
    gains[np.arange(len(rows)), rows] = -np.inf
    near = np.argsort(-gains, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    own = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
    place = np.argsort(np.argsort(-(aimed @ centres.T), axis=1, kind="stable"), axis=1)
    held = np.bincount(np.take_along_axis(place, own[near], 1).ravel(), minlength=len(centres)).cumsum()
    return int(np.searchsorted(held, COVER * held[-1])) + 1


def _kind(v):
    """Vectors of a kind share their length and the magnitude of their largest component (two decades), so that none is lost in
    single precision beside a far larger one."""
    return F.concat_ws(":", F.size(v), F.floor(F.log10(F.array_max(F.transform(v, F.abs))) / 2))


def _space(points: DataFrame, shard: int, k: int) -> dict[str, tuple[int, float, float, np.ndarray, int]]:
    """For each kind of vectors: length, scale, squared length of the lifted points, centroids, and cells that a query visits.  What comes to the driver is a
    row for each kind, and PER_CELL points for each of at most CELLS cells."""
    v = F.col("vector")
    largest = {r[0]: (r[1], r[2], r[3]) for r in points.groupBy("kind").agg(F.first(F.size(v)), F.max(F.array_max(F.transform(v, F.abs))), F.count("*")).collect()}
    if not largest:
        return {}
    scale = F.create_map(*[F.lit(x) for kind, (_, s, _) in largest.items() for x in (kind, s)])[F.col("kind")]
    squares = F.aggregate(F.transform(v, lambda x: F.pow(x / scale, 2)), F.lit(0.0), lambda a, x: a + x)
    longest, out = dict(points.groupBy("kind").agg(F.max(squares)).collect()), {}
    for kind, (width, s, n) in largest.items():
        cells = min(CELLS, -(-n // shard_size(width, shard)))
        centres, probes = np.zeros((1, width + 1), np.float32), 1
        if cells > 1:
            rate = max(1, n // (cells * PER_CELL))
            drawn = points.where(F.col("kind") == kind).where(F.pmod(F.xxhash64(F.lit(12), "first"), F.lit(rate)) == 0).orderBy("first").select("vector").toPandas()
            lifted = lift(np.array(drawn["vector"].tolist(), np.float64).reshape(len(drawn), width), s, longest[kind])
            if len(lifted) > 1:
                centres = centroids(lifted, min(cells, len(lifted)))
                probes = visited(lifted, centres, k)
        out[kind] = (width, s, longest[kind], centres, probes)
    return out


def _cell_of(space: dict):
    """The cell of a point among those of its kind."""

    @F.pandas_udf("int")
    def cell(kinds: pd.Series, vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int32)
        for kind, rows in kinds.groupby(kinds.to_numpy()).indices.items():
            _, s, longest, centres, _ = space[kind]
            out[rows] = (lift(np.stack(vectors.iloc[rows].tolist()).astype(np.float64), s, longest) @ centres.T).argmax(axis=1)
        return pd.Series(out)

    return cell


def _aim(queries: np.ndarray) -> np.ndarray:
    """Queries as they meet lifted points: of any length (only their direction ranks), the last component zero."""
    return np.hstack([queries / np.abs(queries).max(axis=1, keepdims=True), np.zeros((len(queries), 1))]).astype(np.float32)


def _cells_of(space: dict, probes: int | None):
    """The cells that a query visits: the nearest of every kind of its length, `probes` or as many as were measured."""

    @F.pandas_udf("array<struct<kind:string,cell:int>>")
    def cells(vectors: pd.Series) -> pd.Series:
        widths = vectors.map(len)
        out: list[list[dict]] = [[] for _ in vectors]
        for width, rows in widths.groupby(widths.to_numpy()).indices.items():
            aimed = _aim(np.stack(vectors.iloc[rows].tolist()).astype(np.float64))
            for kind, (own, _, _, centres, measured) in space.items():
                if own == width:
                    for i, gains in zip(rows, aimed @ centres.T, strict=True):
                        out[i] += [{"kind": kind, "cell": int(c)} for c in np.argsort(-gains, kind="stable")[: probes or measured]]
        return pd.Series(out)

    return cells


def _build_shard(space: dict):
    def made(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        kind, cell, part = key[0], int(key[1]), int(key[2])
        pdf = pdf.sort_values("first").reset_index(drop=True)
        points = np.stack(pdf["vector"].tolist()).astype(np.float64)
        held = {"points": points, "ids": pdf["ids"].map(list).tolist(), "graph": build(lift(points, *space[kind][1:3]), cell * 1009 + part)}
        return pd.DataFrame({"kind": [kind], "cell": [cell], "part": [part], "graph": [pickle.dumps(held, protocol=5)]})

    return made


def _block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("q")
    vectors = np.stack(pdf["vector"].tolist()).astype("<f8").tobytes()
    return pd.DataFrame({"kind": [key[0]], "cell": [int(key[1])], "part": [int(key[2])], "qs": [pdf["q"].tolist()], "vectors": [vectors]})


def _search(space: dict, k: int, beam: int):
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for kind, blob, qs, vectors in zip(batch["kind"], batch["graph"], batch["qs"], batch["vectors"], strict=True):
                held = pickle.loads(blob)
                width, s, longest, *_ = space[kind]
                exact, queries = held["points"], np.frombuffer(vectors, "<f8").reshape(-1, width)
                out: dict[str, list] = {"q": [], "vec_id": [], "score": [], "same": []}
                for q, query, rows in zip(qs, queries, search(lift(exact, s, longest), held["graph"], _aim(queries), max(beam, k + 1)), strict=True):
                    rows = rows[rows < len(exact)]
                    scores, same = (exact[rows] * query).sum(axis=1), (exact[rows] == query).all(axis=1)
                    pairs = sorted((-x, i, e) for x, r, e in zip(scores.tolist(), rows.tolist(), same.tolist(), strict=True) for i in held["ids"][r])[: k + 1]
                    out["q"] += [q] * len(pairs)
                    out["vec_id"] += [i for _, i, _ in pairs]
                    out["score"] += [-x for x, _, _ in pairs]
                    out["same"] += [e for _, _, e in pairs]
                yield pd.DataFrame(out).astype({"q": "int64", "vec_id": "int64", "score": "float64", "same": "bool"})

    return found


def nearest(
    vectors: DataFrame, *, k: int = 20, every: int = 20, shard: int = SHARD, probes: int | None = None, beam: int = BEAM, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest of each query (rows whose id is divisible by `every`), by inner product: query_id, rank, vec_id,
    score.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id, take no part.
    Vectors of other lengths are searched among their own kind.  Ties go to the smaller id.  Rows that share an id are rows
    of their own, as queries and as candidates; of identical rows, a query leaves out one.  A query with fewer
    candidates gets them all; an empty table gives an empty table; other columns are ignored.
    """
    v = F.col("vector")
    good = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = good.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    good = materialize(good.withColumn("row", F.monotonically_increasing_id()), "hnsw-rows")  # the written table keeps the numbers
    # the k + 1 smallest ids of a vector are all that can come up; salted, so that a hot vector is not one task's
    salted = Window.partitionBy("vector", F.pmod(F.xxhash64("row"), F.lit(64))).orderBy("vec_id", "row")
    few = good.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k + 1)
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row"))).where(F.col("n") <= k + 1)
    points = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.min("row").alias("first"))
    points = materialize(points.withColumn("kind", _kind(v)), "hnsw-points")
    space = _space(points, shard, k)

    dealt = materialize(points.withColumn("cell", _cell_of(space)("kind", v)), "hnsw-dealt")
    room = F.greatest(F.lit(64), F.least(F.lit(shard), F.floor(F.lit(SHARD_BYTES) / (8 * F.first(F.size(v))))))
    # a cell above its size is split: a row for each cell
    sizes = dealt.groupBy("kind", "cell").agg(F.count("*").alias("n"), room.alias("room"))
    sizes = materialize(sizes.select("kind", "cell", F.ceil(F.col("n") / (1.5 * F.col("room"))).cast("int").alias("parts")), "hnsw-cells")
    keys = ["kind", "cell", "part"]
    dealt = dealt.join(sizes, ["kind", "cell"]).withColumn("part", F.pmod(F.xxhash64(F.lit(10), "first"), F.col("parts")).cast("int"))
    graphs = dealt.select(*keys, "vector", "ids", "first").groupBy(*keys).applyInPandas(_build_shard(space), "kind string, cell int, part int, graph binary")
    graphs = materialize(graphs, "hnsw-graphs")

    asked = good.where(F.col("vec_id") % every == 0).select(F.col("row").alias("q"), F.col("vec_id").alias("query_id"), "vector")

    def hits_of(queries: DataFrame, most: int | None) -> DataFrame:
        routed = queries.select("q", "vector", F.explode(_cells_of(space, most)(v)).alias("c")).select("q", "vector", "c.*").join(sizes, ["kind", "cell"])
        routed = materialize(routed.select("q", "vector", "kind", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "hnsw-routed")
        blocks = routed.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        packed = routed.join(blocks, keys).withColumn("block", F.pmod(F.xxhash64(F.lit(11), "q"), F.col("blocks")).cast("int"))
        packed = packed.groupBy(*keys, "block").applyInPandas(_block, "kind string, cell int, part int, qs array<long>, vectors binary")
        return packed.join(graphs, keys).select("kind", "graph", "qs", "vectors").mapInPandas(_search(space, k, beam), "q long, vec_id long, score double, same boolean")

    hits = hits_of(asked, probes)
    if any(len(centres) > (probes or measured) for *_, centres, measured in space.values()):
        # queries whose cells hold fewer than k others visit all cells
        hits = materialize(hits, "hnsw-hits")
        there = points.groupBy(F.size(v).alias("width")).agg(F.sum(F.size("ids")).alias("there"))
        got = asked.withColumn("width", F.size(v)).join(hits.groupBy("q").agg(F.count("*").alias("got")), "q", "left").join(there, "width")
        short = materialize(got.where(F.coalesce("got", F.lit(0)) < F.least(F.lit(k + 1), "there")).select("q", "query_id", "vector"), "hnsw-short")
        if not short.isEmpty():
            hits = hits.join(short, "q", "left_anti").unionByName(hits_of(short, max(len(c) for *_, c, _ in space.values())))

    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    top = hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    top = top.join(asked.select("q", "query_id"), "q").withColumn("own", F.col("same") & (F.col("vec_id") == F.col("query_id")))
    first = F.min(F.when(F.col("own"), F.col("n"))).over(Window.partitionBy("q"))  # of identical rows one is the query
    left = top.withColumn("first", first).where(F.col("first").isNull() | (F.col("n") != F.col("first")))
    rank = F.col("n") - F.when(F.col("first") < F.col("n"), 1).otherwise(0)
    return left.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op10_hnsw(spark, sf_dir: str) -> DataFrame:
    """Twenty nearest of every twentieth vector."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
