"""Table regions of whole pages in one pass: panels, banners, scores and pairs over the cells of many pages at once, as arrays sorted by
region.  A page's cells are together in its row, so nothing is dealt out, written or joined between the steps; work grows with
the cells.  The rules are those of segment, split_at_banners and region_scores in layout.py, which do one step each over tables of cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from ..config import Tables

#: Bits of a cell's flags, from its text and whether it is a heading.
HEADING, NO_HEADING, YEAR, VALUE, CAPITALS = 1, 2, 4, 8, 16
#: Cells of pages, and of pairs of regions, that go through together.
BATCH_CELLS, PAIR_CELLS = 50_000, 200_000
REJECTS = np.array(["too_few_cells", "too_few_grid_cells", "prose_region", "timeline_region", "page_sized_region", "not_enough_columns", "not_enough_aligned_rows"])
_NUMBERS = {"cells": "long", "grid_cells": "long", "columns": "long", "rows": "long", "aligned_rows": "long", "anchor_alignment": "double", "value_columns": "long", "short_cell_ratio": "double"}
_RECT = ("rl", "rt", "rr", "rb")
SCORED = f"panel int, band int, panel2 int, band2 int, score double, reject string, {', '.join(f'{k} {v}' for k, v in _NUMBERS.items())}, header_row boolean, {', '.join(f'{c} double' for c in _RECT)}, rank int"
MEMBERS = "panel int, band int, panel2 int, band2 int, idx long"


def _starts(group: np.ndarray) -> np.ndarray:
    """Whether an element is the first of its group; groups lie together."""
    first = np.ones(len(group), bool)
    np.not_equal(group[1:], group[:-1], out=first[1:])
    return first


def _least(group: np.ndarray, values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest value (fmin, fmax) of each of n groups that lie together; NaN where there is none."""
    out = np.full(n, np.nan)
    if len(group):
        at = np.flatnonzero(_starts(group))
        out[group[at]] = pick.reduceat(values, at)
    return out


def _reach(first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Furthest end before each element in its group: a running maximum, by doubling."""
    n = len(ends)
    place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    m, d, longest = ends.copy(), 1, int(place.max(initial=0))
    while d <= longest:
        m[d:] = np.where(place[d:] >= d, np.maximum(m[d:], m[:-d]), m[d:])
        d *= 2
    out = np.full(n, -np.inf)
    out[1:] = np.where(first[1:], -np.inf, m[:-1])
    return out


def clusters(group: np.ndarray, values: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy clusters of numbers that are sorted within their groups, each number compared with the running mean of the open cluster:
    the cluster of each number, the means, and the group of each cluster.  Only stretches that neither surely break nor surely
    hold together are walked, all of them at once."""
    n = len(values)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, group.dtype)
    opens = _starts(group)
    opens[1:] |= values[1:] - values[:-1] > tolerance + 1e-9
    at = np.flatnonzero(opens)
    size = np.diff(np.append(at, n))
    unsure = values[at + size - 1] - values[at] > tolerance - 1e-9
    if unsure.any():
        at, size = at[unsure], size[unsure]
        order = np.argsort(-size, kind="stable")
        at, less = at[order], -size[order]
        total, many = values[at].copy(), np.ones(len(at))
        for j in range(1, -int(less[0])):
            live = int(np.searchsorted(less, -j))
            here = at[:live] + j
            x = values[here]
            joins = np.abs(x - total[:live] / many[:live]) <= tolerance
            total[:live], many[:live] = np.where(joins, total[:live] + x, x), np.where(joins, many[:live] + 1, 1)
            opens[here[~joins]] = True
    own = np.cumsum(opens) - 1
    return own, np.bincount(own, weights=values) / np.bincount(own), group[opens]


def nearest(values: np.ndarray, own: np.ndarray, means: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Cluster with the nearest mean, the first of several: a number's own or one beside it in its group."""
    best, least = own.copy(), np.abs(means[own] - values)
    left = np.maximum(own - 1, 0)
    far = np.where((own > 0) & (group[left] == group[own]), np.abs(means[left] - values), np.inf)
    best, least = np.where(far <= least, left, best), np.minimum(far, least)
    right = np.minimum(own + 1, len(means) - 1)
    far = np.where((own + 1 < len(means)) & (group[right] == group[own]), np.abs(means[right] - values), np.inf)
    return np.where(far < least, right, best)


class Cells:
    """Cells of regions: arrays l, t, r, b (NaN without a place), chars (-1 without a text), flags, and what else is given."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__ |= arrays

    def take(self, at: np.ndarray) -> Cells:
        return Cells(**{k: v[at] for k, v in self.__dict__.items()})


def _gaps_before(group: np.ndarray, low: np.ndarray, high: np.ndarray, order: np.ndarray, least: float) -> np.ndarray:
    """How many blank bands of that width lie before the middle of each cell, in its region.  order: by region, low and high."""
    g, s, e = group[order], low[order], high[order]
    there = ~np.isnan(s)
    first = _starts(g)
    reach = _reach(first, np.where(there, e, -np.inf))
    with np.errstate(invalid="ignore"):
        gap = there & np.isfinite(reach) & (s - reach >= least)
    run = np.cumsum(gap)
    start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    before = np.where(there, run - run[start], 0)
    for i in np.flatnonzero(there & (e < s)):  # sides that are swapped: the middle may lie before bands that the start is behind
        a, z = start[i], np.searchsorted(g, g[i], "right")
        at = (reach[a:z] + s[a:z])[gap[a:z]] / 2
        before[i] = int((at < (s[i] + e[i]) / 2).sum())
    out = np.empty(len(group), np.int64)
    out[order] = before
    return out


def _by(group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """An order of cells, by group first."""
    return order[np.argsort(group[order], kind="stable")]


def _ordered(page: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """Order of cells by page and values; without a place first."""
    return np.lexsort((*[np.where(np.isnan(v), -np.inf, v) for v in values[::-1]], page))


def panels(c: Cells, s: Tables, gutter: float, band: float) -> np.ndarray:
    """Panel of each cell, numbered over all pages in order: pages cut at gutters or else at bands, in three rounds."""
    region = c.page.copy()
    across, down = _ordered(c.page, c.l, c.r), _ordered(c.page, c.t, c.b)
    live = np.ones(len(region), bool)
    for level in range(3):
        n = int(region.max(initial=-1)) + 1
        ready = np.bincount(region[live], minlength=n) >= s.min_cells
        a = _by(region, across[live[across]])
        if level:
            placed = a[~np.isnan(c.l[a])]
            ready &= np.bincount(clusters(region[placed], c.l[placed], s.column_x_tolerance)[2], minlength=n) >= 2
        live &= ready[region]
        if not live.any():
            break
        cells = np.flatnonzero(live)
        slot = np.empty(len(region), np.int64)
        slot[cells] = np.arange(len(cells))
        g, cut, part = region[cells], np.zeros(n, bool), np.zeros(len(cells), np.int64)
        for low, high, order, least in ((c.l, c.r, a, gutter), (c.t, c.b, None, band)):
            order = _by(region, down[live[down]]) if order is None else order[live[order]]
            p = _gaps_before(g, low[cells], high[cells], slot[order], least)
            most, fewest = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
            sorted_p, sorted_g = p[slot[order]], region[order]
            at = np.flatnonzero(_starts(sorted_g))
            most[sorted_g[at]], fewest[sorted_g[at]] = np.maximum.reduceat(sorted_p, at), np.minimum.reduceat(sorted_p, at)
            told = (most > fewest) & ~cut
            part = np.where(told[g], p, part)
            cut |= told
            if cut[g].all():
                break
        live &= cut[region]
        whole = np.zeros(len(region), np.int64)
        whole[cells] = part
        wide = int(whole.max(initial=0)) + 1
        seen = np.zeros(n * wide, bool)
        seen[region * wide + whole] = True
        region = (np.cumsum(seen) - 1)[region * wide + whole]
    return region


def unbannered(c: Cells, panel: np.ndarray, s: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Which cells are no banners, and for each how many banners of its panel lie above it."""
    n = int(panel.max(initial=-1)) + 1
    band, kept = np.zeros(len(panel), np.int64), np.ones(len(panel), bool)
    heading = (c.flags & HEADING) > 0
    if not heading.any():
        return kept, band
    some = np.zeros(n, bool)
    some[panel[heading]] = True
    at = np.flatnonzero(some[panel])
    at = at[np.lexsort((c.l[at], panel[at]))]
    placed = at[~np.isnan(c.l[at])]
    apt = (np.bincount(panel, minlength=n) >= s.min_cells) & (np.bincount(clusters(panel[placed], c.l[placed], s.column_x_tolerance)[2], minlength=n) >= 2)
    wide = np.fmax(_least(panel[at], c.r[at], n, np.fmax) - _least(panel[at], c.l[at], n, np.fmin), 0.001)
    own, all_ = c.r - c.l, wide[panel]
    banner = heading & apt[panel] & (own >= 0.25 * all_) & ((own >= 0.5 * all_) | ((c.flags & CAPITALS) > 0))
    kept = ~banner
    if banner.any():
        middle = (c.t + c.b) / 2
        marked = np.zeros(n, bool)
        marked[panel[banner]] = True
        cells = np.flatnonzero(marked[panel] & ~np.isnan(middle))
        cells = cells[np.lexsort((banner[cells], middle[cells], panel[cells]))]
        g = panel[cells]
        first = _starts(g)
        run = np.cumsum(banner[cells])
        start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        band[cells] = run - (run - banner[cells])[start]
    return kept, band


def score(c: Cells, region: np.ndarray, n: int, s: Tables, page_sized: bool) -> dict[str, np.ndarray]:
    """Scores of n regions, whose cells are sorted by region and left side, and what they rest on; -1 or NaN for none."""
    from .layout import HEADER_CHARS, LONG_CHARS, LONG_SHARE, MAX_YEARS, PAGE_HIGH, PAGE_WIDE, SHORT_CHARS, WIDE_CELL

    many = lambda where, weights=None: np.bincount(where, weights=weights, minlength=n)
    cells = many(region)
    wide = np.fmax(_least(region, c.r, n, np.fmax) - _least(region, c.l, n, np.fmin), 0.001)
    with np.errstate(invalid="ignore"):
        in_grid = c.r - c.l <= WIDE_CELL * wide[region]
    c, g = c.take(in_grid), region[in_grid]
    grid = many(g)
    share = lambda hits: many(g[hits]) / np.maximum(grid, 1)
    known, long_ = c.chars >= 0, c.chars > LONG_CHARS
    at = grid // 2
    long_median = (many(g[known & ~long_]) <= at) & (at < many(g[known]))
    short = np.where(grid > 0, share(known & (c.chars <= SHORT_CHARS)), np.nan)
    gt, gb = _least(g, c.t, n, np.fmin), _least(g, c.b, n, np.fmax)
    gh, gw = gb - gt, _least(g, c.r, n, np.fmax) - _least(g, c.l, n, np.fmin)
    prose, years = long_median | (share(long_) > LONG_SHARE), many(g[(c.flags & YEAR) > 0])
    own, means, of = clusters(g, c.l, s.column_x_tolerance)
    col = nearest(c.l, own, means, of)
    members = np.bincount(col, minlength=len(means))
    major = members[col] >= s.min_column_members
    c, g, col = c.take(major), g[major], col[major]
    columns = np.bincount(of[members >= s.min_column_members], minlength=n)
    middle = (c.t + c.b) / 2
    order = np.lexsort((middle, g))
    c, g, col, middle = c.take(order), g[order], col[order], middle[order]
    own, rows_at, row_of = clusters(g, middle, s.row_y_tolerance)
    row = nearest(middle, own, rows_at, row_of)
    here = np.bincount(row, minlength=len(rows_at))
    one = np.zeros(len(rows_at), np.int64)
    one[row] = col
    multi = np.zeros(len(rows_at), bool)
    multi[row[one[row] != col]] = True
    no = (rows_at[row] > gt[g] + 0.25 * np.fmax(gh[g], 0.001)) | (c.chars > HEADER_CHARS) | ((c.flags & HEADING) > 0)
    unknown = ~no & ((c.chars < 0) | ((c.flags & NO_HEADING) > 0))
    bad, told = np.bincount(row[no], minlength=len(rows_at)) > 0, np.bincount(row[~unknown], minlength=len(rows_at)) > 0
    is_row = here > 0
    heads, settled = multi & ~bad & told & is_row, (~multi | told) & is_row
    header = np.where(many(row_of[heads]) > 0, 1, np.where(many(row_of[settled]) > 0, 0, -1))
    in_col = np.maximum(members, 1)
    ratio = lambda hits: np.bincount(col[hits], minlength=len(means)) / in_col
    is_col = members >= s.min_column_members
    anchor = _least(of[is_col], ratio(multi[row])[is_col], n, np.fmax)
    values = many(of[is_col & (ratio((c.flags & VALUE) > 0) >= 0.6)])
    rows, aligned = many(row_of[is_row]), many(row_of[multi])
    with np.errstate(invalid="ignore"):
        why = [cells < s.min_cells, grid < s.min_cells, prose, years > MAX_YEARS, (gw > PAGE_WIDE) & (gh > PAGE_HIGH) & (not page_sized), columns < s.min_columns, aligned < s.min_aligned_rows]
        points = 0.3 + np.where(anchor >= 0.7, 0.2, np.where(anchor >= 0.5, 0.1, 0.0)) + np.where(values >= 1, 0.2, 0.0) + np.where(short >= 0.7, 0.1, 0.0) + np.where(header == 1, 0.1, 0.0) + np.where((columns >= 3) & (short >= 0.7), 0.1, 0.0)
    reject = np.select(why, range(len(why)), -1)
    none = columns == 0
    return {
        "score": np.where(reject >= 0, 0.0, np.round(np.minimum(points, 0.95), 3)), "reject": reject, "cells": cells, "grid_cells": np.where(grid > 0, grid, -1), "columns": np.where(none, -1, columns), "rows": np.where(none, -1, rows),
        "aligned_rows": np.where(none, -1, aligned), "anchor_alignment": anchor, "value_columns": np.where(none, -1, values), "short_cell_ratio": short, "header_row": np.where(none, -1, header),
    }


def _rects(c: Cells, region: np.ndarray, n: int) -> dict[str, np.ndarray]:
    return {k: _least(region, v, n, pick) for k, v, pick in zip(_RECT, (c.l, c.t, c.r, c.b), (np.fmin, np.fmin, np.fmax, np.fmax), strict=True)}


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of stretches, one behind the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _paired(c: Cells, start: np.ndarray, size: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[Cells, np.ndarray]:
    """Cells of pairs of regions, sorted by pair and left side, and the pair of each."""
    both = size[one] + size[two]
    at = _spread(np.ravel(np.column_stack((start[one], start[two]))), np.ravel(np.column_stack((size[one], size[two]))))
    pair = np.repeat(np.arange(len(one)), both)
    order = np.lexsort((c.l[at], pair))
    return c.take(at[order]), pair[order]


def merged(c: Cells, start: np.ndarray, size: np.ndarray, found: dict[str, np.ndarray], page: np.ndarray, s: Tables) -> dict[str, np.ndarray]:
    """Rejected regions side by side that make a table together: one, two and the pair's scores and rectangle; of pairs that share a
    region the first by left edges."""
    from .layout import MERGE_ANCHOR, MERGE_GAP, MERGE_OVERLAP

    loose = np.flatnonzero(found["score"] < s.score_threshold)
    loose = loose[_ordered(page[loose], found["rl"][loose])]
    g, (rl, rt, rr, rb) = page[loose], (found[k][loose] for k in _RECT)
    last = np.searchsorted(g, g, "right")
    many = np.maximum(last - np.arange(len(loose)) - 1, 0)
    kept: list[dict[str, np.ndarray]] = []
    pending = np.cumsum(many)
    a = 0
    while a < len(loose):
        z = max(a + 1, int(np.searchsorted(pending, (pending[a - 1] if a else 0) + PAIR_CELLS, "right")))
        i = np.repeat(np.arange(a, z), many[a:z])
        j = _spread(np.arange(a, z) + 1, many[a:z])
        with np.errstate(invalid="ignore"):
            gap, shared, low = rl[j] - rr[i], np.minimum(rb[i], rb[j]) - np.maximum(rt[i], rt[j]), np.minimum(rb[i] - rt[i], rb[j] - rt[j])
            near = (gap <= MERGE_GAP) & (gap >= -0.05) & (low > 0) & (shared >= MERGE_OVERLAP * low - 1e-9)
            near[near] &= shared[near] / low[near] >= MERGE_OVERLAP
        i, j = i[near], j[near]
        ends = np.cumsum(size[loose[i]] + size[loose[j]])
        p = 0
        while p < len(i):
            q = max(p + 1, int(np.searchsorted(ends, (ends[p - 1] if p else 0) + PAIR_CELLS, "right")))
            one, two = loose[i[p:q]], loose[j[p:q]]
            cells, pair = _paired(c, start, size, one, two)
            got = score(cells, pair, len(one), s, True)
            with np.errstate(invalid="ignore"):
                good = (got["score"] >= s.score_threshold) & (np.floor(got["anchor_alignment"] * 1000 + 0.5) / 1000 >= MERGE_ANCHOR) & (got["header_row"] == 1)
            if good.any():
                kept.append({k: v[good] for k, v in (got | _rects(cells, pair, len(one)) | {"one": one, "two": two}).items()})
            p = q
        a = z
    out = {k: np.concatenate([x[k] for x in kept]) if kept else np.zeros(0, np.int64) for k in (kept[0] if kept else (*found, "one", "two"))}
    used, taken = set(), np.zeros(len(out["one"]), bool)
    for i, (one, two) in enumerate(zip(out["one"].tolist(), out["two"].tolist(), strict=True)):
        if one not in used and two not in used:
            used |= {one, two}
            taken[i] = True
    return {k: v[taken] for k, v in out.items()}


def _column(kind: str, values: np.ndarray) -> pa.Array:
    if kind == "double":
        return pa.array(values.astype(float), from_pandas=True)
    if kind == "boolean":
        return pa.array(values == 1, mask=values < 0)
    return pa.array(values.astype(np.int32 if kind == "int" else np.int64), mask=values < 0)


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(x.split()) for x in schema.split(", ")]


def evaluator(keys: int, want: str, s: Tables) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of batches of cells (keys, nth, sides, chars, flags) that lie page by page: the accepted or rejected regions of the pages (SCORED
    behind the keys) or the members of both and of merged ones (MEMBERS)."""
    from .layout import PANEL_BAND, PANEL_GUTTER

    def of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        c = Cells(**{name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names) if i > keys})
        nowhere = np.isnan(c.l) | np.isnan(c.t) | np.isnan(c.r) | np.isnan(c.b)
        if nowhere.any():  # a place that lacks a side is none
            c.l, c.t, c.r, c.b = (np.where(nowhere, np.nan, x) for x in (c.l, c.t, c.r, c.b))
        first = batch.column(keys).to_numpy() == 0
        opening = np.flatnonzero(first)
        c.page = np.cumsum(first) - 1
        panel = panels(c, s, PANEL_GUTTER, PANEL_BAND)
        firsts = np.minimum.reduceat(panel, opening)
        batch = batch.select(range(keys)).take(pa.array(opening))
        kept, band = unbannered(c, panel, s)
        c, panel, band = c.take(kept), panel[kept], band[kept]
        if not len(panel):
            return None
        order = np.lexsort((c.l, panel * (int(band.max()) + 1) + band))
        c, panel, band = c.take(order), panel[order], band[order]
        first = _starts(panel) | _starts(band)
        at, region = np.flatnonzero(first), np.cumsum(first) - 1
        page, panel, band = c.page[at], panel[at] - firsts[c.page[at]], band[at]
        found = score(c, region, len(at), s, False) | _rects(c, region, len(at))
        sizes = np.diff(np.append(at, len(region)))
        if want == "rejected":
            picked = found["score"] < s.score_threshold
            table = {k: v[picked] for k, v in (found | {"page": page, "panel": panel, "band": band}).items()}
            none = np.full(len(table["page"]), -1)
            return _out(batch, SCORED, table | {"panel2": none, "band2": none, "rank": none})
        pairs = merged(c, at, sizes, found, page, s)
        if want == "members":
            cells, pair = _paired(c, at, sizes, pairs["one"].astype(int), pairs["two"].astype(int))
            one, two = pairs["one"].astype(int)[pair], pairs["two"].astype(int)[pair]
            none = np.full(len(region), -1)
            table = {"page": (c.page, cells.page), "panel": (panel[region], panel[one]), "band": (band[region], band[one]), "panel2": (none, panel[two]), "band2": (none, band[two]), "idx": (c.idx, cells.idx)}
            return _out(batch, MEMBERS, {k: np.concatenate(v) for k, v in table.items()})
        ok = found["score"] >= s.score_threshold
        one, two = pairs["one"].astype(int), pairs["two"].astype(int)
        none = np.full(int(ok.sum()), -1)
        table = {k: np.concatenate((v[ok], pairs[k])) for k, v in found.items()}
        table |= {"page": np.concatenate((page[ok], page[one])), "panel": np.concatenate((panel[ok], panel[one])), "band": np.concatenate((band[ok], band[one])), "panel2": np.concatenate((none, panel[two])), "band2": np.concatenate((none, band[two]))}
        order = np.lexsort((table["band2"], table["panel2"], table["band"], table["panel"], table["panel2"] >= 0, -table["score"], table["page"]))
        table = {k: v[order] for k, v in table.items()}
        place = np.arange(len(order))
        rank = place - np.maximum.accumulate(np.where(_starts(table["page"]), place, 0)) + 1 if len(order) else place
        return _out(batch, SCORED, table | {"rank": rank})

    def _out(batch: pa.RecordBatch, schema: str, table: dict[str, np.ndarray]) -> pa.RecordBatch:
        at = pa.array(table["page"].astype(np.int64))
        columns = [batch.column(i).take(at) for i in range(keys)]
        for name, kind in _fields(schema):
            if name == "reject":
                columns.append(pa.array(REJECTS.tolist()).take(pa.array(table[name].astype(np.int64), mask=table[name] < 0)))
            else:
                columns.append(_column(kind, table[name]))
        return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:keys], *[name for name, _ in _fields(schema)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            opening = np.flatnonzero(batch.column(keys).to_numpy() == 0)
            if len(opening) and sum(x.num_rows for x in held) + opening[-1] >= BATCH_CELLS:  # the last page may go on in the next batch
                yield from done([*held, batch.slice(0, opening[-1])])
                held, batch = [], batch.slice(opening[-1])
            held.append(batch)
        yield from done(held)

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sum(x.num_rows for x in held):
            out = of(pa.concat_batches(held))
            if out is not None and out.num_rows:
                yield out

    return run
