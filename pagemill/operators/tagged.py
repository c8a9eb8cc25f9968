"""Values of tagged documents: structure tree, parent tree, marked content of pages, and the candidates they make.

Reading the file itself is a source's business (and needs a library); from here on it is tables:
nodes (doc, key, tag, actual, colspan, rowspan), kids (doc, parent, child, ord; parent null for the roots), numbers (doc, node,
owner, entries) with tree (doc, parent, child) for the parent tree, and operators (doc, page, stream, seq, op, numbers, text, tag,
mcid, actual, ref) for content.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import paint as pt
from .settle import settle
from .visual import comparison_key

#: Version of the collector; operators that paint a path, that show text, and text modes that show nothing.
COLLECTOR_VERSION, SAME_PLACE = 1, 0.7
PAINTS, SHOWS, HIDDEN = ("f", "F", "f*", "B", "B*", "b", "b*", "S", "s", "sh"), ("Tj", "TJ", "'", '"'), (3, 7)


# --- structure ----------------------------------------------------------------------------------------------------


def structure(nodes: DataFrame, kids: DataFrame, most: int = 200) -> DataFrame:
    """(doc, key, tags, path, place, table_ref, row_ref, actual) of each node that the roots reach: a round a level.  A child that
    is on its own path already ends there, so a cycle does; the replacement text of a node holds for what is inside it."""
    inside = F.col("path")
    start = kids.where("parent is null").join(nodes, [kids["doc"] == nodes["doc"], kids["child"] == nodes["key"]]).select(
        nodes["doc"], "key", F.array("tag").alias("tags"), F.array("key").alias("path"), F.array("ord").alias("place"), F.when(F.col("tag") == "Table", F.col("key")).alias("table_ref"),
        F.lit(None).cast("string").alias("row_ref"), "actual",
    )
    level = settle(start, "structure")
    out = level
    for _ in range(most):
        below = kids.where("parent is not null").withColumnRenamed("parent", "up").select("doc", F.col("up").alias("above"), F.col("child").alias("key"), "ord")
        step = level.withColumnRenamed("key", "above").withColumnRenamed("actual", "given").join(below, ["doc", "above"]).where(~F.array_contains(inside, F.col("key")))
        met = step.join(nodes.select("doc", "key", "tag", "actual"), ["doc", "key"])
        # a row belongs to its table, a cell to its row; a table inside a cell starts anew
        row = F.when(F.col("tag") == "Table", None).when((F.col("tag") == "TR") & F.col("row_ref").isNull(), F.col("key")).otherwise(F.col("row_ref"))
        level = settle(
            met.select(
                "doc", "key", F.concat("tags", F.array("tag")).alias("tags"), F.concat("path", F.array("key")).alias("path"), F.concat("place", F.array("ord")).alias("place"),
                F.when(F.col("tag") == "Table", F.col("key")).otherwise(F.col("table_ref")).alias("table_ref"), row.alias("row_ref"), F.coalesce("actual", "given").alias("actual"),
            ), "structure",
        )
        if level.isEmpty():
            return out
        out = settle(out.unionByName(level), "structure")
    raise RuntimeError(f"structure deeper than {most} levels")


def nodes_with(found: DataFrame, tag: str) -> DataFrame:
    return found.where(F.element_at("tags", -1) == tag)


def _columns_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Logical row and column of a table's cells: a cell takes the next column that no cell of an earlier row reaches down to."""
    out, held = [], {}
    for row, cells in rows.sort_values(["row", "at"]).groupby("row", sort=True):
        column, down = 0, {c: n - 1 for c, n in held.items() if n > 1}
        for cell in cells.itertuples():
            while column in held:
                column += 1
            out.append((key[0], cell.key, key[1], int(row), column))
            for c in range(column, column + max(int(cell.colspan), 1)):
                if cell.rowspan > 1:
                    down[c] = max(down.get(c, 0), int(cell.rowspan) - 1)
            column += max(int(cell.colspan), 1)
        held = down
    return pd.DataFrame(out, columns=["doc", "key", "table_ref", "struct_row", "struct_col"])


def table_cells(found: DataFrame, nodes: DataFrame, kids: DataFrame) -> DataFrame:
    """(doc, key, table_ref, struct_row, struct_col) of every cell.  Rows of a table count in document order; a table is one group."""
    rows = nodes_with(found, "TR").where(F.col("row_ref") == F.col("key"))
    order = Window.partitionBy("doc", "table_ref").orderBy("place")
    rows = rows.select("doc", "table_ref", F.col("key").alias("row_ref"), (F.row_number().over(order) - 1).alias("row"))
    cells = found.where(F.element_at("tags", -1).isin("TD", "TH") & F.col("row_ref").isNotNull() & F.col("table_ref").isNotNull())
    direct = kids.select("doc", F.col("parent").alias("row_ref"), F.col("child").alias("key"), "ord")
    cells = cells.join(direct, ["doc", "row_ref", "key"], "left").join(rows, ["doc", "table_ref", "row_ref"]).join(nodes.select("doc", "key", "colspan", "rowspan"), ["doc", "key"])
    within = Window.partitionBy("doc", "table_ref", "row").orderBy(F.coalesce("ord", F.lit(pt.NEVER_LISTED)), F.element_at("tags", -1), "place")
    at = cells.select("doc", "table_ref", "key", "row", F.row_number().over(within).alias("at"), F.coalesce("colspan", F.lit(1)).alias("colspan"), F.coalesce("rowspan", F.lit(1)).alias("rowspan"))
    return at.groupBy("doc", "table_ref").applyInPandas(_columns_of, "doc string, key string, table_ref string, struct_row int, struct_col int")


def parent_tree(numbers: DataFrame, tree: DataFrame, most: int = 100) -> DataFrame:
    """(doc, owner, mcid, keys): the number tree walked from its root, its entries by place; null entries are none."""
    level = settle(tree.where("parent is null").select("doc", F.col("child").alias("node")), "numbers")
    reached = level
    for _ in range(most):
        level = settle(tree.select("doc", F.col("parent").alias("node"), "child").join(level, ["doc", "node"]).select("doc", F.col("child").alias("node")).distinct(), "numbers")
        level = settle(level.join(reached, ["doc", "node"], "left_anti"), "numbers")
        if level.isEmpty():
            break
        reached = settle(reached.unionByName(level), "numbers")
    else:
        raise RuntimeError(f"number tree deeper than {most} levels")
    flat = numbers.join(reached, ["doc", "node"], "left_semi").where("owner is not null").select("doc", "owner", F.posexplode("entries").alias("mcid", "key")).where("key is not null")
    return flat.groupBy("doc", "owner", "mcid").agg(F.array_sort(F.collect_list("key")).alias("keys"))


# --- content of a page --------------------------------------------------------------------------------------------


def _times(a: tuple, b: tuple) -> tuple:
    return (
        a[0] * b[0] + a[2] * b[1], a[1] * b[0] + a[3] * b[1], a[0] * b[2] + a[2] * b[3], a[1] * b[2] + a[3] * b[3], a[0] * b[4] + a[2] * b[5] + a[4], a[1] * b[4] + a[3] * b[5] + a[5],
    )


def _at(m: tuple, x: float, y: float) -> tuple[float, float]:
    return m[0] * x + m[2] * y + m[4], m[1] * x + m[3] * y + m[5]


@dataclass
class _Mark:
    """An open marked group and what was painted in it."""

    owner: int | None
    mcid: int | None
    tag: str
    actual: str | None
    boxes: list = field(default_factory=list)
    shown: list = field(default_factory=list)
    unknown: bool = False
    drawn: bool = False


class Page:
    """What a page's operators paint, group by group.  Operators are looked up by name; each takes its row."""

    def __init__(self, streams: dict[str, list], crop: tuple, turn: int):
        self.streams, self.crop, self.turn = streams, crop, turn
        self.open: list[_Mark] = []
        self.groups: list[_Mark] = []
        self.on = {
            "q": lambda r: self.saved.append(self.ctm), "Q": lambda r: self._restore(), "cm": lambda r: self._set("ctm", _times(self.ctm, tuple(r.numbers[:6]))), "BDC": self._begin, "BMC": self._begin,
            "EMC": lambda r: self._end(), "re": self._box, "n": lambda r: self.path.clear(), "BT": lambda r: self._home(pt.IDENTITY), "Tf": lambda r: self._set("size", max(abs(r.numbers[-1]), 1.0)),
            "Tm": lambda r: self._home(tuple(r.numbers[:6])), "Td": self._move, "TD": self._move, "T*": lambda r: self._line(0.0, -self.leading), "TL": lambda r: self._set("leading", r.numbers[0]),
            "Tr": lambda r: self._set("mode", int(r.numbers[0])), "Do": self._object, **{op: self._points for op in ("m", "l", "c", "v", "y")}, **{op: self._paint for op in PAINTS}, **{op: self._show for op in SHOWS},
        }
        self.need = {"cm": 6, "Tm": 6, "re": 4, "Td": 2, "TD": 2, "Tf": 1, "TL": 1, "Tr": 1, "m": 2, "l": 2, "c": 6, "v": 4, "y": 4}

    def run(self, stream: str, ctm: tuple, owner: int | None, above: tuple = ()) -> None:
        """One stream, and the forms that it draws; a form that draws itself is left out."""
        held = [getattr(self, k, None) for k in ("ctm", "saved", "path", "text", "line", "size", "leading", "mode", "owner", "above")]
        self.ctm, self.saved, self.path, self.text, self.line, self.size, self.leading, self.mode, self.owner, self.above = ctm, [], [], pt.IDENTITY, pt.IDENTITY, 1.0, 0.0, 0, owner, (*above, stream)
        depth = len(self.open)
        for row in self.streams.get(stream, ()):
            if row.op in self.on and len(row.numbers) >= self.need.get(row.op, 0):
                self.on[row.op](row)
        while len(self.open) > depth:  # groups that the stream never closes
            self._end()
        self.ctm, self.saved, self.path, self.text, self.line, self.size, self.leading, self.mode, self.owner, self.above = held

    def _set(self, name: str, value) -> None:
        setattr(self, name, value)

    def _restore(self) -> None:
        if self.saved:
            self.ctm = self.saved.pop()

    def _begin(self, r) -> None:
        marked = r.op == "BDC"
        self.open.append(_Mark(self.owner, None if not marked or r.mcid is None or pd.isna(r.mcid) else int(r.mcid), r.tag or "", r.actual if marked else None))
        if not marked:
            self.open[-1].owner = self.owner

    def _end(self) -> None:
        if self.open:
            self.groups.append(self.open.pop())

    def _points(self, r) -> None:
        self.path += [_at(self.ctm, x, y) for x, y in zip(r.numbers[::2], r.numbers[1::2], strict=False)]

    def _box(self, r) -> None:
        x, y, w, h = r.numbers[:4]
        self.path += [_at(self.ctm, *p) for p in ((x, y), (x + w, y), (x, y + h), (x + w, y + h))]

    def _home(self, m: tuple) -> None:
        self.text = self.line = m

    def _line(self, x: float, y: float) -> None:
        self._home(_times(self.line, (1.0, 0.0, 0.0, 1.0, x, y)))

    def _move(self, r) -> None:
        if r.op == "TD":
            self.leading = -r.numbers[1]
        self._line(*r.numbers[:2])

    def _on_page(self, points: list) -> tuple | None:
        """Bounding box of points as the page is shown, cut to it; null if nothing is left."""
        if not points:
            return None
        left, bottom, right, top = self.crop
        wide, high = max(right - left, 1e-9), max(top - bottom, 1e-9)
        turned = {90: lambda x, y: ((high - y) / high, x / wide), 180: lambda x, y: ((wide - x) / wide, (high - y) / high), 270: lambda x, y: (y / high, (wide - x) / wide)}
        at = [turned.get(self.turn, lambda x, y: (x / wide, y / high))(x - left, top - y) for x, y in points]
        xs, ys = [x for x, _ in at], [y for _, y in at]
        box = max(min(xs), 0.0), max(min(ys), 0.0), min(max(xs), 1.0), min(max(ys), 1.0)
        return box if box[2] > box[0] and box[3] > box[1] else None

    def _painted(self, points: list, *, text: bool = False, unknown: bool = False) -> bool:
        box = self._on_page(points)
        for mark in self.open:
            mark.unknown |= unknown
            if box:
                mark.boxes.append(box)
                mark.drawn |= not text
        return box is not None

    def _paint(self, r) -> None:
        self._painted(self.path, unknown=r.op == "sh" and not self.path)
        self.path = []

    def _show(self, r) -> None:
        text = r.text or ""
        wide = self.size * max(len(text), 1) * 0.5
        if self.mode not in HIDDEN:
            corners = [_at(self.ctm, *_at(self.text, x, y)) for x, y in ((0.0, 0.0), (wide, 0.0), (0.0, self.size), (wide, self.size))]
            if self._painted(corners, text=True):
                for mark in self.open:
                    mark.shown.append(text)
        self.text = _times(self.text, (1.0, 0.0, 0.0, 1.0, wide, 0.0))

    def _object(self, r) -> None:
        if r.tag == "Image":
            self._painted([_at(self.ctm, x, y) for x, y in ((0, 0), (1, 0), (0, 1), (1, 1))])
        elif r.tag == "Form":
            if r.ref not in self.above:
                form = tuple(r.numbers[:6]) if len(r.numbers) >= 6 else pt.IDENTITY
                self.run(r.ref, _times(self.ctm, form), self.owner if r.mcid is None or pd.isna(r.mcid) else int(r.mcid), self.above)
        else:
            self._painted([], unknown=True)


GROUPS = "doc string, page int, idx int, owner int, mcid int, tag string, actual string, rect array<double>, paint string, native boolean"


def marked_groups(operators: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, page, idx, owner, mcid, tag, actual, rect, paint, native) of every marked group, in the order they end.  A page's content
    is a program with a state, so it is one group; `native` says that the group shows text and nothing else.  pages: doc, page,
    crop (four numbers), turn and owner."""

    def walk(key: tuple, ops: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
        if not len(page):
            return pd.DataFrame(columns=[c.split()[0] for c in GROUPS.split(", ")])
        one = page.iloc[0]
        streams = {name: list(g.itertuples()) for name, g in ops.sort_values("seq").groupby("stream")}
        walker = Page(streams, tuple(one.crop), int(one.turn))
        walker.run("page", pt.IDENTITY, None if pd.isna(one.owner) else int(one.owner))
        rows = []
        for i, m in enumerate(walker.groups, 1):
            box = [min(b[0] for b in m.boxes), min(b[1] for b in m.boxes), max(b[2] for b in m.boxes), max(b[3] for b in m.boxes)] if m.boxes else None
            state = "visible" if m.boxes else "unknown" if m.unknown else "not_visible"
            rows.append((key[0], int(key[1]), i, m.owner, m.mcid, m.tag, m.actual, box, state, any(m.shown) and not m.drawn))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in GROUPS.split(", ")])
        return out.astype({"owner": "Int32", "mcid": "Int32"})

    return operators.groupBy("doc", "page").cogroup(pages.groupBy("doc", "page")).applyInPandas(walk, GROUPS)


# --- candidates ---------------------------------------------------------------------------------------------------


def tagged_candidates(groups: DataFrame, parents: DataFrame, found: DataFrame, cells: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """Candidates (doc, page, id, rect, ref, paint, confidence, codes, tags, table_ref, struct_row, struct_col, value) from marked groups
    with a replacement text of their own or of the element they belong to.  Groups that show nothing but text are left out:
    that is native.  Pages that could not be read (doc, page, reason) leave a row that proposes nothing."""
    met = groups.join(parents, ["doc", "owner", "mcid"], "left").withColumn("n", F.coalesce(F.size("keys"), F.lit(0))).withColumn("n", F.greatest("n", F.lit(0)))
    met = met.withColumn("key", F.when(F.col("n") == 1, F.get("keys", F.lit(0))))
    info = found.join(cells.drop("table_ref"), ["doc", "key"], "left").groupBy("doc", "key").agg(
        *[F.max_by(c, "place").alias(c) for c in ("tags", "table_ref", "struct_row", "struct_col")], F.max_by("actual", "place").alias("inherited")
    )
    met = met.join(info, ["doc", "key"], "left").withColumn("raw", F.coalesce("actual", "inherited")).where("raw is not null and not native")
    link = F.when(F.col("mcid").isNull(), "missing_mcid").when(F.col("n") == 1, "parent_tree_unique").when(F.col("n") > 1, "parent_tree_ambiguous").otherwise("parent_tree_unresolved")
    value = pt.actual_text(F.col("raw"))
    codes = F.array_compact(F.array(F.lit("marked_content"), link, F.when(F.col("struct_row").isNotNull(), "structure_cell"), F.concat(F.lit("paint_"), "paint"), F.when(value.isNull(), "empty_or_malformed_actual_text")))
    out = met.select(
        "doc", "page", F.format_string("vv%04d_%03d", "page", "idx").alias("id"), "rect", pt.source_ref(F.col("owner"), F.col("mcid"), F.coalesce("keys", F.array().cast("array<string>"))).alias("ref"), "paint",
        F.when(F.col("n") == 1, 1.0).alias("confidence"), codes.alias("codes"), "tags", "table_ref", "struct_row", "struct_col", value.alias("value"),
    )
    if unreadable is None:
        return out
    failed = unreadable.join(out.select("doc", "page").distinct(), ["doc", "page"], "left_anti")
    failed = failed.select("doc", "page", F.format_string("vv%04d_error", "page").alias("id"), F.lit("unknown").alias("paint"), F.array(F.lit("collector_error"), "reason").alias("codes"))
    return out.unionByName(failed, allowMissingColumns=True)


def merge_pictures(candidates: DataFrame, pictures: DataFrame) -> DataFrame:
    """Evidence (doc, page, id, picture, relation, value, new): a picture goes to the first candidate that it overlaps by 0.7; a symbol
    that meets none is a candidate of its own, or evidence of the first symbol that it overlaps.  Pictures meet candidates of
    their page only.  pictures: doc, page, picture, rect, kind, summary."""
    both = pictures.select("doc", "page", "picture", F.col("rect").alias("own"), "kind", "summary").join(candidates.select("doc", "page", "id", "rect"), ["doc", "page"])
    near = both.where(geo.overlap(F.col("rect"), F.col("own")) >= SAME_PLACE)
    first = near.withColumn("k", F.row_number().over(Window.partitionBy("doc", "page", "picture").orderBy("id"))).where("k = 1")
    relation = F.when(geo.iou(F.col("rect"), F.col("own")) >= SAME_PLACE, "coextensive").otherwise("component_overlap")
    met = first.select("doc", "page", "id", "picture", relation.alias("relation"), "summary", F.lit(False).alias("new"))
    rest = pictures.join(met, ["doc", "page", "picture"], "left_anti").where((F.col("kind") == "symbol") & (F.btrim("summary") != ""))
    pairs = rest.alias("a").join(rest.alias("b"), (F.col("a.doc") == F.col("b.doc")) & (F.col("a.page") == F.col("b.page")) & (F.col("b.picture") <= F.col("a.picture")))
    pairs = pairs.where((F.col("a.picture") == F.col("b.picture")) | (geo.overlap(F.col("a.rect"), F.col("b.rect")) >= SAME_PLACE))
    lead = pairs.groupBy(F.col("a.doc").alias("doc"), F.col("a.page").alias("page"), F.col("a.picture").alias("picture"), F.col("a.summary").alias("summary")).agg(F.min("b.picture").alias("lead"))
    number = F.dense_rank().over(Window.partitionBy("doc", "page").orderBy("lead"))
    fresh = lead.select("doc", "page", F.format_string("pv%04d_%03d", "page", number).alias("id"), "picture", F.lit("coextensive").alias("relation"), "summary", F.lit(True).alias("new"))
    return met.unionByName(fresh).withColumn("key", comparison_key("summary"))


def affected(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """(doc, table, id): tables that a candidate aims at or that its evidence names."""
    aimed = candidates.where("target is not null").select("doc", F.col("target").alias("table"), "id")
    return aimed.unionByName(evidence.select("doc", F.explode("tables").alias("table"), "id")).distinct()


def completeness(tables: DataFrame, candidates: DataFrame, links: DataFrame, mode: str) -> DataFrame:
    """(doc, table, status, mode, candidate_ids, represented, missing, unresolved, why) of each table from the resolutions (resolution,
    semantic, codes) of the candidates that affect it."""
    met = tables.join(links, ["doc", "table"], "left").join(candidates.select("doc", "id", "resolution", "semantic"), ["doc", "id"], "left")
    ids = lambda when: F.array_sort(F.collect_list(F.when(when, F.col("id"))))
    r = F.col("resolution")
    sums = met.groupBy("doc", "table").agg(
        ids(F.col("id").isNotNull()).alias("candidate_ids"), ids((r == "already_present") | (F.col("semantic") == "non_informational")).alias("represented"), ids(r == "trusted").alias("missing"),
        ids(r.isin("unresolved", "conflict")).alias("unresolved"),
    )
    broken = candidates.where(F.array_contains("codes", "collector_error")).select("doc", F.lit(True).alias("broken")).distinct()
    status = F.when(F.size("candidate_ids") == 0, "not_observed").when(F.size("missing") > 0, "incomplete").when(F.size("unresolved") > 0, "uncertain").otherwise("complete")
    why = (
        F.when((F.col("status") == "not_observed") & F.coalesce("broken", F.lit(False)), "collector_error").when(F.col("status") == "not_observed", "no_relevant_visual_candidates")
        .when(F.col("status") == "incomplete", "trusted_value_missing_from_grid").when(F.col("status") == "uncertain", "unresolved_visual_evidence").otherwise("all_observed_values_represented")
    )
    return sums.join(broken, "doc", "left").withColumn("status", status).withColumn("why", why).withColumn("mode", F.lit(mode)).drop("broken")


def audit_summary(tables: DataFrame) -> DataFrame:
    """(doc, statuses, tables): how many tables of a document have which status."""
    counts = tables.groupBy("doc", F.coalesce("status", F.lit("not_observed")).alias("status")).agg(F.count("*").alias("n"))
    return counts.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("statuses"), F.sum("n").alias("tables"))


def legacy_placed(candidates: DataFrame, assignments: DataFrame, evidence: DataFrame) -> DataFrame:
    """Candidates whose picture stands in exactly the cell they aim at: already present, if their tagged value (where there is one)
    is trusted and agrees.  candidates: doc, id, table, record, col, resolution, key; assignments: doc, table, picture, record, col."""
    met = candidates.join(evidence.select("doc", "id", "picture", F.col("key").alias("shown")), ["doc", "id"]).join(assignments, ["doc", "table", "picture", "record", "col"])
    good = met.where(F.col("resolution").isin("trusted", "unresolved", "") & (F.col("shown") != "") & (F.col("key").isNull() | ((F.col("resolution") == "trusted") & (F.col("key") == F.col("shown")))))
    present = good.groupBy("doc", "id").agg(F.min_by("shown", "picture").alias("shown"))
    return candidates.join(present, ["doc", "id"], "left").withColumn("resolution", F.when(F.col("shown").isNotNull(), "already_present").otherwise(F.col("resolution")))


def picture_index(ref) -> object:
    return F.nullif(F.regexp_extract(ref, r"^picture:(\d+)\z", 1), F.lit("")).cast("int")


def first_proposal(proposals, method: str, ref=None):
    """The first proposal of a method (and of a source) that has a value."""
    fits: Callable = lambda p: (p["method"] == method) & (F.coalesce(p["value"], F.lit("")) != "") & ((p["ref"] == ref) if ref is not None else F.lit(True))
    return F.get(F.filter(proposals, fits), F.lit(0))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Every double of a table rounded, in arrays, maps and structs too."""
    from pyspark.sql import types as T

    def of(c, kind):
        if isinstance(kind, T.DoubleType | T.FloatType):
            return F.round(c, places)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: of(x, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.transform_values(c, lambda _, x: of(x, kind.valueType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[of(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        return c

    return df.select(*[of(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
