"""Page space of tagged documents as Columns: affine matrices, points and rectangles under crop and rotation, values of objects.

A matrix is an array of six doubles (a, b, c, d, e, f); a point is a struct of x and y."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geometry as geo
from . import text as tx
from .bind import bind

IDENTITY = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
NEVER_LISTED = 1_000_000  #: fixed value: order of a child that its parent does not list


def number(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def whole(value: Column) -> Column:
    return value.try_cast("int")


def name(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"^/+", "")


def object_key(number_: Column, generation: Column) -> Column:
    return F.concat_ws(":", number_, generation)


def source_ref(owner: Column, mcid: Column, entries: Column) -> Column:
    """Where a marked group comes from: owner, marked-content id, and the structure element if that is the only one."""
    one = F.when(F.size(entries) == 1, F.get(entries, F.lit(0))).otherwise("unresolved")
    or_none = lambda x: F.coalesce(x.cast("string"), F.lit("none"))
    return F.concat(F.lit("owner:"), or_none(owner), F.lit(";mcid:"), or_none(mcid), F.lit(";struct:"), one)


def matrix(values: Column) -> Column:
    """Six numbers, or the identity where there are fewer."""
    given = F.transform(F.slice(values, 1, 6), lambda x: number(x))
    return F.when(F.size(values) >= 6, given).otherwise(F.array(*map(F.lit, IDENTITY)))


def compose(outer: Column, inner: Column) -> Column:
    """First the inner matrix, then the outer one."""

    def product(x: Column) -> Column:
        a, b, c, d, e, f = (x["o"][i] for i in range(6))
        g, h, i, j, k, m = (x["i"][i] for i in range(6))
        return F.array(a * g + c * h, b * g + d * h, a * i + c * j, b * i + d * j, a * k + c * m + e, b * k + d * m + f)

    return bind(F.struct(outer.alias("o"), inner.alias("i")), product)


def translate(of: Column, tx: Column, ty: Column) -> Column:
    return compose(of, F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), tx, ty))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def apply(of: Column, p: Column) -> Column:
    moved = lambda v: point(v["m"][0] * v["p"]["x"] + v["m"][2] * v["p"]["y"] + v["m"][4], v["m"][1] * v["p"]["x"] + v["m"][3] * v["p"]["y"] + v["m"][5])
    return bind(F.struct(of.alias("m"), p.alias("p")), moved)


def points_rect(points: Column) -> Column:
    """Bounding box of points; null without any."""

    def box(all_: Column) -> Column:
        xs, ys = F.transform(all_, lambda p: p["x"]), F.transform(all_, lambda p: p["y"])
        return F.when(F.size(all_) > 0, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))

    return bind(points, box)


def rect_union(rects: Column) -> Column:
    """The rectangle around all that are not null; null without any."""
    some = F.filter(rects, lambda r: r.isNotNull())
    side = lambda i, pick: pick(F.transform(some, lambda r: r[i]))
    return F.when(F.size(some) > 0, F.array(side(0, F.array_min), side(1, F.array_min), side(2, F.array_max), side(3, F.array_max)))


def text_rect(ctm: Column, text_matrix: Column, size: Column, text: Column) -> Column:
    """About where a text stands: half the font size for each character."""
    width = size * F.greatest(F.length(text), F.lit(1)) * 0.5
    corners = F.array(*[point(x, y) for x, y in ((F.lit(0.0), F.lit(0.0)), (width, F.lit(0.0)), (F.lit(0.0), size), (width, size))])
    return points_rect(F.transform(corners, lambda p: apply(ctm, apply(text_matrix, p))))


def rotation(value: Column) -> Column:
    """Quarter turns of a page; anything else is none."""
    turn = F.coalesce(whole(value), F.lit(0))
    return F.when(turn % 90 == 0, F.pmod(turn, F.lit(360))).otherwise(0)


def crop(box: Column, page_w: Column, page_h: Column) -> Column:
    return F.when(F.size(box) >= 4, F.slice(box, 1, 4)).otherwise(F.array(F.lit(0.0), F.lit(0.0), page_w, page_h))


def point_to_page(p: Column, crop_box: Column, turn: Column) -> Column:
    """A point of page space (origin at the bottom left) in the page as it is shown, 0 to 1 from the top left."""

    def turned(v: Column) -> Column:
        box, at, by = v["box"], v["p"], v["turn"]
        wide, high = F.greatest(box[2] - box[0], F.lit(1e-9)), F.greatest(box[3] - box[1], F.lit(1e-9))
        ux, uy = at["x"] - box[0], box[3] - at["y"]
        return (
            F.when(by == 90, point((high - uy) / high, ux / wide)).when(by == 180, point((wide - ux) / wide, (high - uy) / high)).when(by == 270, point(uy / high, (wide - ux) / wide))
            .otherwise(point(ux / wide, uy / high))
        )

    return bind(F.struct(p.alias("p"), crop_box.alias("box"), turn.alias("turn")), turned)


def visible(r: Column) -> Column:
    """The part of a rectangle that is on the page; null if none is."""
    whole = lambda c: F.when((c[2] > c[0]) & (c[3] > c[1]), c)
    cut = lambda o: F.array(F.greatest(o[0], F.lit(0.0)), F.greatest(o[1], F.lit(0.0)), F.least(o[2], F.lit(1.0)), F.least(o[3], F.lit(1.0)))
    return bind(bind(geo.ordered(r), cut), whole)


def rect_to_page(r: Column, crop_box: Column, turn: Column) -> Column:
    corners = lambda o: F.array(point(o[0], o[1]), point(o[2], o[1]), point(o[0], o[3]), point(o[2], o[3]))
    return visible(points_rect(F.transform(bind(bind(r, geo.ordered), corners), lambda p: point_to_page(p, crop_box, turn))))


def box_rect(box: Column, page_w: Column, page_h: Column) -> Column:
    """A cell's box in points as a rectangle of the page, unrounded; null on a page without size."""
    bottom = F.contains(F.upper(F.replace(F.coalesce(box["origin"], F.lit("")), F.lit("_"), F.lit(""))), F.lit("BOTTOM"))
    top, low = F.when(bottom, page_h - box["b"]).otherwise(box["t"]), F.when(bottom, page_h - box["t"]).otherwise(box["b"])
    return F.when((page_w > 0) & (page_h > 0), geo.ordered(F.array(box["l"] / page_w, top / page_h, box["r"] / page_w, low / page_h)))


def decode(raw: Column) -> Column:
    """Text of a string of bytes: by its byte order mark, else UTF-8, big-endian UTF-16, or Latin-1, whichever reads."""
    head = F.hex(F.substring(raw, 1, 3))
    utf16 = F.startswith(head, F.lit("FFFE")) | F.startswith(head, F.lit("FEFF"))
    body = F.when(head == "EFBBBF", F.substring(raw, 4, 2**31 - 1)).otherwise(raw)
    even = F.octet_length(raw) % 2 == 0
    return F.when(raw.isNull(), None).when(utf16 & even, F.decode(raw, "UTF-16")).when(F.is_valid_utf8(body.cast("string")), body.cast("string")).when(even & _no_lone(raw), F.decode(raw, "UTF-16BE")).otherwise(F.decode(raw, "ISO-8859-1"))


def _no_lone(raw: Column) -> Column:
    """No half of a surrogate pair without the other, in big-endian units of two bytes."""
    units = F.regexp_extract_all(F.hex(raw), F.lit("(.{4})"), F.lit(1))
    high, low = (lambda u: F.rlike(u, F.lit("^D[89AB]"))), (lambda u: F.rlike(u, F.lit("^D[C-F]")))
    alone = F.transform(units, lambda u, i: (high(u) & ~F.coalesce(low(F.get(units, i + 1)), F.lit(False))) | (low(u) & ~F.coalesce(high(F.get(units, i - 1)), F.lit(False))))
    return ~F.exists(alone, lambda x: x)


def actual_text(text: Column) -> Column:
    """A replacement text as it is written out: no zeros at its end, white space collapsed; null if nothing is left.  Its letters
    come composed (see operators.visual.composed), for which the JVM has no function."""
    return F.nullif(tx.collapse_ws(F.regexp_replace(text, r"\x00+\z", "")), F.lit(""))


def paint_state(visible_paint: Column, unknown: Column) -> Column:
    return F.when(visible_paint, "visible").when(unknown, "unknown").otherwise("not_visible")
