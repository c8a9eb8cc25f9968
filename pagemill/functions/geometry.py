"""Rectangles as Columns: array [left, top, right, bottom], normalised to 0..1 with the origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(r: Column) -> Column:
    return F.greatest(F.lit(0.0), r[2] - r[0])


def height(r: Column) -> Column:
    return F.greatest(F.lit(0.0), r[3] - r[1])


def area(r: Column) -> Column:
    return width(r) * height(r)


def aspect(r: Column) -> Column:
    return width(r) / F.greatest(height(r), F.lit(0.001))


def centre_x(r: Column) -> Column:
    return (r[0] + r[2]) / 2


def centre_y(r: Column) -> Column:
    return (r[1] + r[3]) / 2


def distance(a: Column, b: Column) -> Column:
    """Between the centres; 999 where one is missing."""
    return F.coalesce(F.sqrt(F.pow(centre_x(a) - centre_x(b), 2) + F.pow(centre_y(a) - centre_y(b), 2)), F.lit(999.0))


def intersection(a: Column, b: Column) -> Column:
    wide, high = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def overlap(a: Column, b: Column) -> Column:
    """Intersection over the smaller area; 0 where that is empty."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    both = area(a) + area(b) - intersection(a, b)
    return F.when(both > 0, intersection(a, b) / both).otherwise(F.lit(0.0))


def contains_centre(outer: Column, inner: Column, slack: float = 0.002) -> Column:
    return centre_x(inner).between(outer[0] - slack, outer[2] + slack) & centre_y(inner).between(outer[1] - slack, outer[3] + slack)


def ordered(r: Column) -> Column:
    return F.array(F.least(r[0], r[2]), F.least(r[1], r[3]), F.greatest(r[0], r[2]), F.greatest(r[1], r[3]))


def from_points(l: Column, t: Column, r: Column, b: Column, page_w: Column, page_h: Column, bottom_left: Column) -> Column:
    """Points of a page to a normalised rectangle, rounded to 3 places; null without a place or on a page without size."""
    top, bottom = F.when(bottom_left, page_h - t).otherwise(t), F.when(bottom_left, page_h - b).otherwise(b)
    unit = lambda x, n: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x / n)), 3)
    there = l.isNotNull() & t.isNotNull() & r.isNotNull() & b.isNotNull()
    return F.when(there & (page_w > 0) & (page_h > 0), ordered(F.array(unit(l, page_w), unit(top, page_h), unit(r, page_w), unit(bottom, page_h))))


def to_pixels(r: Column, image_w: Column, image_h: Column) -> Column:
    """Whole pixels of an image; null where nothing is left."""
    px = F.array(*[F.bround(x * n).cast("int") for x, n in ((r[0], image_w), (r[1], image_h), (r[2], image_w), (r[3], image_h))])
    return F.when((px[2] > px[0]) & (px[3] > px[1]), px)


def area_ratio(l: Column, t: Column, r: Column, b: Column, page_w: Column, page_h: Column) -> Column:
    return F.least(F.lit(1.0), F.abs(r - l) * F.abs(b - t) / F.greatest(F.lit(1.0), page_w * page_h))


def cluster_means(values: Column, tolerance: float) -> Column:
    """Greedy clusters of sorted numbers, each compared with the running mean of the open cluster; the means in order.  A fold
    that carries count and sum of the open cluster."""
    start = F.struct(F.array().cast("array<double>").alias("done"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"))

    def step(a: Column, x: Column) -> Column:
        joins = (a["n"] > 0) & (F.abs(x - a["sum"] / F.greatest(a["n"], F.lit(1))) <= tolerance)
        closed = F.when((a["n"] > 0) & ~joins, F.concat(a["done"], F.array(a["sum"] / F.greatest(a["n"], F.lit(1))))).otherwise(a["done"])
        return F.struct(closed.alias("done"), F.when(joins, a["n"] + 1).otherwise(1).alias("n"), F.when(joins, a["sum"] + x).otherwise(x).alias("sum"))

    return F.aggregate(F.array_sort(values), start, step, lambda a: F.when(a["n"] > 0, F.concat(a["done"], F.array(a["sum"] / a["n"]))).otherwise(a["done"]))
