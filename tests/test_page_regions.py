"""Regions of whole pages against the same rules step by step over tables of cells."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill import registry
from pagemill.config import Tables
from pagemill.operators import layout as lo
from pagemill.operators import page_regions as pr

TEXTS = ["12%", "1999", "2024", "label", "a longer label of a row", "prose " * 40, "GOALS OF THE YEAR", "A Heading of words", "TARGETS", "€ 3", None, "", " 5 m " + " " * 200]


def by_steps(cells):
    k = ["page"]
    panels = lo.split_at_banners(lo.segment(cells, "page"), "page", "panel")
    parts = panels.withColumn("region", F.format_string("r%04d-%04d", "panel", "band")).drop("panel", "band").localCheckpoint()
    scored = lo.region_scores(parts, "page", "region").localCheckpoint()
    rects = parts.groupBy("page", "region").agg(F.array(F.min("l"), F.min("t"), F.max("r"), F.max("b")).alias("rect"))
    scored = scored.join(rects, ["page", "region"])
    rejected = scored.where(F.col("score") < lo.TABLES.score_threshold)
    order = F.row_number().over(Window.partitionBy("page").orderBy(F.col("rect")[0], "region"))
    loose = rejected.select("page", "region", "rect", order.alias("at"))
    pairs = loose.alias("a").join(loose.select("page", F.col("region").alias("other"), F.col("rect").alias("orect"), F.col("at").alias("oat")), k).where((F.col("at") < F.col("oat")) & lo.adjacent(F.col("rect"), F.col("orect")))
    pairs = pairs.select("page", "region", "other", "at", "oat", F.concat_ws("+", "region", "other").alias("pair"))
    both = pairs.select("page", "pair", F.explode(F.array("region", "other")).alias("region")).join(parts, ["page", "region"]).drop("region")
    good = lo.region_scores(both, "page", "pair", page_sized=True).where((F.col("score") >= lo.TABLES.score_threshold) & (F.col("anchor_alignment") >= lo.MERGE_ANCHOR) & F.col("header_row")).localCheckpoint()
    found = pairs.join(good, ["page", "pair"])
    ordered = F.array_sort(F.collect_list(F.struct("at", "oat", "pair", "region", "other")))
    none = F.array().cast("array<string>")
    first = F.aggregate(
        ordered, F.struct(none.alias("used"), none.alias("taken")),
        lambda a, x: F.when(F.arrays_overlap(a["used"], F.array(x["region"], x["other"])), a).otherwise(F.struct(F.concat(a["used"], F.array(x["region"], x["other"])).alias("used"), F.concat(a["taken"], F.array(x["pair"])).alias("taken"))),
        lambda a: a["taken"],
    )
    taken = found.groupBy("page").agg(first.alias("taken")).select("page", F.explode("taken").alias("pair"))
    merged = good.join(taken, ["page", "pair"]).join(both.groupBy("page", "pair").agg(F.array(F.min("l"), F.min("t"), F.max("r"), F.max("b")).alias("rect")), ["page", "pair"])
    accepted = scored.where(F.col("score") >= lo.TABLES.score_threshold).withColumn("reason", F.lit("table_shaped_region")).unionByName(merged.withColumnRenamed("pair", "region").withColumn("reason", F.lit("merged_split_columns")))
    members = parts.select("page", "region", "idx").unionByName(both.join(taken, ["page", "pair"], "left_semi").select("page", F.col("pair").alias("region"), "idx"))
    rank = F.row_number().over(Window.partitionBy("page").orderBy(F.col("score").desc(), F.col("reason").desc(), "region"))
    return accepted.withColumn("rank", rank), rejected, members


def pages(seed, many):
    rng, rows = np.random.default_rng(seed), []
    for page in range(many):
        x, cells = 0.03, []
        for panel in range(int(rng.integers(1, 5))):
            cols, n, step, rough = int(rng.integers(1, 4)), int(rng.integers(1, 9)), rng.choice([0.04, 0.06, 0.09]), rng.choice([0, 0.004, 0.012])
            for r, c in np.ndindex(n, cols):
                if rng.random() < 0.93:
                    left, top, wide = x + c * 0.08 + rng.normal(0, rough), 0.05 + r * step + rng.normal(0, rough / 4), rng.choice([0.05, 0.07, 0.3], p=[0.5, 0.47, 0.03]) * (1 if rng.random() < 0.98 else -1)
                    text = "GOALS" if r == 0 and rng.random() < 0.5 else TEXTS[int(rng.integers(len(TEXTS)))] if rng.random() < 0.3 else ("label text", "12%", "€ 3")[(c + panel) % 3]
                    cells.append(([left, top, left + wide, top + 0.02], text, None if rng.random() < 0.02 else bool(rng.random() < 0.06)))
            if rng.random() < 0.4:
                top = 0.05 + step * rng.integers(0, n + 1)
                cells.append(([x, top, x + cols * 0.08 * rng.choice([0.3, 0.6, 1]), top + 0.02], TEXTS[int(rng.integers(6, 9))], True))
            x += cols * 0.08 + rng.choice([0.005, 0.02, 0.03, 0.06])
        if rng.random() < 0.1:
            cells.append((None, "no place", False))
        rows += [(page, i, None if rect is None else [float(v) for v in rect], text, heading) for i, (rect, text, heading) in enumerate(cells)]
    return rows


def test_regions_of_pages_are_those_of_single_steps(spark):
    cells = spark.createDataFrame(pages(3, 300), "page int, idx int, rect array<double>, text string, is_heading boolean").repartition(3).localCheckpoint()
    together = cells.groupBy("page").agg(F.collect_list(F.struct("idx", "rect", "text", "is_heading")).alias("cells"))
    for want, one, two in zip(by_steps(cells), lo.evaluate_regions(cells, "page"), lo.evaluate_pages(together, "page"), strict=True):
        assert one.dtypes == two.dtypes == want.dtypes
        rows = [sorted(map(repr, x.collect())) for x in (want, one, two)]
        assert len(rows[0]) > 100 and rows[0] == rows[1] == rows[2]
    assert {r["reason"] for r in lo.evaluate_regions(cells, "page")[0].collect()} == {"table_shaped_region", "merged_split_columns"}


def test_pages_go_on_in_the_next_batch(monkeypatch):
    rng = np.random.default_rng(1)
    size = rng.integers(1, 40, 60)
    n, nth = int(size.sum()), np.concatenate([np.arange(x) for x in size])
    l, t = rng.integers(0, 5, n) * 0.1, rng.integers(0, 8, n) * 0.05
    whole = pa.RecordBatch.from_pydict({"page": np.repeat(np.arange(60), size), "nth": nth, "l": l, "t": t, "r": l + 0.07, "b": t + 0.02, "chars": np.full(n, 4, np.int32), "flags": rng.choice([0, pr.VALUE], n).astype(np.int32)})
    run = lambda batches: pa.Table.from_batches(list(pr.evaluator(1, "accepted", Tables())(iter(batches)))).to_pylist()
    want = run([whole])
    for cells, step in ((1, 7), (50, 16), (10**6, 100)):
        monkeypatch.setattr(pr, "BATCH_CELLS", cells)
        assert run([whole.slice(i, step) for i in range(0, n, step)]) == want and len(want) > 10


def test_clusters_against_a_plain_loop():
    rng = np.random.default_rng(2)
    group = np.sort(rng.integers(0, 200, 3000))
    values = np.round(rng.random(3000) * 0.4, 3)
    values = values[np.lexsort((values, group))]
    own, means, of = pr.clusters(group, values, 0.02)
    want = []
    for g in np.unique(group):
        open_ = []
        for v in values[group == g].tolist():
            if open_ and abs(v - sum(open_) / len(open_)) > 0.02:
                want.append((g, sum(open_) / len(open_)))
                open_ = []
            open_.append(v)
        want.append((g, sum(open_) / len(open_)))
    assert np.allclose(means, [m for _, m in want], atol=1e-12) and of.tolist() == [g for g, _ in want] and (np.diff(own) >= 0).all()


def test_region_search_evaluates_a_page_once_where_it_is(spark):
    plan = registry.queries()["region_search"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and len(re.findall(r"\bExchange ", plan)) <= 5  # keys of pages four times, and their candidates
