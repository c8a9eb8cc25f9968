"""Queries over all rows of their tables: against their SQL, and on small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pagemill import registry

from .test_queries import SF, TABLES, rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def same(spark, duck, name, sql):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.execute(sql).fetchdf()
    assert len(want) and sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.mark.parametrize("name", ["footnotes", "rule_boundaries", "layout_tables", "toc_detect", "toc_numbers", "axis_gaps", "page_blocks"])
def test_queries_read_whole_tables(spark, duck, name):
    same(spark, duck, name, registry.oracle_sql()[name])
    assert not __import__("re").search(r"% (?:10|50|40) |turn < 2|n <= 20", registry.oracle_sql()[name])


def test_grid_takes_every_line(spark, duck):
    got = registry.queries()["reconcile_grid"](spark, SF).select(F.explode(F.split("text", " ")).alias("text")).groupBy("text").count().toPandas()
    want = duck.execute("SELECT l_partkey::VARCHAR AS text, count(*) AS count FROM lineitem GROUP BY 1").fetchdf()
    assert rows(got) == rows(want)


def test_contents_pages_hold_every_part(spark, tmp_path):
    parts = [(k, f"part {k % 7}", "B") for k in range(1, 51)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    q = registry.queries()
    got = {r["t"]: (r["numbered"], r["toc"]) for r in q["toc_detect"](spark, str(tmp_path)).collect()}
    assert got == {"B": (20, True), "B (2)": (20, True), "B (3)": (10, True)}
    got = {(r["t"], r["pos"], r["line"]) for r in q["toc_numbers"](spark, str(tmp_path)).collect()}
    pages = ("B", "B (2)", "B (3)")
    assert got == {(pages[(k - 1) // 20], (k - 1) % 20 + 1, f"- 2.{(k - 1) % 20 + 1} {name} {k}") for k, name, _ in parts}


def test_gaps_are_those_of_all_rectangles(spark, tmp_path):
    # starts are twice the first component, widths the third and 0.01: 5 covers the gap between 0 and 41, nothing that between 41 and 7
    at = {0: (0.0, 0.05), 5: (0.02, 0.20), 41: (0.1, 0.05), 7: (0.3, 0.05)}
    spark.createDataFrame([(k, 1, [x, 0.0, w, 0.1]) for k, (x, w) in at.items()], "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [(r["label"], r["page"], r["gap"]) for r in registry.queries()["axis_gaps"](spark, str(tmp_path)).collect()]
    assert got == [(1, 0, pytest.approx((0.26 + 0.6) / 2, abs=1e-6))]


def test_blocks_keep_the_whole_text(spark, tmp_path):
    text = "word " * 150 + "end"
    spark.createDataFrame([(1, "http://h.org/", f"<h1>H</h1><p>{text}</p>")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["type"]: (r["text"], r["text_full"], r["n_chars"]) for r in registry.queries()["page_blocks"](spark, str(tmp_path)).collect()}
    assert got == {"section_header": ("H", "H", 1), "paragraph": (text[:500], text, len(text))}
