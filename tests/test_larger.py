"""Queries on tables that the smallest ones don't stand for: many rows under one key."""

import random
import re

import duckdb

from pagemill import registry

from .test_queries import rows


def same(spark, folder, name):
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}/*.parquet'")
    got, want = registry.queries()[name](spark, str(folder)).toPandas(), con.execute(registry.oracle_sql()[name]).fetchdf()
    assert len(want) and sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def suppliers(spark, folder, keys):
    data = [(k, f"Supplier#{k:09d}", nation, 1.0) for nation, of in keys.items() for k in of]
    spark.createDataFrame(data, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(str(folder / "supplier.parquet"))


def test_table_gates_of_many_suppliers(spark, tmp_path):
    suppliers(spark, tmp_path, {0: range(1, 61), 1: [123456, 123457, 123458], 2: [100, 101]})  # of 61 numbers one may be missing
    same(spark, tmp_path, "table_gates")


def test_grids_of_many_suppliers(spark, tmp_path):
    suppliers(spark, tmp_path, {0: range(300), 1: range(300, 600), 2: range(600, 921), 3: range(1000, 1003), 4: range(2000, 2002), 8: range(3000, 3240)})
    same(spark, tmp_path, "grid_reconciled")


def test_lost_lines_sends_no_table_to_the_driver(spark):
    plan = registry.queries()["lost_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_region_search_sends_no_table_to_the_driver(spark):
    plan = registry.queries()["region_search"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def documents(spark, folder, texts):
    spark.createDataFrame(list(texts), "doc_id long, text string").write.parquet(str(folder / "documents.parquet"))


def test_completeness_moves_each_line_once(spark):
    plan = registry.queries()["completeness"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 1 and "Join" not in plan


def test_completeness_of_odd_pages(spark, tmp_path):
    text = "# A heading with several words\n\n| 18% | 2.25 EUR |\n|---|---|\nplain words stand here together\n![x](y)\n2017\n6\nplain words stand here together"
    texts = {
        0: text, 1: text, 2: "here together stand other plain\nwords", 3: "--18% | 5", 4: "--18% | 5", 5: None, 6: "Dairy ingredients: 18% more", 7: "dairy ingredients\n\n18 more\nof", 8: "Dairy ingredients: 19% more",
        9: "", 10: "..., ,. ...word,. 1,5.", 11: "word 1.5 word", 20: "alone words stand apart", 30: " # café naïve résumé words\r\nnext line holds words", 31: "cafe naive words\r\nnext line holds words",
    }
    documents(spark, tmp_path, texts.items())
    same(spark, tmp_path, "completeness")


def test_a_page_without_a_key_has_no_body(spark, tmp_path):
    documents(spark, tmp_path, [(None, "words without any page"), (None, "words without any page")])
    assert [tuple(r) for r in registry.queries()["completeness"](spark, str(tmp_path)).collect()] == [(None, 0, "words without any page")] * 2


def test_completeness_of_long_pages(spark, tmp_path):
    rnd = random.Random(7)
    words = [f"w{i:03d}" for i in range(150)]
    page = [rnd.choices(words, k=rnd.randint(1, 9)) for _ in range(300)]
    changed = [[w if rnd.random() < 0.65 else rnd.choice(words) for w in rnd.sample(line, len(line))] for line in rnd.sample(page, len(page))]
    documents(spark, tmp_path, [(0, "\n".join(map(" ".join, page))), (1, "\n".join(map(" ".join, changed)))])
    same(spark, tmp_path, "completeness")
