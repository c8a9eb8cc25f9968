"""Runs as a whole: the call, the command, states on disk, the client, prompts, settings, and operators that have no SQL."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill import api, cli, config, prompts
from pagemill.operators import client
from pagemill.operators import contracts as co
from pagemill.operators import model as mo
from pagemill.operators import prompt_map as pm
from pagemill.operators import reconcile as rc
from pagemill.operators import state as st
from pagemill.operators import tagged as tg

PAGES = [(i, f"http://a.org/{i}", f"<nav>Menu of the site</nav><h1>Title {i}</h1><p>The quick brown fox number {i} jumps over many lazy dogs.</p><footer>Contact page of a.org</footer>") for i in range(1, 6)]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "pages.parquet")
    spark.createDataFrame(PAGES, "page_id int, url string, html string").coalesce(1).write.parquet(path)
    return path


def test_run_writes_pages_and_a_record(spark, source, tmp_path):
    out = str(tmp_path / "out")
    assert api.run_extraction(spark, source, output_dir=out, end_page=4) == 0
    states, refused = st.load(spark, f"{out}/pages")
    rows = {r["page"]: r for r in states.collect()}
    assert set(rows) == {1, 2, 3, 4} and refused.count() == 0 and all(r["status"] == "completed" for r in rows.values())
    assert "quick brown fox number 2" in rows[2]["final_markdown"] and "Menu of the site" not in rows[2]["final_markdown"] and rows[2]["final_markdown"].startswith("# Title 2")
    assert [r["stage"] for r in rows[1]["stage_history"]] == ["prepare", "page_refine", "finalize"]
    record = spark.read.text(f"{out}/run").first()[0]
    assert spark.createDataFrame([(record,)], "p string").select(co.run_error(F.col("p")).alias("e")).first()["e"] is None
    assert json.loads(record)["selection"] == {"start_page": 1, "end_page": 4, "page_count": 4, "complete_document": True}
    assert spark.read.text(f"{out}/combined_final").count() > 4 and spark.read.json(f"{out}/blocks").count() >= 8
    # a replay keeps to the pages that are saved
    assert api.run_extraction(spark, source, output_dir=out, resume_from="page_refine") == 0
    assert {r["page"] for r in st.load(spark, f"{out}/pages")[0].select("page").collect()} == {1, 2, 3, 4}


def test_command(spark, source, tmp_path, capsys):
    (tmp_path / "c.yaml").write_text("models:\n  num_ctx: 99\nruntime:\n  start_page: 2\n")
    args = cli.parser().parse_args([source, "--config", str(tmp_path / "c.yaml"), "--num-ctx", "7", "--no-divider-reorder"])
    c = cli.settings(args, environment={"PAGEMILL_MODELS_NUM_CTX": "8", "PAGEMILL_MODELS_MODEL": "m"})
    assert (c.models.num_ctx, c.models.model, c.runtime.start_page, c.runtime.divider_reorder) == (7, "m", 2, False)
    assert cli.run([source, "--output-dir", str(tmp_path / "o"), "--shard", "--skip-vlm"], spark) == 0
    assert spark.read.json(str(tmp_path / "o" / "manifest_p0001-p0005")).count() == 5
    for bad in (["x.pdf"], [source, "--config", str(tmp_path / "none.yaml")], [source, "--prompt-file", str(tmp_path / "c.yaml")]):
        assert cli.run(bad, spark) == 1
    assert capsys.readouterr().err.count("error: ") == 3


def test_states_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("a.pdf", 5, p, p, 3, 200) for p in (1, 2, 3)], "pdf_name string, pdf_size int, page int, page_index int, total_pages int, dpi int")
    states = st.new_states(pages)
    st.save(states, str(tmp_path / "s"))
    st.save(states.where("page = 2").withColumn("status", F.lit("ready")), str(tmp_path / "s"))  # replaces its own page only
    got = {r["page"]: r["status"] for r in st.load(spark, str(tmp_path / "s"))[0].collect()}
    assert got == {1: "pending", 2: "ready", 3: "pending"}
    st.save(states.where("page = 3").withColumn("schema_version", F.lit(9)), str(tmp_path / "s"))
    good, refused = st.load(spark, str(tmp_path / "s"))
    assert good.count() == 2 and [r["page"] for r in refused.collect()] == [3]
    changed = st.synced(states, spark.createDataFrame([(1, "x", None)], "page int, raw_markdown string, failure string")).where("page = 1").first()
    assert changed["raw_markdown"] == "x" and changed["failure"] is None
    assert not st.write_run(states.limit(0), str(tmp_path / "none"), states.limit(0)) and not (tmp_path / "none").exists()


def test_client_talks_to_a_server(spark):
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.headers.get("Authorization"), body))
            code = 500 if len(seen) == 1 else 400 if "refuse" in body["messages"][0]["content"] else 200
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps({"message": {"content": "fine"}, "eval_count": 3, "done_reason": "stop"}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    ask = client.chat_client(url, "m", num_ctx=100, auto_num_ctx=True)()
    assert mo.ask(ask, "hello", lambda s: None) == ("fine", 2, None) and ask.usage["output_tokens"] == 3 and ask.usage["estimated"]
    assert seen[1][1]["options"]["num_ctx"] == 8192 and seen[1][1]["model"] == "m"
    with pytest.raises(RuntimeError, match="400"):
        ask("refuse this", b"png")
    assert seen[-1][1]["messages"][0]["images"] == ["cG5n"]
    server.shutdown()
    server.server_close()
    with pytest.raises(ConnectionError, match="127.0.0.1"):
        client.chat_client(url.replace("//", "//u:p@"), "m")()("x")
    assert client.headers({client.TOKEN: " t ", client.HEADERS: "a=b, c = d,x"}) == {"Content-Type": "application/json", "Authorization": "Bearer t", "a": "b", "c": "d"}
    assert client.ca_bundle("", "c", {}) == "c" and client.ca_bundle(environment={}) is None and client.redacted("https://u:p@h/x") == "https://h/x"
    assert client.context_size("x" * 8000, 8192, 1200, True) == 12288 and client.context_size("x", 8192, 0, False) == 8192


def test_prompts(tmp_path):
    for name, places in prompts.PLACES.items():
        text = prompts.load(name)
        assert prompts.places(text) == set(places)
        prompts.fill(text, **dict.fromkeys(places, "{x}"))
    own = tmp_path / "p.md"
    own.write_text("Do {source_markdown}")
    assert prompts.places(prompts.load("page_refine", own)) == set(prompts.PLACES["page_refine"])
    for bad in ("no place", "Do {source_markdown} {strange}", "Do {source_markdown} {"):
        own.write_text(bad)
        with pytest.raises(ValueError):
            prompts.load("page_refine", own)
    with pytest.raises(FileNotFoundError):
        prompts.load("nothing")
    for bad in ({"runtime": {"refine_mode": "never"}}, {"runtime": {"skip_vlm": "perhaps"}}, {"reading_order": {"band_gap": 2.0}}):
        with pytest.raises(ValueError):
            config.load(bad, environment={})


def test_content_of_forms_and_broken_streams(spark):
    """Forms draw in their own place and end what they leave open; a form that draws itself is drawn once; hidden text shows nothing."""
    one = lambda seq, stream, op, numbers=(), text=None, tag=None, mcid=None, actual=None, ref=None: ("d", 1, stream, seq, op, list(map(float, numbers)), text, tag, mcid, actual, ref)
    ops = [
        one(1, "page", "Do", (1, 0, 0, 1, 100, 100), tag="Form", ref="f", mcid=9), one(2, "page", "BDC", tag="Span", mcid=2, actual="hidden"), one(3, "page", "Tr", (3,)), one(4, "page", "Tj", text="x"), one(5, "page", "EMC"),
        one(6, "page", "BDC", tag="Fig", mcid=3, actual="image"), one(7, "page", "cm", (50, 0, 0, 50, 10, 10)), one(8, "page", "Do", tag="Image"), one(9, "page", "Do", tag="Strange"),
        one(1, "f", "BDC", tag="Span", mcid=1, actual="form"), one(2, "f", "re", (0, 0, 10, 10)), one(3, "f", "f"), one(4, "f", "Do", tag="Form", ref="f"),
    ]
    df = spark.createDataFrame(ops, "doc string, page int, stream string, seq int, op string, numbers array<double>, text string, tag string, mcid int, actual string, ref string")
    pages = spark.createDataFrame([("d", 1, [0.0, 0.0, 200.0, 200.0], 0, 7)], "doc string, page int, crop array<double>, turn int, owner int")
    got = {r["actual"]: r for r in tg.marked_groups(df, pages).collect()}
    assert got["form"]["owner"] == 9 and got["form"]["rect"] == pytest.approx([0.5, 0.45, 0.55, 0.5]) and got["form"]["paint"] == "visible"
    assert got["hidden"]["paint"] == "not_visible" and not got["hidden"]["native"] and got["hidden"]["owner"] == 7
    assert got["image"]["rect"] == pytest.approx([0.05, 0.7, 0.3, 0.95])


def test_pictures_meet_candidates(spark):
    c = spark.createDataFrame([("d", 1, "vv1", [0.1, 0.1, 0.2, 0.2])], "doc string, page int, id string, rect array<double>")
    p = spark.createDataFrame([("d", 1, 0, [0.1, 0.1, 0.2, 0.2], "symbol", "E1"), ("d", 1, 1, [0.1, 0.1, 0.12, 0.12], "symbol", "E2"), ("d", 1, 2, [0.5, 0.5, 0.6, 0.6], "symbol", "S1"), ("d", 1, 3, [0.5, 0.5, 0.6, 0.6], "symbol", "S2"), ("d", 1, 4, [0.8, 0.8, 0.9, 0.9], "chart", "no")],
                              "doc string, page int, picture int, rect array<double>, kind string, summary string")
    got = {r["picture"]: (r["id"], r["relation"], r["new"]) for r in tg.merge_pictures(c, p).collect()}
    assert got == {0: ("vv1", "coextensive", False), 1: ("vv1", "component_overlap", False), 2: ("pv0001_001", "coextensive", True), 3: ("pv0001_001", "coextensive", True)}


def test_visible_rules(spark):
    grey = np.full((200, 100), 255, np.uint8)
    grey[100, 10:90] = 0
    rules = spark.createDataFrame([(1, 0.5, 0.1, 0.9, 0.02), (1, 0.25, 0.1, 0.9, 0.02), (2, 0.5, 0.1, 0.9, 0.02)], "page int, y double, x0 double, x1 double, height double")
    pages = spark.createDataFrame([(1, 100, 200, bytearray(grey.tobytes()))], "page int, wide int, high int, grey binary")
    got = {(r["page"], r["y"]): r["seen"] for r in rc.visible_rules(rules, pages).collect()}
    assert got == {(1, 0.5): True, (1, 0.25): False, (2, 0.5): None}


def test_page_map(spark):
    from pagemill.functions import items as it

    box = lambda l, t: {"page_no": 1, "bbox": {"l": float(l), "t": float(t), "r": float(l) + 50, "b": float(t) + 10, "origin": "TOPLEFT"}}
    grid = [[{"text": "a", "column_header": True}, {"text": "b", "column_header": True}], [{"text": "a", "column_header": True}, {"text": "b", "column_header": False}], [{"text": "1"}, {"text": "b"}]]
    rows = [{"label": "Label.TITLE", "text": "Title", "prov": [box(10, 10)]}, {"label": "Label.TEXT", "text": "word " * 100, "prov": [box(400, 700)]}, {"label": "Label.TABLE", "prov": [box(10, 100)], "grid": grid}, {"label": "Label.LIST_ITEM", "text": "item", "marker": "·", "prov": [box(10, 200)]},
            {"label": "Label.PICTURE", "caption": "cap", "prov": [box(10, 300)]}, {"label": "Label.TEXT", "text": "lost 12 kg"}, {"label": "Label.TEXT", "text": "no place"}]
    df = spark.createDataFrame([("d", 1, rows)], f"doc string, page int, items array<{it.ITEM}>")
    items = it.items_of(it.assert_items(df).drop("page"), "doc").withColumn("page", F.lit(1))
    entries = pm.entries_of(items, F.lit(600.0), F.lit(800.0))
    found = pm.blocks(pm.in_context(entries, "doc", "page"), spark.createDataFrame([("d", 1, 4, 0, "E1")], "doc string, page int, pos int, picture_index int, value string"), "doc", "page")
    m = pm.page_map(found, "doc", "page")
    one = m.first()
    by = {b["id"]: b for b in one["blocks"]}
    assert list(by) == ["b0001", "b0002", "b0003", "b0004", "b0005", "b0006"] and one["layout_block_count"] == 6
    assert by["b0001"]["text"] == "Title" and by["b0002"]["text"] is None and by["b0003"]["headerless"] and by["b0003"]["first_row"] == ["a", "b"] and by["b0004"]["marker"] == "·"
    assert by["b0005"]["role"] == "table_symbol" and by["b0005"]["value"] == "E1" and by["b0006"]["text"] == "lost 12 kg"
    assert [r["id"] for r in pm.cells_of_map(m, "doc", "page").collect()] == ["b0001", "b0004"]
    text = m.select(pm.map_json(F.lit(600.0), F.lit(800.0)).alias("j")).first()["j"]
    assert json.loads(text)["page_size"] == [600.0, 800.0] and "role" not in json.loads(text)["blocks"][0]
    gone = pm.annotate(m, spark.createDataFrame([("d", 1, {0: ""})], "doc string, page int, values map<int,string>"), "doc", "page").first()
    assert gone["blocks"][4]["role"] is None
    cells = it.detection_cells(items, F.lit(600.0), F.lit(800.0)).collect()
    assert [c["id"] for c in cells] == ["b0001", "b0002", "b0004"]
    with pytest.raises(TypeError):
        it.assert_items(df.drop("items"))
