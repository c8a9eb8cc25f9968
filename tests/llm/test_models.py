import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from pagemill.llm import hnsw, langid, packing, quality

from . import cases

SF = "/root/testdata/sf0.01"


# --- language ID ------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    got = langid.op6_langid(spark, SF).toPandas()
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_mixtures_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    by = {r["lang"]: r["text"] for r in docs.where("lang is not null and length(text) between 2000 and 4000").collect()}
    text = by["de"][:2000] + " " + by["es"][:1000]
    names, scores = langid.infer([text, by["fr"]], model)
    assert names == ["de", "fr"] and 0.5 < scores[0] < 0.85 and scores[1] > 0.95


def test_language_edge_cases(spark):
    got = langid.identify(cases.table(spark))
    assert Counter(got.columns) == Counter(cases.table(spark).columns)
    rows = got.collect()
    assert len(rows) == len(cases.rows())
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert langid.identify(cases.empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, "abc", None, "a", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    assert langid.identify(nothing).first()["lang_pred"] == "und"
    kept = langid.stage_langid(spark, cases.table(spark), "")
    assert kept.columns == cases.table(spark).columns and kept.where("lang is null").count() == 0


def test_stage_keeps_columns_of_any_name(spark):
    data = [(i, "the cat sat on the mat and " * 5, None, f"mine {i}", i, "x.y") for i in range(5)] + [(9, "42", None, "gone", 1, "z")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score string, held_out int, `a.b` string").withColumn("lang", __import__("pyspark").sql.functions.expr("if(doc_id = 0, 'en', null)"))
    got = {r["doc_id"]: (r["lang"], r["score"], r["held_out"], r["a.b"]) for r in langid.stage_langid(spark, df, "").collect()}
    assert got == {i: ("en", f"mine {i}", i, "x.y") for i in range(5)}


def test_ten_scripts_are_told_apart(spark):
    """Languages that share no letter, and two that share all of them: no alphabet is too large."""
    rng = np.random.default_rng(5)
    ranges = {"el": (0x3B1, 25), "ru": (0x430, 32), "hy": (0x561, 38), "he": (0x5D0, 27), "ar": (0x628, 30), "hi": (0x915, 36), "th": (0xE01, 46), "ka": (0x10D0, 33), "ko": (0xAC00, 5000), "zh": (0x4E00, 8000), "ja": (0x4E00, 8000)}
    words = {k: ["".join(chr(at + int(c)) for c in rng.integers(0, n, rng.integers(2, 6))) for _ in range(200)] for k, (at, n) in ranges.items()}

    def text(lang, n):
        return " ".join(words[lang][int(i)] for i in rng.integers(0, 200, n // 4))

    docs = [(i, text(lang, 300), lang, "s", 300) for i, lang in enumerate([*ranges] * 24)]
    got = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")).where("held_out").collect()
    truth = {d[0]: d[2] for d in docs}
    assert len(got) > 30 and all(r["lang_pred"] == truth[r["doc_id"]] for r in got)


def test_mixture_against_a_plain_fit():
    """Proportions and likelihoods of a whole batch are those of each document fitted alone, step by step."""
    rng = np.random.default_rng(3)
    sizes = [5, 40, 1, 200]
    likely, counts = rng.random((sum(sizes), 3)).astype(np.float64), rng.integers(1, 6, sum(sizes)).astype(float)
    starts = np.cumsum([0, *sizes[:-1]])
    shares, fits = langid._fit(likely, counts, starts, np.ones((4, 3)))
    for i, (a, n) in enumerate(zip(starts, sizes, strict=True)):
        p, own, times = np.full(3, 1 / 3), likely[a : a + n], counts[a : a + n]
        for _ in range(5000):
            joint = own * p
            p = (joint / joint.sum(axis=1, keepdims=True) * times[:, None]).sum(axis=0) / times.sum()
        best = (np.log((own * p).sum(axis=1)) * times).sum()
        assert best - 0.05 <= fits[i] <= best + 1e-6 and np.isclose(shares[i].sum(), 1)


def test_trigrams_against_a_plain_count(monkeypatch):
    text = "abc dEf, gh  ab Ωμέγα 漢字" * 300
    words = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    words = re.sub(" +", " ", words)
    plain = Counter(words[i : i + 3] for i in range(len(words) - 2) if words[i : i + 3].strip())
    ids, counts = langid._trigrams(text)
    assert sorted(counts.tolist()) == sorted(plain.values())  # these few trigrams do not collide
    whole = dict(zip(ids.tolist(), counts.tolist(), strict=True))
    monkeypatch.setattr(langid, "PIECE", 64)
    parts = dict(zip(*map(np.ndarray.tolist, langid._trigrams(text)), strict=True))
    assert sum(abs(whole.get(k, 0) - parts.get(k, 0)) for k in {*whole, *parts}) <= 0.02 * sum(whole.values())
    monkeypatch.setattr(langid, "PIECE", 1 << 20)
    long = text * 60
    got = dict(zip(*map(np.ndarray.tolist, langid._trigrams(long)), strict=True))
    assert all(abs(got[k] - 60 * v) <= 130 for k, v in whole.items())


# --- packing ----------------------------------------------------------------------------------------------------


def _check(got, texts, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_files()["json"])
    t.encode_special_tokens = True
    want = Counter()
    for d, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(d, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:])) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].to_numpy(object)) == want
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= capacity
    return got.sequence_id.nunique(), -(-int(got.length.sum()) // capacity)


def test_packing_round_trip(spark):
    texts = [(r[0], r[1]) for r in cases.rows()] + [(3000, "<|endoftext|> Ωμέγα 漢字 and more"), (3001, "don't  \n\n 12345 naïve ​ x")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = packing.pack(df).toPandas()
    used, bound = _check(got, texts, 2048)
    assert used <= bound + 1
    small = packing.pack(df, capacity=64, region=100, islands=3, epochs=3).toPandas()
    used, bound = _check(small, texts, 64)
    assert used <= 1.02 * bound + 6
    assert packing.pack(cases.empty(spark)).count() == 0


def test_both_encoders_agree(spark):
    e = packing.Encoder(packing.tokenizer_files())
    rng = np.random.default_rng(4)
    texts = [r[0] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", "don't 'LL x\u00a0y\u0085z ªº²³ ÿÀ\tß" * 3, *(f"a{chr(i)}b {chr(i)} {chr(i)}{chr(i)}1" for i in range(256)), *(bytes(rng.integers(0, 256, 300, np.uint8)).decode("latin-1") for _ in range(500))]
    fast = 0
    for t in texts:
        try:
            t.encode("latin-1")
        except UnicodeEncodeError:
            continue
        fast += 1
        assert e.ids(t).tolist() == e.slow.encode(t, add_special_tokens=False).ids
    assert fast > 1000


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100, 400).tolist()
    a, b = packing.Bins(sizes, 100), packing.Bins(sizes, 100)
    a.best_fit(list(range(400)))
    b.best_fit(list(range(0, 400, 2)))
    b.best_fit(list(range(1, 400, 2)))
    for _ in range(20):
        child = a.cross(b, 0.3, rng)
        child.dissolve(0.1, rng)
        assert sorted(i for x in child.items for i in x) == list(range(400))
        assert all(100 - sum(sizes[i] for i in x) == f >= 0 for x, f in zip(child.items, child.free, strict=True))
        a, b = child, a


def test_evolution_is_no_worse_than_best_fit():
    rng = np.random.default_rng(1)
    for sizes, capacity in (([int(x) for x in rng.choice([24, 27, 31, 34, 37, 41, 45], 600)], 100), ([int(x) for x in rng.gamma(1.2, 600, 4000).clip(1, 2047)], 2048)):
        plain, start = packing.Bins(sizes, capacity), packing.Bins(sizes, capacity)
        plain.best_fit(list(range(len(sizes))))
        start.best_fit(rng.permutation(len(sizes)).tolist(), largest_first=False)
        best = packing.evolve(sizes, capacity, [], 3, generations=12)
        assert best.generations == 12 and best.crossovers == 24
        used = len(set(best.numbers.tolist()))
        assert used < len(start.items) and used <= len(plain.items)


def test_every_region_evolves_and_rests_are_merged(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, "word " * int(n)) for i, n in enumerate(rng.gamma(1.2, 20, 1500))], "doc_id long, text string")
    got = packing.pack(df, capacity=96, region=200).toPandas()
    short = got[got.length < 96]
    assert short.generations.min() >= packing.GENERATIONS and short.crossovers.min() >= 2 * packing.GENERATIONS and got[got.length == 96].generations.isna().all()
    plain = packing.Bins(short.length.tolist(), 96)
    plain.best_fit(list(range(len(short))))
    assert short.sequence_id.nunique() <= len(plain.items) + 2
    fill = short.groupby("sequence_id").length.sum()
    assert (fill * 2 <= 96).sum() <= 1


# --- nearest neighbours -----------------------------------------------------------------------------------------


def _brute(vectors, k, every):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in ids:
        if q % every == 0:
            s = (x * np.array(vectors[q])).sum(axis=1)
            out[q] = [i for _, i in sorted((-v, i) for v, i in zip(s.tolist(), ids, strict=True) if i != q)][:k]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    data = {i: rng.normal(size=24).astype(np.float32).astype(float).tolist() for i in range(3000)}
    df = spark.createDataFrame([(i, v) for i, v in data.items()], "vec_id long, embedding array<float>")
    got = hnsw.nearest(df, shard=700).toPandas()
    want = _brute(data, 20, 20)
    found = {q: g.sort_values("rank").vec_id.tolist() for q, g in got.groupby("query_id")}
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert sum(len(set(found[q]) & set(want[q])) for q in want) / (20 * len(want)) >= 0.9
    for r in got.sample(50, random_state=0).itertuples():
        assert r.score == pytest.approx(float(np.dot(data[r.query_id], data[r.vec_id])), rel=1e-12, abs=1e-12)


def test_copies_ties_and_bad_vectors(spark):
    same = [1.0, 2.0, 3.0]
    data = [(i, same) for i in range(0, 3000, 3)] + [(i, [float(i % 7), 1.0, -float(i % 5)]) for i in range(1, 3000, 3)]
    data += [(0, same)] * 3 + [(20, [9.0, 9.0, 9.0]), (21, [9.0, 9.0, 9.0]), (21, [-1.0, 0.0, 0.0])]  # repeated rows, repeated ids
    bad = [(3020, None, "x"), (3040, [0.0, 0.0, 0.0], "x"), (3060, [1.0, None, 2.0], "x"), (3080, [1.0, float("nan"), 2.0], "x"), (3100, [], "x"), (3120, [float("inf"), 1.0, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x")]
    got = hnsw.nearest(spark.createDataFrame([(*r, "x") for r in data] + bad, "vec_id long, embedding array<float>, score string"), shard=50).toPandas()
    ids, x = np.array([i for i, _ in data]), np.array([v for _, v in data])
    want = Counter()
    for row in np.flatnonzero(ids % 20 == 0):
        s = x @ x[row]
        order = [j for j in np.lexsort((ids, -s)) if j != row][:20]
        want.update((int(ids[row]), rank, int(ids[j]), round(float(s[j]), 6)) for rank, j in enumerate(order, 1))
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got.itertuples()) == want


def test_scores_are_those_of_double_vectors(spark):
    rng = np.random.default_rng(7)
    data = {i: (rng.normal(size=8) * 10.0 ** rng.integers(-3, 4)).tolist() for i in range(400)} | {1000: [1e200] + [0.0] * 7, 1020: [1.0 + 1e-12] * 8, 1021: [1.0] * 8}
    got = hnsw.nearest(spark.createDataFrame(list(data.items()), "vec_id long, embedding array<double>")).toPandas()
    for r in got.itertuples():
        assert r.score == pytest.approx(float(np.dot(data[r.query_id], data[r.vec_id])), rel=1e-12)
    first = got[(got.query_id == 1020) & (got["rank"] == 1)].vec_id.tolist()
    assert first == [1000]


def test_routed_queries_find_their_neighbours(spark):
    """More cells than a query visits: recall stays, each query meets few shards, and short answers are filled up."""
    got = hnsw.nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), shard=256).toPandas()
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    want = _brute({r[0]: r[1] for r in rows if r[1] is not None and len(r[1])}, 20, 20)
    found = {q: set(g.vec_id) for q, g in got.groupby("query_id")}
    assert set(found) == set(want) and sum(len(found[q] & set(want[q])) for q in want) / (20 * len(want)) >= 0.9
    rng = np.random.default_rng(8)
    apart = [(i, (np.eye(40)[i % 40] * 50 + rng.normal(size=40)).tolist()) for i in range(4000)]
    few = hnsw.nearest(spark.createDataFrame(apart, "vec_id long, embedding array<double>"), shard=64, probes=1, k=150).toPandas()
    assert (few.groupby("query_id").size() == 150).all()


def test_cells_that_a_query_visits_are_measured():
    """Few where vectors lie in clusters, nearly all where they have no structure."""
    rng = np.random.default_rng(10)
    lifted = lambda x: hnsw.lift(x, 1.0, float((x**2).sum(axis=1).max()))
    clustered = lifted(np.repeat(rng.normal(size=(40, 32)), 100, axis=0) + 0.05 * rng.normal(size=(4000, 32)))
    loose = lifted(rng.normal(size=(4000, 32)))
    assert hnsw.visited(clustered, hnsw.centroids(clustered, 40), 20) <= 4
    assert hnsw.visited(loose, hnsw.centroids(loose, 40), 20) >= 20


def test_insertion_searches_the_graph(monkeypatch):
    """Candidates of an insertion come from walks over the graph so far; the links found are nearly those of a full comparison."""
    rng = np.random.default_rng(9)
    points = hnsw.lift(rng.normal(size=(3000, 16)), 1.0, 60.0)
    walks, walk = [], hnsw._walk
    monkeypatch.setattr(hnsw, "_walk", lambda points, *a: (walks.append(len(points)), walk(points, *a))[1])
    graph = hnsw.build(points)
    assert len(walks) > 3000 / hnsw.BATCH and max(walks) < 3000
    flat = graph["layers"][0][1]
    assert flat.shape == (3000, 2 * hnsw.LINKS) and (flat[:, 0] >= 0).all()
    gains = points @ points.T
    np.fill_diagonal(gains, -np.inf)
    nearest = gains.argmax(axis=1)
    assert np.mean([nearest[i] in flat[i] for i in range(3000)]) >= 0.9


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.1, 0.9]), (40, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    got = hnsw.nearest(df).toPandas()
    assert {q: g.sort_values("rank").vec_id.tolist() for q, g in got.groupby("query_id")} == {0: [20, 3], 20: [0, 3]}
    assert hnsw.nearest(df.limit(0)).count() == 0


# --- quality ----------------------------------------------------------------------------------------------------


def test_quality_on_labels_that_were_not_fitted(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit, held = labels.where("doc_id % 3 != 0"), labels.where("doc_id % 3 = 0")
    got = quality.score_documents(docs, quality.fit_models(docs, fit, ("quality", "toxic"))).join(held.withColumnsRenamed({"quality": "q", "toxic": "t"}), "doc_id").toPandas()
    assert ((got.quality >= 0.5) == (got.q == 1)).mean() >= 0.97
    assert ((got.toxic >= 0.5) == (got.t == 1)).mean() >= 0.97
    texts = docs.select("doc_id", "text").join(held, "doc_id").where("toxic = 1 and text rlike '(?i)(idiot|moron|clown|scum).*(idiot|moron|clown|scum)'").select("doc_id").toPandas()
    assert (got[got.doc_id.isin(texts.doc_id)].toxic >= 0.5).mean() >= 0.95
    for c in ("text_quality", "meta_quality", "quality"):
        assert got[c].between(0, 1).all()


def test_views_teach_each_other():
    """With few labels, what one view is sure of over all other documents carries over to the other."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    words = quality.Sparse.of([(np.unique([1 + c * 10 + int(rng.integers(5)), 500 + i % 50]), np.ones(2)) for i, c in enumerate(y)])
    meta = np.c_[y + rng.normal(0, 0.1, 600), np.zeros((600, quality.META - 1))].view(quality.Dense)
    known, pool = np.where(np.arange(600) < 24, y, -1), np.arange(24, 600)

    def gathered(models):
        e = quality.Evidence.none()
        quality.gather(words.take(pool), np.asarray(meta)[pool], models["t"], e)
        return {"t": e}

    alone = quality.co_train(words, meta, {"t": known}, gathered, rounds=0)["t"]
    model = quality.co_train(words, meta, {"t": known}, gathered)["t"]
    right = lambda m: [((p >= 0.5) == (y == 1))[24:].mean() for p in m.score(words, meta)]
    assert right(model)[2] >= 0.97 and right(model)[0] >= 0.9 and right(model)[0] >= right(alone)[0]


def test_all_documents_are_gathered(spark):
    """The sums that come back are those over every document outside the sample, as a plain pass gives them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    models = quality.fit_models(docs, labels, ("quality", "toxic"), rounds=0)
    rows = docs.select("text", "lang", "source").collect()
    got = quality.gather_documents(docs, models)
    words, meta = quality._views(*([r[i] for r in rows] for i in range(3)))
    for t, m in models.items():
        want = quality.Evidence.none()
        quality.gather(words, meta, m, want)
        assert np.allclose(got[t].flat(), want.flat(), atol=1e-6)
    assert got["quality"].docs.sum() + got["quality"].pages.sum() > len(rows) / 4


def test_scores_against_a_plain_pass(spark):
    """Scores of all documents are those of the fitted models, computed one document at a time."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    models = quality.fit_models(docs, labels, ("quality", "toxic"), rounds=1)
    got = {r["doc_id"]: r for r in quality.score_documents(docs, models).collect()}
    assert len(got) == docs.count()
    for r in docs.orderBy("doc_id").take(60):
        words, meta = quality._views([r["text"]], [r["lang"]], [r["source"]])
        for t, m in models.items():
            a, b, both = (float(x[0]) for x in m.score(words, meta))
            assert (got[r["doc_id"]][f"text_{t}"], got[r["doc_id"]][f"meta_{t}"], got[r["doc_id"]][t]) == pytest.approx((a, b, both))


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = cases.table(spark)
    got = quality.score_documents(docs, quality.fit_models(docs, labels, ("quality", "toxic")))
    assert got.count() == len(cases.rows()) and got.where("quality is null or isnan(quality)").count() == 0
    odd = spark.createDataFrame([(1, 0, None), (1, 1, 0), (2, None, None), (None, 1, 1), (3, 5, 0), *((10 + i, i % 2, 0) for i in range(30))], "doc_id long, quality int, toxic int")
    assert quality.score_documents(docs, quality.fit_models(docs, odd, ("quality", "toxic"))).where("toxic is null or isnan(toxic)").count() == 0
    none = quality.fit_models(docs, labels.limit(0), ("quality",))
    assert quality.score_documents(docs, none).where("abs(quality - 0.5) > 1e-9").count() == 0
    assert quality.score_documents(cases.empty(spark), none).count() == 0


# --- pipeline ---------------------------------------------------------------------------------------------------


def test_pipeline_runs_and_each_stage_acts(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert seen[0] >= seen[1] == seen[2] > 0 and seen[4] >= seen[3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_pipeline_stages_take_troubled_documents(spark):
    import corpus_pipeline

    for table in (cases.table(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, "")
            assert name == "packing" or out.columns == table.columns
            out.count()


def test_repeats_are_counted_by_group():
    groups = defaultdict(int)
    for r in cases.rows():
        groups[r[1]] += 1
    assert max(groups.values()) >= 40
