"""The near-duplicate stage finds its candidates by SimHash, and exactly what that leaves apart."""

import random

import numpy as np

from pagemill.llm import simhash


def _texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    near, far = [word() for _ in range(600)], [word() for _ in range(100)]
    texts = [near, [*near[:-1], word()], far, [*far[:92], *[word() for _ in range(8)]], [word() for _ in range(80)]]
    return [" ".join(x) for x in texts]


def _print(text):
    sets = simhash.shingle_set(text)
    return simhash.majority([sets], len(sets))


def _kept(spark):
    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.stage_dedup(spark, docs, "").collect())


def test_near_texts_meet_by_their_fingerprints(spark, monkeypatch):
    a, b, c, d, _ = map(_print, _texts())
    assert (a ^ b).bit_count() <= simhash.RADIUS < (c ^ d).bit_count()  # similar both, but only two are near
    assert _kept(spark) == [0, 2, 4]
    monkeypatch.setattr(simhash, "perhaps_similar_in", lambda sizes, bits, base: (np.empty(0, np.int64), np.empty(0, np.int64)))
    assert _kept(spark) == [0, 2, 3, 4]
