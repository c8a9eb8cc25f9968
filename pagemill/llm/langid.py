"""Language ID by multilingual mixture inference.

A document is a mixture of languages: every letter trigram is drawn from one of them.  Expectation-maximisation
estimates the document's language proportions from the trigram likelihoods of each language, until they stand.  Languages
are ranked by the proportions of the full mixture; the sets of the first 1, 2, ... languages are fitted in turn and the
set with the best likelihood less PENALTY * log(trigrams) for each language wins.  The prediction is the largest proportion.

Letters of all scripts are told apart: a trigram is a hash of three code points, lower-cased, with runs of anything else
as one blank.  The likelihoods are learned from a bounded, hashed sample of labelled documents (SAMPLE a language, by
expectation).  Prediction is a map over whole texts without a shuffle; long texts are read in pieces of PIECE characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Labelled documents of a language that train it; bits of a trigram's hash; weight of an unseen trigram; penalty of a language;
#: change of a proportion that counts, steps after which expectation-maximisation ends all the same; characters in hand at once.
SAMPLE, BITS, UNSEEN, PENALTY, SETTLED, STEPS, PIECE = 1500, 18, 0.5, 3.0, 1e-3, 500, 1 << 20
_BLANK = 0
#: Odd factors of the hash.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    logs: np.ndarray  #: (trigrams, languages) log likelihoods, float32


def _symbols(text: str) -> np.ndarray:
    """Code point of each letter of a lower-cased text; runs of anything else as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.where(_letters()[points], points, _BLANK).astype(np.uint64)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != _BLANK) | (found[:-1] != _BLANK)
    return found[keep]


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed trigrams that hold a letter, and their counts."""
    size, held, counts = 1 << BITS, 0, np.empty(0, np.int64)
    parts: list[np.ndarray] = []
    a, b, c = map(np.uint64, _FACTORS)
    for at in range(0, max(len(text), 1), PIECE):
        s = _symbols(" " * (at == 0) + text[max(0, at - 2 * (at > 0)) : at + PIECE] + " " * (at + PIECE >= len(text)))
        mixed = (s[:-2] * a) ^ (s[1:-1] * b) ^ (s[2:] * c)
        grams = ((mixed ^ (mixed >> np.uint64(29))) * a >> np.uint64(64 - BITS)).astype(np.int64)
        parts.append(grams[(s[:-2] != _BLANK) | (s[1:-1] != _BLANK) | (s[2:] != _BLANK)])
        held += len(parts[-1])
        if held > size // 4:  # a long text: keep counts only
            new = np.bincount(np.concatenate(parts), minlength=size)
            counts, parts, held = (counts + new if len(counts) else new), [], 0
    if len(counts):
        counts = counts + np.bincount(np.concatenate(parts), minlength=size) if parts else counts
        ids = np.flatnonzero(counts)
        return ids, counts[ids]
    grams = np.concatenate(parts)
    grams.sort()
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, np.int64)
    return grams[first], np.diff(np.r_[first, len(grams)])


def _fit(likely: np.ndarray, counts: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each document.  Rows of `likely` are trigrams, documents are runs of rows
    from `starts`; `allowed` (documents, languages) says which languages may be used."""
    sizes = np.diff(np.r_[starts, len(counts)])
    shares, ones = allowed / allowed.sum(axis=1, keepdims=True), np.ones(likely.shape[1], likely.dtype)
    open_ = np.arange(len(starts))
    own, times, at, many = likely, counts, starts, sizes
    for _ in range(STEPS):
        joint = own * np.repeat(shares[open_], many, axis=0)
        gained = np.add.reduceat(joint * (times / (joint @ ones))[:, None], at, axis=0)
        now = gained / gained.sum(axis=1, keepdims=True)
        moving = np.abs(now - shares[open_]).max(axis=1) >= SETTLED
        shares[open_] = now
        if not moving.any():
            break
        if moving.mean() < 0.7:  # go on with the documents that still move
            rows = np.repeat(moving, many)
            own, times, open_, many = own[rows], times[rows], open_[moving], many[moving]
            at = np.cumsum(many) - many
    joint = (likely * np.repeat(shares, sizes, axis=0)) @ ones
    return shares, np.add.reduceat(np.log(joint) * counts, starts)


def infer(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and its proportion for each text; `und` and 0 for a null text or one without a letter."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    at, held, size = [], [], 0

    def settle() -> None:
        nonlocal at, held, size
        if at:
            counts = np.concatenate([c for _, c in held]).astype(np.float32)
            logs = model.logs[np.concatenate([g for g, _ in held])]
            likely = np.exp(logs - logs.max(axis=1, keepdims=True))  # a factor of a row cancels between sets
            starts = np.cumsum([0, *(len(g) for g, _ in held[:-1])])
            n, k = len(held), len(model.languages)
            total = np.add.reduceat(counts, starts)
            order = np.argsort(-_fit(likely, counts, starts, np.ones((n, k), np.float32))[0], axis=1, kind="stable")
            best, shares = np.full(n, -np.inf), np.zeros((n, k), np.float32)
            for m in range(1, k + 1):
                allowed = np.zeros((n, k), np.float32)
                np.put_along_axis(allowed, order[:, :m], 1, axis=1)
                allowed[allowed == 0] = 1e-30  # never exactly 0: a row's likelihoods may be 0 for all others
                got, fit = _fit(likely, counts, starts, allowed)
                fit = fit - PENALTY * m * np.log(total + 1)
                shares[fit > best] = got[fit > best]
                best = np.maximum(best, fit)
            for i, j, s in zip(at, shares.argmax(axis=1), shares.max(axis=1), strict=True):
                names[i], scores[i] = model.languages[j], float(min(1.0, max(0.0, s)))
        at, held, size = [], [], 0

    for i, text in enumerate(texts):
        if text:
            grams, counts = _trigrams(text)
            if len(grams):
                at.append(i)
                held.append((grams, counts))
                size += len(grams)
                if size > 100_000:
                    settle()
    settle()
    return names, scores


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, sample: int = SAMPLE) -> Model:
    """Trigram likelihoods of every label.  Takes about `sample` documents of each, by a hash of `key`; what reaches the
    driver are counts of hashed trigrams of that sample."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros((1 << BITS, 0), np.float32))
    draw = F.pmod(F.xxhash64(F.lit(6), key if key is not None else F.col(text_col)), F.lit(2**31)) / F.lit(float(2**31))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / counts[k]))])
    drawn = rows.where(draw < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                ids, n = (np.concatenate(x) for x in zip(*map(_trigrams, texts), strict=True))
                gram, place = np.unique(ids, return_inverse=True)
                yield pd.DataFrame({"lang": lang, "gram": gram, "n": np.bincount(place, n).astype(np.int64)})

    # a row for each language and hash at most
    table = drawn.mapInPandas(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    seen = np.full((1 << BITS, len(languages)), UNSEEN)
    seen[table["gram"].to_numpy(np.int64), table["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(np.int64)] += table["n"].to_numpy(float)
    return Model(languages, np.log(seen / seen.sum(axis=0)).astype(np.float32))


def predictor(model: Model):
    """Pandas UDF text -> struct(lang_pred, score).  The model goes out once, as a broadcast of fixed size
    (2^BITS trigrams by the number of languages)."""
    from pyspark.sql import SparkSession

    sent = SparkSession.getActiveSession().sparkContext.broadcast((model.languages, model.logs))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*sent.value)
        for texts in batches:
            if own.languages:
                names, scores = infer(texts.tolist(), own)
            else:
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict.asNondeterministic()  # else a filter on the result would run it twice


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """All rows and columns of `docs` with held_out, lang_pred and score appended (replacing columns of these names).

    Learns from rows whose crc32(doc_id as text) mod 4 is not 2 and whose text and lang are not null; predicts from
    the text alone.  A null text, or one without a letter, is `und` with score 0; so is everything if there is nothing
    to learn from.  A null doc_id is not held out.  Repeated rows get equal results; an empty table stays empty.
    """
    train = docs if train is None else train
    model = learn(train.where(~_held_out()), key=F.col("doc_id"))
    kept = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    found = docs.select(*kept, _held_out().alias("held_out"), predictor(model)(F.col("text").cast("string")).alias("_pm_found"))
    return found.select(*kept, "held_out", "_pm_found.lang_pred", "_pm_found.score")


def op6_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def stage_langid(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an undetermined language (no text, or no letter in it) go; a missing lang is filled in.  All columns of `docs`
    keep their values, whatever their names; repeated rows, long texts and empty tables as in `identify`."""
    model = learn(docs.where(~_held_out()), key=F.col("doc_id"))
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    rows = docs.select(kept, predictor(model)(F.col("text").cast("string")).alias("found")).where(F.col("found.lang_pred") != UNDETERMINED)
    lang = F.coalesce("kept.lang", "found.lang_pred").alias("lang")
    return rows.select(*[lang if c == "lang" else F.col(f"kept.`{c}`").alias(c) for c in docs.columns])
