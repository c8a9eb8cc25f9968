"""Quality classifier by co-training.

Two views of a document: its words (hashed, presence weighted by length) and its page metadata (language, source,
length, and counts of kinds of characters, lines and words).  A classifier is trained on each view: a logistic one over words
that are scaled by how much more often they stand in one class, a linear discriminant over the numbers of the page.

Training starts from labelled documents.  In each of ROUNDS rounds Spark then scores all other documents by both views, whole
texts and all rows.  Documents that one view is sure of train the other: what goes back are sums over all of them (how
often each word stands in documents of a class; number, sums and products of the page's numbers), which is all that the
two fits need of them.  Their weight is that of the labelled documents at most, so classes keep their proportions.
Each view is calibrated on labelled documents that neither trained on (Platt scaling), and the sum of the calibrated
log odds over the prior scores all documents.

Labelled documents are a bounded, hashed sample: FIT of them (a quarter for calibration), which reach the driver.
The operator learns any 0/1 label; the query runs it for `quality` and for `toxic` over one pass of features.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Labelled documents used to fit; hashed words; rounds; weight of the documents a view labels, in that of the labelled; how sure it
#: must be of them; steps and strength of the logistic fit, strength of the linear one; pseudo-occurrences of a word.
FIT, WORDS, ROUNDS, GROW, SURE, STEPS, RIDGE, SHRINK, PSEUDO = 6000, 1 << 17, 2, 1.0, 0.95, 80, 3e-4, 1e-3, 10.0
KNOWN, CHUNK = 1 << 20, 512  #: words whose hash a task remembers, texts that are counted together
TASK = 8192  #: documents of a task that adds up, at least: its sums grow with its words, so tasks of few documents send more than they read
SLOTS = 64  #: hashed sources and languages


_MARKS = ".,;:!?\"'()[]{}<>*#$%&|=+-_/\\~^`@"
LENGTH = 0.25  #: power of a text's total weight that its words are divided by: long texts count less a word, not nothing


class _Slots(dict):
    """Hash of a lower-case word stripped of punctuation, remembered; it empties when it holds KNOWN words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN:
            self.clear()
        found = self[word] = zlib.crc32(word.lower().strip(_MARKS).encode("utf-8", "replace")) % WORDS
        return found


_slots = _Slots()


def words_view(texts: list[str]) -> Sparse:
    """Hashed lower-case words stripped of punctuation, and their weights (square-root counts, scaled by length).  Words of
    CHUNK texts are hashed, sorted and counted together."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(texts), CHUNK):
        split = [t.split() for t in texts[at : at + CHUNK]]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        slots = np.fromiter(map(_slots.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        keys, times = np.unique(np.repeat(np.arange(len(split)) * WORDS, sizes) + slots, return_counts=True)
        doc, weights = keys // WORDS, np.minimum(np.sqrt(times), 3)
        length = np.maximum(1.0, np.bincount(doc, weights**2, len(split))) ** LENGTH
        parts.append((keys % WORDS, weights / length[doc], np.bincount(doc, minlength=len(split))))
    ids, weights, many = (np.concatenate(x) if parts else np.empty(0) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    return Sparse(ids.astype(np.int64), weights, np.r_[0, np.cumsum(many)].astype(np.int64))


def meta_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Numbers about the page, about 0 to 1 each, and one-hot slots of language and source."""
    n, words = len(text), text.count(" ") + text.count("\n")
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8)[:8] / max(1, len(raw))
    lines = text.count("\n") + 1
    packed = len(zlib.compress(raw, 1)) / max(1, len(raw))  # how far the page repeats itself
    numbers = [math.log1p(n) / 12, n / (words + 1) / 20, math.log1p(lines) / 8, math.log1p(n / lines) / 10, packed, *(3 * np.sqrt(kinds))]
    out = np.zeros(len(numbers) + 2 * SLOTS)
    out[: len(numbers)] = numbers
    for at, value in ((0, lang), (SLOTS, source)):
        out[len(numbers) + at + (zlib.crc32(value.encode("utf-8", "replace")) % (SLOTS - 1) + 1 if value is not None else 0)] = 0.3
    return out


_KIND = np.zeros(256, np.int64)  # kinds of bytes
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" \t\r\n\f\v", 4), (b".,;:'\"()", 5), (b"!?", 6), (b"#$%&*|+=<>@[]^_`{}~\\/", 7)):
    _KIND[list(_chars)] = _kind
META = len(meta_view("", None, None))


@dataclass
class Sparse:
    """Rows of (id, weight), flattened."""

    ids: np.ndarray
    weights: np.ndarray
    starts: np.ndarray  # one more than rows

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        return cls(
            np.concatenate([i for i, _ in rows] or [np.empty(0, np.int64)]).astype(np.int64),
            np.concatenate([w for _, w in rows] or [np.empty(0)]).astype(np.float64),
            np.cumsum([0, *(len(i) for i, _ in rows)]),
        )

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(self.weights * w[self.ids])]
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.ids, self.weights * np.repeat(g, np.diff(self.starts)), minlength=size)

    def take(self, rows: np.ndarray) -> Sparse:
        return Sparse.of([(self.ids[self.starts[r] : self.starts[r + 1]], self.weights[self.starts[r] : self.starts[r + 1]]) for r in rows])


class Dense(np.ndarray):
    """Same interface over a matrix."""

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.asarray(self).T @ g

    def take(self, rows: np.ndarray) -> Dense:  # type: ignore[override]
        return np.asarray(self)[rows].view(Dense)


def _odds(x, w: np.ndarray) -> np.ndarray:
    return np.asarray(x.dot(w[:-1])) + w[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x, y: np.ndarray, size: int, steps: int = STEPS, rate: float = 0.1) -> np.ndarray:
    """Weights and a last one for the intercept, by Adam on all rows; classes weigh alike."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    each = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / max(1, len(y))
    for step in range(1, steps + 1):
        g = each * (_sigmoid(_odds(x, w)) - y)
        grad = np.r_[x.back(g, size) + RIDGE * w[:-1], g.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


@dataclass
class Evidence:
    """What documents of either class add up to: how many hold each word, how many there are (words view, page view), and sums and
    products of the page's numbers."""

    words: np.ndarray
    docs: np.ndarray
    pages: np.ndarray
    sums: np.ndarray
    products: np.ndarray

    @classmethod
    def shapes(cls) -> list[tuple[int, ...]]:
        return [(2, WORDS), (2,), (2,), (2, META), (2, META, META)]

    @classmethod
    def none(cls) -> Evidence:
        return cls(*map(np.zeros, cls.shapes()))

    @classmethod
    def of(cls, flat: np.ndarray) -> Evidence:
        cuts = np.cumsum([math.prod(x) for x in cls.shapes()])[:-1]
        return cls(*(x.reshape(k) for x, k in zip(np.split(flat, cuts), cls.shapes(), strict=True)))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.words, self.docs, self.pages, self.sums, self.products)])

    def add(self, words: Sparse, meta: np.ndarray, by_words: np.ndarray, by_pages: np.ndarray) -> None:
        """Add rows of class 0 or 1 (any other: left out) to either view's sums."""
        for c in (0, 1):
            self.words[c] += np.bincount(words.ids, np.repeat((by_words == c).astype(float), np.diff(words.starts)), minlength=WORDS)
            self.docs[c] += (by_words == c).sum()
            x = np.asarray(meta)[by_pages == c]
            self.pages[c] += len(x)
            self.sums[c] += x.sum(axis=0)
            self.products[c] += x.T @ x

    def with_more(self, other: Evidence) -> Evidence:
        """This and the other, whose classes weigh GROW times the classes here at most."""
        scale = lambda own, new: np.minimum(1.0, GROW * own / np.maximum(new, 1e-9))
        w, p = scale(self.docs, other.docs), scale(self.pages, other.pages)
        return Evidence(
            self.words + w[:, None] * other.words, self.docs + w * other.docs, self.pages + p * other.pages, self.sums + p[:, None] * other.sums, self.products + p[:, None, None] * other.products
        )


def fit_words(x: Sparse, y: np.ndarray, seen: Evidence) -> np.ndarray:
    """Logistic weights over words that are scaled first by how much more often they are seen in documents of class 1, as a log
    ratio: evidence of single words outweighs noise.  PSEUDO occurrences, shared out as the classes are, draw rare words to 0."""
    share = min(max(float(seen.docs[1] / max(seen.docs.sum(), 1e-9)) if seen.docs.sum() else 0.5, 1e-3), 1 - 1e-3)
    ratio = np.log((seen.words[1] / share + PSEUDO) / (seen.words[0] / (1 - share) + PSEUDO))
    w = fit_logistic(Sparse(x.ids, x.weights * ratio[x.ids], x.starts), y, WORDS)
    return np.r_[np.where(np.abs(ratio) > 1e-9, w[:-1] * ratio, 0.0), w[-1]]


def fit_pages(seen: Evidence) -> np.ndarray:
    """Weights and intercept of the linear discriminant between the two classes."""
    if not seen.pages.all():
        return np.zeros(META + 1)
    means = seen.sums / seen.pages[:, None]
    spread = sum(seen.products[c] - seen.pages[c] * np.outer(means[c], means[c]) for c in (0, 1)) / seen.pages.sum()
    w = np.linalg.solve(spread + SHRINK * np.eye(META), means[1] - means[0])
    return np.r_[w, -w @ (means[0] + means[1]) / 2]


def platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn a view's odds into log odds of the label, by Newton steps with smoothed targets."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x, w = np.c_[odds, np.ones(len(odds))], np.zeros(2)
    for _ in range(30):
        p = _sigmoid(x @ w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-4])
        w = w - np.linalg.solve(hess, x.T @ (p - target) + np.array([1e-2 * (w[0] - 1), 0]))
    return float(max(w[0], 0.0)), float(w[1])


@dataclass
class CoTrained:
    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float

    def score(self, words: Sparse, meta: Dense) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of the text view, of the metadata view, and of both."""
        a = self.text_scale[0] * _odds(words, self.text) + self.text_scale[1]
        b = self.meta_scale[0] * _odds(meta, self.meta) + self.meta_scale[1]
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


def sure_of(p: np.ndarray, prior: float) -> np.ndarray:
    """1 or 0 where the other class is left with less than a small part of its prior chance, else -1."""
    part = 2 * (1 - SURE)
    return np.where(1 - p <= part * (1 - prior), 1, np.where(p <= part * prior, 0, -1))


def gather(words: Sparse, meta: np.ndarray, model: CoTrained, into: Evidence) -> None:
    """Add documents that a view is sure of to what the other view learns from."""
    text, page, _ = model.score(words, meta)
    share = float(_sigmoid(np.array(model.prior)))
    into.add(words, meta, sure_of(page, share), sure_of(text, share))


def co_train(words: Sparse, meta: Dense, labels: dict[str, np.ndarray], gathered: Callable[[dict[str, CoTrained]], dict[str, Evidence]], *, rounds: int = ROUNDS) -> dict[str, CoTrained]:
    """A model of each target.  `labels` holds 1, 0 or -1 (none) for each row; every fourth labelled row is kept for calibration.
    `gathered` passes over the other documents and gives what each view is sure of."""

    def fit(y: np.ndarray, more: Evidence) -> CoTrained:
        labelled = np.flatnonzero(y >= 0)
        held = labelled[3::4] if len(labelled) >= 8 else labelled
        train = np.setdiff1d(labelled, held) if len(labelled) >= 8 else labelled
        known, x, page = Evidence.none(), words.take(train), np.asarray(meta)[train].reshape(-1, META)
        known.add(x, page, y[train], y[train])
        seen = known.with_more(more)
        views = {"text": (words, fit_words(x, y[train].astype(float), seen)), "meta": (meta, fit_pages(seen))}
        prior = math.log(max(y[held].sum(), 0.5) / max(len(held) - y[held].sum(), 0.5)) if len(held) else 0.0
        scales = {v: platt(_odds(x.take(held), w), y[held].astype(float)) if len(held) else (1.0, 0.0) for v, (x, w) in views.items()}
        return CoTrained(views["text"][1], views["meta"][1], scales["text"], scales["meta"], prior)

    models = {t: fit(y, Evidence.none()) for t, y in labels.items()}
    for _ in range(rounds):
        more = gathered(models)
        models = {t: fit(y, more[t]) for t, y in labels.items()}
    return models


def _views(texts, langs, sources) -> tuple[Sparse, Dense]:
    plain = [t or "" for t in texts]
    meta = np.array([meta_view(t, a, b) for t, a, b in zip(plain, langs, sources, strict=True)]).reshape(-1, META)
    return words_view(plain), meta.view(Dense)


def _bounded(df: DataFrame, wanted: int, rows: int) -> DataFrame:
    """About `wanted` rows by a hash of doc_id."""
    return df.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2**31)) < int(2**31 * min(1.0, wanted / max(rows, 1))))


def gather_documents(docs: DataFrame, models: dict[str, CoTrained]) -> dict[str, Evidence]:
    """What each view is sure of over all documents: every task adds up its own, Spark adds up the tasks by slot."""
    sent, length = docs.sparkSession.sparkContext.broadcast(models), len(Evidence.none().flat())  # of fixed size

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {t: Evidence.none() for t in sent.value}
        for batch in batches:
            words, meta = _views(*(batch[c].tolist() for c in ("text", "lang", "source")))
            for t, model in sent.value.items():
                gather(words, meta, model, found[t])
        flat = np.concatenate([e.flat() for e in found.values()])
        at = np.flatnonzero(flat)
        for i in range(0, len(at), 1 << 16):
            yield pd.DataFrame({"slot": at[i : i + (1 << 16)], "value": flat[at[i : i + (1 << 16)]]})

    sums = docs.select(*[F.col(c).cast("string") for c in ("text", "lang", "source")]).mapInPandas(summed, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros(length * len(models))
    flat[sums["slot"].to_numpy(np.int64)] = sums["value"].to_numpy(float)
    return dict(zip(models, map(Evidence.of, np.split(flat, len(models))), strict=True))


def fit_models(docs: DataFrame, labels: DataFrame, targets: tuple[str, ...], *, sample: int = FIT, rounds: int = ROUNDS) -> dict[str, CoTrained]:
    """A co-trained model of each target column of `labels`.

    Of several labels of a document the larger counts, null labels are none; of several documents under an id the
    least is taken for the label; ids that are null have no label.  Without labels there is nothing to learn."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(t).cast("int").alias(t) for t in targets])
    drawn = _bounded(known, sample, known.count())
    # labels of the sample go to the documents as a broadcast: about `sample` rows, whatever the input
    met = docs.select("doc_id", F.struct(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")]).alias("d")).join(F.broadcast(drawn), "doc_id")
    fitted = met.groupBy("doc_id").agg(F.min("d").alias("d"), *[F.first(t).alias(t) for t in targets]).select("doc_id", "d.*", *targets).toPandas().sort_values("doc_id").reset_index(drop=True)
    none = lambda s: s.astype(object).where(s.notna(), None)
    words, meta = _views(none(fitted["text"]), none(fitted["lang"]), none(fitted["source"]))
    y = {t: fitted[t].fillna(-1).to_numpy().astype(int) for t in targets}
    y = {t: np.where((x == 0) | (x == 1), x, -1) for t, x in y.items()}
    others = docs.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_anti")
    others = others.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(docs.count() / TASK)))
    return co_train(words, meta, y, lambda models: gather_documents(others, models), rounds=rounds if len(fitted) else 0)


def score_documents(docs: DataFrame, models: dict[str, CoTrained]) -> DataFrame:
    """doc_id and, for each target, text_<t>, meta_<t> and <t>: the calibrated views and their combination.

    A null text counts as an empty one; null language and source have slots of their own; a null id stays null; repeated
    rows get equal scores; other columns are ignored; an empty table stays empty.  Without labels everything scores one half.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)  # of fixed size
    names = [f"{p}{t}" for t in models for p in ("text_", "meta_", "")]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, langs, sources in batches:
            words, meta = _views(texts.tolist(), langs.tolist(), sources.tolist())
            yield pd.DataFrame(dict(zip(names, (p for m in sent.value.values() for p in m.score(words, meta)), strict=True)))

    found = score(*[F.col(c).cast("string") for c in ("text", "lang", "source")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), found.alias("s")).select("doc_id", "s.*")


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; `keep` where quality is likelier than not and toxicity is not."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, fit_models(docs, labels, ("quality", "toxic")))
    return scored.withColumn("keep", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))
