"""Toxicity scores from class-conditional Kneser-Ney models.

Two character n-gram models, of toxic and of ordinary training documents,
give each word a log-likelihood in either class. A model's counts are the
numbers of documents that hold a word, less an absolute discount; the mass
taken from counts goes to a shared backoff, whose continuation counts come
from both classes. So an expression that is rare in a class says nothing for
or against it, and an inflected form that was never seen is judged by the
stem it shares with seen ones.

A word's log-likelihood ratio counts as far as it exceeds ``MARGIN``: the
small ratios that most words have by chance would drown a few strong ones in
a long text. A document's evidence is the mean excess per word
(length-normalised), with its greatest ratio, its sum and the length. A
logistic regression, fitted on training documents that the models have not
seen, turns it into a score between 0 and 1.

The classifier is fitted on a bounded sample of labelled rows: at most
``FIT_DOCUMENTS`` of each class, those with the smallest hash of their id.
The models of n-grams are bounded by that sample and are broadcast; every
document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Shared, crc32_mod

FIT_DOCUMENTS = 4000
#: Of the sampled documents, the part that the logistic regression is fitted on.
CALIBRATION = 4
ORDER = 7
DISCOUNT, BACKOFF_DISCOUNT = 3.0, 0.75
MARGIN, GREATEST = 3.0, 12.0
THRESHOLD = 0.7
_CACHE_WORDS = 400_000

words_of = re.compile(r"[^\W\d_]+").findall


def grams_of(word: str, order: int = ORDER) -> list[str]:
    """One n-gram per character and for the word's end, begun by its context."""
    s = f"^{word}$"
    return [s[max(0, i - order + 1):i + 1] for i in range(1, len(s))]


class Ratios:
    """log P(word | toxic) - log P(word | ordinary), from document counts of words by class.

    Both classes back off to the same distribution, so for an n-gram that
    neither class keeps the ratio is that of the backoff weights alone.
    """

    def __init__(self, words: dict[str, tuple[int, int]], order: int = ORDER, discount: float = DISCOUNT):
        self.order = order
        count: dict[str, list[int]] = {}
        for word, by_class in words.items():
            for g in grams_of(word, order):
                c = count.setdefault(g, [0, 0])
                c[0] += by_class[0]
                c[1] += by_class[1]
        shared = SharedBackoff(count)
        total: dict[str, list[float]] = {}  # of a context: n and what its n-grams keep, for both classes
        for g, c in count.items():
            t = total.setdefault(g[:-1], [0.0, 0.0, 0.0, 0.0])
            for k in (0, 1):
                t[k] += c[k]
                t[2 + k] += max(c[k] - discount, 0)
        weight = lambda t, k: (t[k] - t[2 + k]) / t[k] if t[k] else 1.0
        self.context = {h: math.log(weight(t, 1) / weight(t, 0)) for h, t in total.items() if t[2] or t[3]}
        self.gram = {}
        for g, c in count.items():
            if max(c) > discount:
                t, low = total[g[:-1]], shared.probability(g[1:])
                p = [(max(c[k] - discount, 0) / t[k] if t[k] else 0.0) + weight(t, k) * low for k in (0, 1)]
                self.gram[g] = math.log(p[1] / p[0])
        self._known: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}

    def of(self, word: str) -> float:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= _CACHE_WORDS:
                self._known.clear()
            gram, context, found = self.gram, self.context, 0.0
            for g in grams_of(word, self.order):
                r = gram.get(g)
                found += context.get(g[:-1], 0.0) if r is None else r
            self._known[word] = found
        return found

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        own = words_of((text or "").lower())
        ratios = np.array([self.of(w) for w in own] or [0.0])
        excess = np.maximum(ratios - MARGIN, 0)
        return (math.log(excess.mean() + 1e-3), min(float(ratios.max()), GREATEST), math.log1p(excess.sum()),
                math.log1p(len(own)))


class SharedBackoff:
    """Kneser-Ney distribution of a character after a shorter context, from
    the numbers of different n-grams that end so, in either class."""

    def __init__(self, grams):
        self.kinds: Counter[str] = Counter()
        seen, front = set(grams), set(grams)
        while front:
            shorter = Counter(g[1:] for g in front if len(g) > 1)
            self.kinds.update(shorter)
            front = set(shorter) - seen
            seen |= front
        self.total, self.types = Counter(), Counter()
        for g, n in self.kinds.items():
            self.total[g[:-1]] += n
            self.types[g[:-1]] += 1
        self.uniform = 1 / (len({g[-1] for g in seen}) + 1)

    def probability(self, gram: str) -> float:
        if not gram:
            return self.uniform
        low, total = self.probability(gram[1:]) if len(gram) > 1 else self.uniform, self.total[gram[:-1]]
        if not total:
            return low
        kept = max(self.kinds[gram] - BACKOFF_DISCOUNT, 0)
        return (kept + BACKOFF_DISCOUNT * self.types[gram[:-1]] * low) / total


class Classifier:
    """Features are held within the range on which the weights were fitted."""

    def __init__(self, ratios: Ratios | None, weights: np.ndarray | None, span: tuple | None, constant: float):
        self.ratios, self.weights, self.span, self.constant = ratios, weights, span, constant

    def scores(self, texts) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(texts), self.constant)
        x = np.clip(np.array([self.ratios.features(t) for t in texts]).reshape(-1, 4), *self.span)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and, last, the constant; Newton steps on standardised features."""
    mean, spread = x.mean(0), x.std(0) + 0.1
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    b = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        curve = z.T @ (z * (sample_weight * p * (1 - p))[:, None]) + ridge * np.eye(len(b))
        b += np.linalg.solve(curve, z.T @ ((y - p) * sample_weight) - ridge * b)
    w = b[:-1] / spread
    return np.append(w, b[-1] - w @ mean)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(crc32_mod(doc_id, 3) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Classifier:
    """A classifier from labelled documents that are not held out.

    Labels with a null id or a mark other than 0 and 1 are left out; an id
    marked more than once is toxic if one mark says so. Without documents of
    both classes the score is the share of toxic ones (0 without any).
    """
    spark = docs.sparkSession
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen, sizes = [], {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    for k in (0, 1):
        rank = F.xxhash64("doc_id")
        chosen += marks.where(F.col("toxic") == k).orderBy(rank, "doc_id").limit(fit_documents).select(
            "doc_id", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0).alias("calibrate")).collect()
    # At most 2 * fit_documents rows of an id and two marks.
    kind = marks.schema["doc_id"].dataType.simpleString()
    picked = spark.createDataFrame(chosen, f"id {kind}, toxic int, calibrate boolean")
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id")).drop("id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            by_class: list[Counter[str]] = [Counter(), Counter()]
            for text, toxic in zip(frame["text"], frame["toxic"]):
                by_class[toxic].update(set(words_of((text or "").lower())))
            for k, counts in enumerate(by_class):
                if counts:
                    yield pd.DataFrame({"word": list(counts), "toxic": k, "n": list(counts.values())})

    n = F.col("n")
    words = (sample.where(~F.col("calibrate")).mapInPandas(count, "word string, toxic int, n bigint").groupBy("word")
             .agg(F.sum(F.when(F.col("toxic") == 0, n).otherwise(0)).alias("ordinary"),
                  F.sum(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("toxic"))).toPandas()
    total = sum(sizes.values())
    constant = sizes.get(1, 0) / total if total else 0.0
    if not (words["ordinary"].sum() and words["toxic"].sum()):
        return Classifier(None, None, None, constant)
    ratios = Ratios(dict(zip(words["word"], zip(words["ordinary"].tolist(), words["toxic"].tolist()))))
    shared = Shared(spark, ratios)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(*shared.value.features(t), int(k)) for t, k in zip(frame["text"], frame["toxic"])]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "d", "toxic"])

    seen = sample.where("calibrate").mapInPandas(measure, "a double, b double, c double, d double, toxic int").toPandas()
    if seen["toxic"].nunique() < 2:
        return Classifier(None, None, None, constant)
    x, y = seen[["a", "b", "c", "d"]].to_numpy(), seen["toxic"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    share = {k: sizes[k] / total / (y == k).mean() for k in (0, 1)}
    return Classifier(ratios, fit_logistic(x[order], y[order], np.where(y[order] == 1, share[1], share[0])),
                      (x.min(0), x.max(0)), constant)


def score_column(text: str, classifier: Shared) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(classifier.value.scores(list(texts)), dtype="float64")

    return F.pandas_udf(run, "double")(F.col(text))


def score_documents(docs: DataFrame, classifier: Classifier, out: str = "toxicity", text_col: str = "text") -> DataFrame:
    """The documents with a score from 0 to 1 in column ``out`` (replaced if
    there). Null and empty texts are scored as texts without words; only the
    text is looked at."""
    return docs.withColumn(out, score_column(text_col, Shared(docs.sparkSession, classifier)))
