"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

The model has one weight for each feature and ordered thresholds: P(grade <= k) = logistic(threshold_k - score),
with the same score for all k. The expected severity is the sum of P(grade > k). A word's features are the word itself
and its first four and five letters; a feature's amount in a text is the percentage of the text's words that have it,
so the score says how dense a text is with telling words and not how long it is.

The labels say toxic or not. Grades of toxic texts for the fit, 1 to ``GRADES``, are cut at even shares of the toxic ones
by the share of their words that have a feature which the sample's counts alone (chi-square) tie to the label; no fitted
weight enters there. The fit reads the ``FIT_ROWS`` labelled documents with the smallest hash of their id, a
documented bound, and at most ``MOST_FEATURES`` features of them; every document is scored on its whole text, and no row
is shuffled for that.

Defined cases: a NULL or wordless text scores 0; a text of any length is one list of words in one task; repeated rows get
equal results; of several labels of one id the highest counts; labels that are NULL are not used; without both kinds of
labels all grades are 0; an empty table gives an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import keep

#: Labelled documents that the fit reads at most.
FIT_ROWS = 12_000
#: Grades of toxic texts; 0 is for the others.
GRADES = 3
#: A feature is used from this many texts of the sample on, and from this chi-square statistic on.
LEAST_TEXTS = 3
LEAST_CHI2 = 30.0
MOST_FEATURES = 4_000
#: Penalty on the squares of the weights, for each text.
RIDGE = 1e-5
STEPS = 400
#: Words whose weights a task remembers; features that it counts before it sends them on.
KNOWN_WORDS, HELD_FEATURES = 300_000, 500_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[str, ...]:
    """The features of a lower-case word: itself, and its beginnings where it is longer."""
    out = [word]
    out += [word[:n] + "*" for n in (4, 5) if len(word) > n]
    return tuple(out)


def word_counts(text: str | None) -> Counter:
    """How often each word of a text occurs, in lower case."""
    return Counter(_WORD.findall((text or "").lower()))


@dataclass
class Model:
    """Weights of features and rising thresholds between the grades; no thresholds where nothing was learnt."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def word_weight(self, word: str) -> float:
        """What a word adds to the score."""
        return sum(self.weights.get(f, 0.0) for f in word_features(word))

    def chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ... as columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - score[:, None], -50, 50)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, amounts: np.ndarray, n_columns: int, grades: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalized likelihood, by accelerated gradient steps (Adam).

    ``rows``, ``columns`` and ``amounts`` are the entries of the sparse design; several of one place add up.
    """
    n, top = len(grades), int(grades.max())
    shares = np.array([np.clip(np.mean(grades <= k), 1e-3, 1 - 1e-3) for k in range(top)])
    start = np.log(shares / (1 - shares))
    # The first threshold and the logarithms of the gaps, so that thresholds stay in order.
    free = np.concatenate((np.zeros(n_columns), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    moment, square = np.zeros_like(free), np.zeros_like(free)
    index = np.arange(n)
    for step in range(1, STEPS + 1):
        weights, gaps = free[:n_columns], np.exp(free[n_columns + 1 :])
        theta = free[n_columns] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(rows, weights[columns] * amounts, minlength=n)
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        upper, lower = _logistic(edges[grades + 1] - score), _logistic(edges[grades] - score)
        upper, lower = np.where(grades == top, 1.0, upper), np.where(grades == 0, 0.0, lower)
        p = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_score = (up - low) / n
        by_theta = np.zeros((n, top))
        has_up, has_low = grades < top, grades > 0
        by_theta[index[has_up], grades[has_up]] -= up[has_up] / n
        by_theta[index[has_low], grades[has_low] - 1] += low[has_low] / n
        by_theta = by_theta.sum(axis=0)
        tails = np.cumsum(by_theta[::-1])[::-1]
        slope = np.concatenate(
            (np.bincount(columns, by_score[rows] * amounts, minlength=n_columns) + RIDGE * weights, tails[:1], tails[1:] * gaps)
        )
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        free -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return free[:n_columns], free[n_columns] + np.concatenate(([0.0], np.cumsum(np.exp(free[n_columns + 1 :]))))


@dataclass
class Sample:
    """The texts that a model is fitted on, each with the numbers and amounts of its features."""

    names: list[str]
    places: list[list[int]]
    amounts: list[list[float]]
    shares: np.ndarray  # of each text's words, those with a feature that goes with toxic
    toxic: np.ndarray


def grade(sample: Sample, grades: int = GRADES) -> np.ndarray:
    """0 for texts that are not toxic; the others at even shares by how dense they are with telling words."""
    cuts = np.unique(np.quantile(sample.shares[sample.toxic], [k / grades for k in range(1, grades)]))
    graded = np.where(sample.toxic, 1 + np.searchsorted(cuts, sample.shares, side="left"), 0)
    return np.unique(graded, return_inverse=True)[1]


def fit(sample: Sample, grades: int = GRADES) -> Model:
    """The model for a sample."""
    if not len(sample.toxic) or sample.toxic.all() or not sample.toxic.any():
        return Model({}, np.zeros(0))
    rows = np.repeat(np.arange(len(sample.places)), [len(x) for x in sample.places])
    columns = np.array([c for x in sample.places for c in x], np.int64)
    amounts = np.array([a for x in sample.amounts for a in x], float)
    weights, thresholds = _fit_ordinal(rows, columns, amounts, len(sample.names), grade(sample, grades))
    return Model(dict(zip(sample.names, weights.tolist(), strict=True)), thresholds)


def sample_texts(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, toxic and text of the labelled documents with the smallest hashes of their ids, ``rows`` at most.

    Where an id repeats, one of its texts counts.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def telling_features(sample: DataFrame, most: int = MOST_FEATURES) -> DataFrame:
    """The features that go with one kind of label, by the chi-square statistic, ``most`` of them at most.

    ``bad`` says that it is toxic texts they go with.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task counts before it sends: how many of its texts, and of its toxic ones, have each feature.
        texts, toxic = Counter(), Counter()
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                found = {f for w in word_counts(text.as_py()) for f in word_features(w)}
                texts.update(found)
                if label:
                    toxic.update(found)
            if len(texts) > HELD_FEATURES:
                yield counted(texts, toxic)
                texts, toxic = Counter(), Counter()
        yield counted(texts, toxic)

    def counted(texts: Counter, toxic: Counter) -> pa.RecordBatch:
        names = list(texts)
        columns = [pa.array(names, pa.string())]
        columns += [pa.array([c[f] for f in names], pa.int64()) for c in (texts, toxic)]
        return pa.RecordBatch.from_arrays(columns, names=["feature", "b", "a"])

    partial = sample.select("toxic", "text").mapInArrow(split, "feature string, b long, a long")
    counts = partial.groupBy("feature").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = sizes["n"], sizes["bad"] or 0
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    spread = b * (n - b) * bad * (n - bad)
    chi2 = F.when(spread > 0, n * (a * n - b * bad) ** 2 / spread).otherwise(0.0)
    return (
        counts.withColumn("chi2", chi2)
        .where((F.col("b") >= min(LEAST_TEXTS, n)) & (F.col("chi2") >= min(LEAST_CHI2, n / 4)))
        .orderBy(F.desc("chi2"), "feature")
        .limit(most)
        .select("feature", (a * n > b * bad).alias("bad"))
    )


def amounts_of(counts: Counter, number: dict[str, int]) -> dict[int, float]:
    """The amount of each known feature in a text, as a percentage of its words."""
    total, found = sum(counts.values()), Counter()
    for word, n in counts.items():
        for feature in word_features(word):
            if feature in number:
                found[number[feature]] += n
    return {place: 100 * n / total for place, n in sorted(found.items())}


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """The model for a bounded sample; the driver gets at most ``rows`` times ``MOST_FEATURES`` amounts."""
    sample = keep(sample_texts(docs, labels, rows), "toxicity-sample")
    telling = sorted((r["feature"], r["bad"]) for r in telling_features(sample).collect())  # ``MOST_FEATURES`` at most
    names = [name for name, _ in telling]
    number, bad = {name: i for i, name in enumerate(names)}, {name for name, side in telling if side}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, amounts, shares = [], [], []
            for text in batch.column("text"):
                counts = word_counts(text.as_py())
                found = amounts_of(counts, number)
                places.append(list(found)), amounts.append(list(found.values()))
                marked = sum(n for w, n in counts.items() if not bad.isdisjoint(word_features(w)))
                shares.append(marked / max(1, sum(counts.values())))
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(places, pa.list_(pa.int32()))]
            columns += [pa.array(amounts, pa.list_(pa.float64())), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "places", "amounts", "share"])

    schema = "doc_id long, toxic int, places array<int>, amounts array<double>, share double"
    found = sample.select("doc_id", "toxic", "text").mapInArrow(measure, schema).orderBy("doc_id").collect()  # ``rows`` at most
    shares, toxic = np.array([r["share"] for r in found], float), np.array([bool(r["toxic"]) for r in found], bool)
    return fit(Sample(names, [r["places"] for r in found], [r["amounts"] for r in found], shares, toxic))


def text_score(counts: Counter, weight: Callable[[str], float]) -> float:
    """A text's score: its words' weights, each as a percentage of its words."""
    # Sorted, so that equal texts add up alike.
    return 100 * sum(sorted(w * n for word, n in counts.items() if (w := weight(word)))) / max(1, sum(counts.values()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (the likeliest grade), expected_severity, toxic_chance and toxic (chance of a half or more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, text in enumerate(batch.column("text")):
                counts = word_counts(text.as_py())
                if len(known) > KNOWN_WORDS:
                    known.clear()
                for word in set(counts).difference(known):
                    known[word] = model.word_weight(word)
                scores[row] = text_score(counts, known.__getitem__)
            if len(model.thresholds):
                above = model.chances(scores)
                each = -np.diff(np.hstack((np.ones((len(scores), 1)), above, np.zeros((len(scores), 1)))), axis=1)
                columns = [each.argmax(axis=1), above.sum(axis=1), above[:, 0], above[:, 0] >= 0.5]
            else:
                columns = [np.zeros(len(scores)), scores, scores, scores > 0]
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.bool_())
            arrays = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    names = ["doc_id", "severity", "expected_severity", "toxic_chance", "toxic"]
    schema = "doc_id long, severity int, expected_severity double, toxic_chance double, toxic boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
