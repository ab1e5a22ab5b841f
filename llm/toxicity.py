"""Severity of toxic language by cumulative-link ordinal regression.

Features are words (lower case, without punctuation at the ends) and word
beginnings, counted in the whole text.  For grades 0 to K - 1 the model is
P(grade <= k) = logistic(threshold_k - w . x): the weights w are shared by all
thresholds, and the thresholds are ordered.  The output is the expected grade.

Fitting uses at most ``most_rows`` labelled documents, those with the least
hash of their id, and at most ``most_features`` features; both bounds are
parameters.  Feature counts are summed by Spark; the driver gets the chosen
features' counts only.  Scoring is one pass over all whole texts without a
shuffle.

Null or empty text has no features, so it scores as a text without findings.
Labels that are null count as unlabelled; repeated labels of a document count
once, with the greatest value.  Without labels of both kinds, or without
labelled documents, nothing can be told: the model has no features and every
text scores as one without findings, grade 0.  An empty table to score gives
no rows.  Texts of any length are scored whole.  Other columns of the table
may have any name but severity, grade and toxic, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from llm.common import LONG, SLICE, STRING, apply_rows, documents, field, need

ENDS = ".,;:!?\"'()[]{}<>*#$%&|"
STEMS = (4, 5, 6)
GRADES = 4
MOST_ROWS, MOST_FEATURES = 20_000, 4_096
#: Least (toxic documents with the feature) x ln(ratio), to which twice the ln of the number of labelled documents
#: is added: the more documents, the more features are there, and the more of them are common by chance.
LEAST_EVIDENCE = 3
#: Marker words that make a labelled document grade 2 and 3.
GRADE_MARKERS = (3, 8)
#: Expected grade from which a document counts as toxic.
REJECT = 0.3
CACHE_WORDS = 200_000


def features(word: str) -> list[str]:
    """The word, and its beginnings of several lengths (marked by a final ^)."""
    word = word.strip(ENDS)
    return [word] * bool(word) + [word[:n] + "^" for n in STEMS if len(word) > n]


class Counter(dict):
    """From a word to its numbered features; remembers words."""

    def __init__(self, numbers: dict[str, int]) -> None:
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.numbers[f] for f in features(word) if f in self.numbers)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 100:
            self[word] = found
        return found

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of the text and how often each is found."""
        hits = [n for found in map(self.__getitem__, (text or "").lower().split()) if found for n in found]
        return np.unique(np.array(hits, np.int64), return_counts=True)


@dataclass(frozen=True)
class Model:
    numbers: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, score: float) -> np.ndarray:
        """P(grade <= k) for each threshold."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds - score, -40, 40)))

    def expected(self, score: float) -> float:
        """The mean grade: the sum over thresholds of P(grade > k)."""
        return float((1 - self.below(score)).sum())


def value(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def labelled(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """doc_id, text, toxic of at most ``most_rows`` labelled documents; that many ids are broadcast."""
    known = (
        need(labels, doc_id="long", toxic="int").where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    return documents(docs).join(F.broadcast(known), "doc_id")


def _feature_counts(rows: DataFrame) -> DataFrame:
    """feature, toxic (label), n: documents with the feature, summed per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter as Tally

        tally: Tally = Tally()

        def give() -> pa.RecordBatch:
            found = list(tally)
            return pa.RecordBatch.from_arrays([
                pa.array([f for f, _ in found], pa.string()), pa.array([t for _, t in found], pa.int64()),
                pa.array([tally[f] for f in found], pa.int64())], names=["feature", "toxic", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    tally.update((f, toxic) for f in {f for w in set((text or "").lower().split()) for f in features(w)})
                if len(tally) > 200_000:
                    yield give()
                    tally.clear()
        yield give()

    schema = StructType([field("feature", STRING), field("toxic", LONG), field("n", LONG)])
    return rows.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_features: int = MOST_FEATURES) -> Model:
    """Fits on labels 0 and 1, with the grade of a toxic document by its number of marker words.

    A marker is a feature that is ten times as common, at least, in toxic
    documents as in others.  Grade 0 is not toxic; 1, 2 and 3 have fewer than
    GRADE_MARKERS[0], fewer than GRADE_MARKERS[1], and more markers.
    """
    rows = labelled(docs, labels, most_rows)
    totals = {row.toxic: row.n for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model({}, np.zeros(0), np.full(GRADES - 1, np.inf))
    toxic, clean = F.col("toxic_docs"), F.col("clean_docs")
    counted = (
        _feature_counts(rows).groupBy("feature")
        .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic_docs"),
             F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean_docs"))
        .withColumn("ratio", ((toxic + 0.5) / (totals[1] + 1)) / ((clean + 0.5) / (totals[0] + 1)))
        .withColumn("evidence", toxic * F.log("ratio"))
        .where((F.col("evidence") >= LEAST_EVIDENCE + 2 * math.log(sum(totals.values()))) & (F.col("ratio") >= 3))
        .orderBy(F.desc("evidence"), "feature").limit(most_features)
        .select("feature", "ratio").collect()
    )
    numbers = {row.feature: k for k, row in enumerate(counted)}
    markers = np.array([row.ratio >= 10 and not row.feature.endswith("^") for row in counted], bool)

    def make():
        counter = Counter(numbers)

        def found(texts):
            for text in texts:
                index, counts = counter.count(text)
                yield index.astype("<i4").tobytes(), counts.astype("<i4").tobytes()

        return found

    from pyspark.sql.types import BinaryType

    sample = apply_rows(rows, [field("index", BinaryType()), field("counts", BinaryType())], make, keep=["doc_id", "toxic"])
    # at most most_rows rows, each with the features it has of most_features
    collected = sample.orderBy("doc_id").collect()
    index = [np.frombuffer(row["index"], "<i4") for row in collected]
    counts = [np.frombuffer(row["counts"], "<i4") for row in collected]
    marked = np.array([c[markers[i]].sum() if len(i) else 0 for i, c in zip(index, counts)])
    grades = np.where([row.toxic == 1 for row in collected], 1 + np.searchsorted(GRADE_MARKERS, marked, side="right"), 0)
    weights, thresholds = fit_cumulative(index, [value(c) for c in counts], grades, len(numbers), GRADES)
    return Model(numbers, weights, thresholds)


def fit_cumulative(index: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, n_features: int,
                   n_grades: int, steps: int = 400, rate: float = 0.1, ridge: float = 5e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam on the log-likelihood.

    Thresholds are a first value and positive gaps, so they stay ordered.
    """
    lengths = [len(i) for i in index]
    row = np.repeat(np.arange(len(index)), lengths)
    column = np.concatenate([*index, np.zeros(0, np.int32)]).astype(np.int64)
    x = np.concatenate([*values, np.zeros(0)]).astype(float)
    parameters = np.concatenate([np.zeros(n_features), [2.0], np.zeros(n_grades - 2)])
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    n = len(grades)
    rows = np.arange(n)

    def logistic(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        weights, gaps = parameters[:n_features], np.exp(parameters[n_features + 1:])
        thresholds = parameters[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, x * weights[column], n)
        below = np.hstack([np.zeros((n, 1)), logistic(thresholds[None, :] - score[:, None]), np.ones((n, 1))])
        slope = below * (1 - below)
        p = np.maximum(below[rows, grades + 1] - below[rows, grades], 1e-12)
        upper, lower = slope[rows, grades + 1] / p, slope[rows, grades] / p
        by_score = (upper - lower) / n  # of the negative log-likelihood
        by_threshold = np.zeros(n_grades + 1)
        np.add.at(by_threshold, grades + 1, -upper / n)
        np.add.at(by_threshold, grades, lower / n)
        by_threshold = by_threshold[1:-1]
        tails = by_threshold[::-1].cumsum()[::-1]
        gradient = np.concatenate([
            np.bincount(column, x * by_score[row], n_features) + ridge * weights,
            [tails[0]], tails[1:] * gaps])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        parameters = parameters - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(parameters[n_features + 1:])
    return parameters[:n_features], parameters[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def score(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """``docs`` with severity (expected grade), grade (the likeliest) and toxic (severity >= ``reject``)."""
    def make():
        counter = Counter(model.numbers)

        def rows(texts):
            for text in texts:
                index, counts = counter.count(text)
                total = float((model.weights[index] * value(counts)).sum()) if len(index) else 0.0
                below = model.below(total)
                severity = model.expected(total)
                grade = int(np.argmax(np.diff(below, prepend=0.0, append=1.0)))
                yield severity, grade, severity >= reject

        return rows

    return apply_rows(docs, [field("severity", DoubleType()), field("grade", LONG), field("toxic", BooleanType())], make)
