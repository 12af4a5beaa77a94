"""Toxicity as a severity grade: cumulative-link regression on sparse features of words."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import append_columns
from tallyhouse.sources.staging import stage

SAMPLE_ROWS = 20_000  # labelled rows that a model is fitted on, at most
FEATURES = 4_096  # features of a model, at most
MIN_DOCS = 5  # toxic rows that must hold a feature
MIN_ODDS = 4.0  # times as common in toxic rows as in others
STEMS = range(3, 9)  # lengths of word beginnings that are features, besides whole words
GRADE_HITS = (3, 6)  # marked words from which a toxic text has grade 2, and grade 3
REJECT = 0.5  # chance of any grade above 0 from which a text is rejected

ITERATIONS = 400
STEP = 0.1
PENALTY = 1e-4

WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word, and its beginnings, marked by a star: inflected forms share them."""
    return [word, *[word[:k] + "*" for k in STEMS if k < len(word)]]


def words_in(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights shared by all grades, and the ordered thresholds between neighbouring grades."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def __post_init__(self):
        object.__setattr__(self, "heads", frozenset(f[: STEMS.start].rstrip("*") for f in self.weights))

    def counts(self, text: str) -> Counter:
        found: Counter = Counter()
        for word, n in words_in(text).items():
            if word[: STEMS.start] in self.heads:
                for f in features_of(word):
                    if f in self.weights:
                        found[f] += n
        return found

    def chances(self, texts: list[str]) -> np.ndarray:
        """Chance of each grade from 1 up being reached, one row per text."""
        score = np.array([sum(self.weights[f] * np.log1p(n) for f, n in self.counts(t).items()) for t in texts])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit_ordinal(rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int):
    """Weights and thresholds of the cumulative logit model, by gradient steps on the mean loss.

    Row i has the features ``rows[i]`` with ``values[i]``. P(grade <= k) = 1 / (1 + exp(score - threshold_k));
    thresholds are kept in order by adding positive distances.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    x = np.concatenate([*values, np.zeros(0)])
    weights, first, gaps = np.zeros(n_features), np.array([1.0]), np.zeros(n_grades - 2)
    params = [weights, first, gaps]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    n = max(1, len(grades))
    for step in range(1, ITERATIONS + 1):
        weights, first, gaps = params
        thresholds = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        score = np.bincount(owner, weights[columns] * x, minlength=len(grades))
        bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high, low = sigmoid(bounds[grades + 1] - score), sigmoid(bounds[grades] - score)
        share = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / share, low * (1 - low) / share
        d_score = d_high - d_low  # of the loss
        d_thresholds = np.array([
            (-d_high[grades == k]).sum() + d_low[grades == k + 1].sum() for k in range(n_grades - 1)
        ]) / n
        slopes = [
            np.bincount(columns, d_score[owner] * x, minlength=n_features) / n + PENALTY * weights,
            np.array([d_thresholds.sum()]),
            np.array([d_thresholds[k + 1 :].sum() * np.exp(g) for k, g in enumerate(gaps)]),
        ]
        for p, g, (m, v) in zip(params, slopes, moments):
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            p -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, first, gaps = params
    return weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))])


def labelled_sample(df: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``text`` and ``toxic`` of at most ``limit`` labelled rows, the same ones whenever the labels are.

    The bounded list of ids goes to the texts, so that only texts of the sample are shuffled. Of rows that repeat
    an id, the one whose text has the smallest digest counts; each task sends one per id. The sample is staged:
    fitting reads it several times, and the table of texts is read only once.
    """
    flags = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    some = flags.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("digest"), "text")).alias("least")
    one = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(least)
    return stage(one.select("least.text", "toxic"), "labelled-sample")


def fit_toxicity(sample: DataFrame) -> OrdinalModel:
    """Fit the model on a bounded sample of ``text`` and ``toxic`` (0 or 1).

    Features are words and word beginnings that are several times as common in toxic texts, found by
    counting over the sample. The labels only tell toxic from not, so a toxic text is graded by how many
    of its words are marked by such a feature: 1, 2 or 3. A sample without toxic rows gives a model
    without features, which rejects nothing.
    """
    n_grades = len(GRADE_HITS) + 2
    listed = T.StructField("features", T.ArrayType(T.StringType()))

    def all_features(texts: list[str]) -> list:
        return [pa.array([sorted({f for w in words_in(t) for f in features_of(w)}) for t in texts], pa.list_(pa.string()))]

    found = append_columns(sample, "text", [listed], all_features, drop=("text",))
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    empty = OrdinalModel({}, np.full(n_grades - 1, 30.0))
    if not toxic:
        return empty
    by_feature = found.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    odds = ((F.col("t") + 0.5) / (toxic + 1.0)) / ((F.col("c") + 0.5) / (clean + 1.0))
    best = by_feature.where((F.col("t") >= MIN_DOCS) & (odds >= MIN_ODDS)).orderBy((F.col("t") * F.log(odds)).desc(), "f")
    names = sorted(r["f"] for r in best.limit(FEATURES).select("f").collect())
    if not names:
        return empty
    number = {f: k for k, f in enumerate(names)}
    marks = OrdinalModel(dict.fromkeys(names, 1.0), np.zeros(n_grades - 1))

    def matrix(texts: list[str]) -> list:
        counts = [marks.counts(t) for t in texts]
        hits = [sum(n for w, n in words_in(t).items() if any(f in number for f in features_of(w))) for t in texts]
        return [
            pa.array([[number[f] for f in sorted(c)] for c in counts], pa.list_(pa.int32())),
            pa.array([[c[f] for f in sorted(c)] for c in counts], pa.list_(pa.int32())),
            pa.array(hits, pa.int64()),
        ]

    fields = [
        T.StructField("columns", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType())),
        T.StructField("hits", T.LongType()),
    ]
    rows = append_columns(sample, "text", fields, matrix, drop=("text",)).collect()  # a bounded sample
    rows.sort(key=lambda r: (r["toxic"], r["hits"], r["columns"], r["counts"]))  # the same order for any partitioning
    grades = np.array([0 if not r["toxic"] else 1 + sum(r["hits"] >= h for h in GRADE_HITS) for r in rows])
    weights, thresholds = fit_ordinal(
        [np.array(r["columns"], np.int64) for r in rows],
        [np.log1p(np.array(r["counts"], float)) for r in rows],
        grades, len(names), n_grades,
    )
    return OrdinalModel(dict(zip(names, weights.tolist())), thresholds)


def score_toxicity(df: DataFrame, model: OrdinalModel, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``expected_severity`` (0 to 3), ``grade`` (the nearest one) and ``rejected``.

    One Arrow pass without a shuffle. A missing or empty text has no features and so the chance that the
    thresholds alone give. Columns with these names are replaced; rows and other columns stay.
    """
    fields = [
        T.StructField("expected_severity", T.DoubleType()),
        T.StructField("grade", T.IntegerType()),
        T.StructField("rejected", T.BooleanType()),
    ]

    def compute(texts: list[str]) -> list:
        chances = model.chances(texts)
        severity = chances.sum(axis=1)
        return [pa.array(severity), pa.array(np.rint(severity).astype(np.int32)), pa.array(chances[:, 0] >= REJECT)]

    return append_columns(df, text, fields, compute, drop)
