"""Reading level of documents: boosted trees over length, vocabulary, syntax and cohesion (problem 10)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm.boosting import Trees, fit_trees, isotonic
from marquetry.llm.textstats import BUCKETS, FEATURES, Segments, text_features

# Labelled documents used for training at most, those of least hash; every labelled document counts below that.
SAMPLE = 20_000
FOLDS = 5
GRADES = ["grade_mean", "grade_q10", "grade_q50", "grade_q90", "grade_known"]


def grade_features(owner: np.ndarray, bucket: np.ndarray, n: int, grade: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How demanding the texts are in which a text's words occur in training: mean, quantiles, share of known words.

    owner, bucket: the text (of n, ascending) and the bucket of each word.
    """
    known = seen[bucket] > 0
    found, g = Segments(owner[known], n), grade[bucket[known]].astype(float)
    every = np.bincount(owner, minlength=n)
    return np.stack([found.mean(g), *found.quantiles(g, 0.1, 0.5, 0.9), found.size / np.maximum(every, 1)], 1)


def _word_grades(bucket: np.ndarray, y: np.ndarray, mean: float, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The mean grade of the texts that hold a word of each bucket, drawn to `mean`, and their number if it is `least`."""
    n = np.bincount(bucket, minlength=BUCKETS)
    grade = (np.bincount(bucket, y, BUCKETS) + 2 * mean) / (n + 2)
    return grade.astype(np.float32), np.where(n >= least, n, 0).astype(np.int32)


@dataclass
class Sample:
    """Labelled texts: features, words, grades, and a fold of five by the text's hash."""

    base: np.ndarray
    owner: np.ndarray
    bucket: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    def some(self, rows: np.ndarray) -> Sample:
        at = np.full(len(self.y), -1)
        at[rows] = np.arange(len(rows))
        words = at[self.owner] >= 0
        return Sample(self.base[rows], at[self.owner[words]], self.bucket[words], self.y[rows], self.fold[rows])

    def word_grades(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = mask[self.owner]
        return _word_grades(self.bucket[words], self.y[self.owner[words]], float(self.y[mask].mean()) if mask.any() else 3.0)

    def fit(self) -> tuple[Trees, np.ndarray, np.ndarray]:
        """Trees whose word grades in training come from the other folds of texts, and the word grades of all."""
        extra = np.zeros((len(self.y), len(GRADES)))
        for k in range(FOLDS):
            own = self.fold == k
            if own.any():
                words = own[self.owner]
                extra[own] = grade_features(self.owner[words], self.bucket[words], len(self.y), *self.word_grades(~own))[own]
        return fit_trees(np.hstack([self.base, extra]), self.y), *self.word_grades(np.ones(len(self.y), bool))


@dataclass
class ReadingModel:
    """trees over FEATURES + GRADES; word grades; knots of the calibration; cuts between bands on the calibrated grade;
    report: how the calibrated grades and bands of sources held out from both trees and calibration hit their labels."""

    trees: Trees
    grade: np.ndarray
    seen: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]
    cuts: np.ndarray
    report: list[dict] = field(default_factory=list)

    def raw(self, base: np.ndarray, owner: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return self.trees.predict(np.hstack([base, grade_features(owner, bucket, len(base), self.grade, self.seen)]))

    def predict(self, base: np.ndarray, owner: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated grades, and the bands they fall into."""
        level = np.interp(self.raw(base, owner, bucket), *self.knots)
        return level, 1 + np.searchsorted(self.cuts, level)


def _best_cuts(level: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair of neighbouring bands the cut on the calibrated grade that puts most held-out labels on their side."""
    cuts = []
    order = np.argsort(level, kind="stable")
    r = level[order]
    for b in range(1, 5):
        below = y[order] <= b + 0.25
        right = np.concatenate([[0], np.cumsum(below)]) + np.concatenate([np.cumsum((~below)[::-1])[::-1], [0]])
        right[1:-1][r[1:] == r[:-1]] = -1  # no cut parts equal grades
        top = np.flatnonzero(right == right.max())
        i = int(top[len(top) // 2])
        cuts.append(r[0] - 1 if i == 0 else r[-1] + 1 if i == len(r) else (r[i - 1] + r[i]) / 2)
    return np.maximum.accumulate(np.array(cuts))


def _groups(source: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Sources in groups of about equal size, each of which is held out once; with one source, the texts' folds."""
    sizes, load, group = pd.Series(source).value_counts(), np.zeros(FOLDS), {}
    for s, c in sizes.items():
        group[s] = int(load.argmin())
        load[group[s]] += c
    return np.array([group[s] for s in source]) if len(sizes) > 1 else fold


def train_reading(sample: Sample, source: np.ndarray) -> ReadingModel:
    """A model from labelled texts. Each group of sources is predicted by trees that saw only the others.

    These held-out predictions give the calibration and the cuts between bands on the calibrated grade. For the report
    a group's predictions are calibrated and cut by those of the other groups, so nothing in it has seen its labels.
    """
    y, held = sample.y, _groups(source, sample.fold)
    raw = np.zeros(len(y))
    for k in np.unique(held):
        rest, own = np.flatnonzero(held != k), np.flatnonzero(held == k)
        part = sample.some(rest if len(rest) >= 20 else np.arange(len(y)))
        test = sample.some(own)
        raw[own] = ReadingModel(*part.fit(), (np.zeros(1), np.zeros(1)), np.zeros(4)).raw(test.base, test.owner, test.bucket)

    def calibrated(rows: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        knots = isotonic(raw[rows], y[rows])
        return knots, _best_cuts(np.interp(raw[rows], *knots), y[rows])

    level, band = np.zeros(len(y)), np.zeros(len(y), int)
    for k in np.unique(held):
        rest, own = held != k, held == k
        knots, cuts = calibrated(rest if rest.sum() >= 20 else np.ones(len(y), bool))
        level[own] = np.interp(raw[own], *knots)
        band[own] = 1 + np.searchsorted(cuts, level[own])
    report = []
    for s in sorted(set(source)):
        m = source == s
        extreme = (y[m] <= 1.25) | (y[m] >= 4.75)
        right = band[m] == np.floor(y[m] + 0.5)
        report.append({"source": s, "labelled": int(m.sum()), "error": float(np.abs(level - y)[m].mean()), "right": float(right.mean()), "extreme": int(extreme.sum()), "extreme_right": float(right[extreme].mean()) if extreme.any() else None})
    return ReadingModel(*sample.fit(), *calibrated(np.ones(len(y), bool)), report)


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        base, owner, bucket = text_features(pdf["text"].tolist())
        words = np.split(bucket, np.searchsorted(owner, np.arange(1, len(pdf)))) if len(pdf) else []
        yield pdf[["key", "y", "source", "text_hash"]].assign(base=list(base), buckets=list(words))


def reading_model(docs: DataFrame, labels: DataFrame, key: str, text: str, source: str, band: str, sample: int = SAMPLE) -> ReadingModel | None:
    """The model fitted on the labelled documents, at most `sample` of them (of least hash); None without labels.

    Several labels of a document count as their median. Labels of unknown documents and null bands are ignored.
    """
    marks = labels.filter(F.col(band).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.percentile(band, 0.5).alias("y"))
    marks = marks.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source")).join(marks, "key")
    rows = rows.withColumn("text_hash", F.pmod(F.xxhash64("text"), F.lit(1_000_003)))
    found = rows.mapInPandas(_labelled, "key bigint, y double, source string, text_hash bigint, base array<double>, buckets array<int>").toPandas()
    if not len(found):
        return None
    found = found.sort_values(["text_hash", "key"]).reset_index(drop=True)
    owner = np.repeat(np.arange(len(found)), found["buckets"].map(len))
    words = np.concatenate([*found["buckets"], np.zeros(0, np.int32)]).astype(np.int32)
    fold = (found["text_hash"].to_numpy() % FOLDS).astype(int)
    return train_reading(Sample(np.stack(found["base"].to_numpy()).astype(float), owner, words, found["y"].to_numpy(float), fold), found["source"].fillna("").to_numpy())


REPORT = "source string, labelled bigint, error double, right double, extreme bigint, extreme_right double"


def reading_report(spark: SparkSession, model: ReadingModel | None) -> DataFrame:
    """How well held-out sources are graded: mean absolute error, share of right bands, and that of bands 1 and 5."""
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in REPORT.split(", ")) for r in (model.report if model else [])], REPORT)


def reading_levels(docs: DataFrame, model: ReadingModel | None, key: str, text: str) -> DataFrame:
    """(key, level, band) of every document: the calibrated grade and the band 1 to 5, one pass without a shuffle.

    Null and empty texts and texts without words get null level and band; without a model all are null. Texts are read
    whole; repeated texts each count.
    """
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, level double, band int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame({key: pdf[key], "level": pd.array([None] * len(pdf), "Float64"), "band": pd.array([None] * len(pdf), "Int32")})
            if model is not None and len(pdf):
                base, owner, bucket = text_features(pdf[text].tolist())
                level, band = model.predict(base, owner, bucket)
                none = np.bincount(owner, minlength=len(pdf)) == 0
                out["level"], out["band"] = pd.arrays.FloatingArray(level, none), pd.arrays.IntegerArray(band.astype(np.int32), none)
            yield out

    return docs.select(key, text).mapInPandas(run, schema)
