"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each partition of labelled rows sums its part of the normal equations; the sums meet in a
grouping with partial sums, and only the finished matrix of fixed size reaches the driver.  The
calibration uses rows left out of the fit, counted in bins of the raw score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import in_small_batches, keep
from weatherlake.llm.words import LETTERS, encoded, hashed_words, slices

STATISTICS = (
    "bytes words mean_word upper digit punctuation exclamation bar blank newline beyond_ascii other_control "
    "distinct_words distinct_pairs top_word short_words long_words distinct_lines lines mean_line entropy "
    "sentence_ends repeated_words letters capital_words"
).split()
FEATURES, RIDGE, SEED = 160, 1.0, 5
BINS = 400


def _share(part, whole) -> float:
    return float(part) / whole if whole else 0.0


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a whole text; all are 0 for empty text."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digit = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    blank, newline = hist[32] + hist[9], hist[10] + hist[13]
    control, beyond = hist[:32].sum() - hist[9:14].sum(), hist[128:].sum()
    marks = n - upper - lower - digit - hist[32] - hist[:32].sum() - beyond
    p = hist[hist > 0] / n
    words, _ = hashed_words([text], LETTERS)
    m = len(words)
    plain = text.split()
    _, counts = np.unique(words, return_counts=True)
    pairs = len(np.unique(words[:-1] * np.uint64(3) + words[1:])) if m > 1 else m
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = np.array([len(x) for x in plain]) if plain else np.zeros(0)
    return [
        np.log1p(n), np.log1p(m), _share(n - blank - newline, len(plain)) / 10, _share(upper, n), _share(digit, n),
        _share(marks, n), _share(hist[33], n), _share(hist[124], n), _share(blank, n), _share(newline, n),
        _share(beyond, n), _share(control, n), _share(len(counts), m), _share(pairs, max(m - 1, 1)),
        _share(counts.max(initial=0), m), _share((sizes <= 3).sum(), len(sizes)), _share((sizes >= 14).sum(), len(sizes)),
        _share(len(set(lines)), len(lines)), np.log1p(len(lines)), np.log1p(_share(n, len(lines))),
        float(-(p * np.log2(p)).sum()), _share(hist[46] + hist[63], n), _share((words[1:] == words[:-1]).sum(), m),
        _share(upper + lower, n), _share(sum(x[:1].isupper() for x in plain), len(plain)),
    ]


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array ``stats`` of every row; null text counts as empty."""

    def run(batches):
        for rows in (part for batch in batches for part in slices(batch, "_text")):
            stats = [statistics(t) for t in encoded(rows.column("_text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"]
            )

    rows = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: tuple = ((0.0, 1.0), (0.0, 1.0))

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6.0, 6.0)
        waves = np.sqrt(2.0 / FEATURES) * np.cos(x @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score; a small share of the raw score keeps the order inside flat steps."""
        raw = self.raw(stats)
        return 0.99 * np.interp(raw, *self.knots) + 0.01 * np.clip(raw, 0.0, 1.0)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))


def isotonic(x: list, y: list, n: list) -> tuple[tuple, tuple]:
    """Pool adjacent violators over bins in order: knots (x, y) of a rising function."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, n):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return tuple(b[0] / b[2] for b in blocks), tuple(b[1] / b[2] for b in blocks)


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Fit on all labelled rows: three of four for the ridge weights, the others for the calibration.

    Rows without id or label are not used.  With no rows at all every score is near 0.5.
    """
    known = labels.select("doc_id", F.col(label_col).cast("double").alias("y")).na.drop()
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = keep(stats.join(known, "doc_id").withColumn("left", F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(4)) == 0), "quality-rows")
    size = len(STATISTICS)
    moments = [f(F.col("stats")[i]).alias(f"{f.__name__}{i}") for i in range(size) for f in (F.avg, F.stddev_pop)]
    found = rows.agg(*moments).first()
    mean = np.array([found[2 * i] or 0.0 for i in range(size)])
    spread = np.array([found[2 * i + 1] or 1.0 for i in range(size)])
    rng = np.random.default_rng(SEED)
    model = Model(
        mean, spread, rng.normal(0, 1.0 / np.sqrt(size), (size, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES),
        np.append(np.zeros(FEATURES), 0.5),
    )
    width = FEATURES + 1
    upper = np.triu_indices(width)

    def partial_sums(batches):
        gram, moment = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            z = model.features(_matrix(batch.column("stats")))
            gram += z.T @ z
            moment += z.T @ batch.column("y").to_numpy()
        values = np.concatenate([gram[upper], moment])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "value"])

    fitted = rows.filter("not left").select("stats", "y").mapInArrow(partial_sums, "at int, value double")
    sums = fitted.groupBy("at").agg(F.sum("value").alias("value")).toPandas().sort_values("at")["value"].to_numpy()
    if not len(sums) or not sums[len(upper[0]) - 1]:
        return model
    gram = np.zeros((width, width))
    gram[upper] = sums[: len(upper[0])]
    gram += np.triu(gram, 1).T
    penalty = RIDGE * np.eye(width)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, sums[len(upper[0]) :])

    def raw_scores(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("y")], ["raw", "y"])

    scored = rows.filter("left").select("stats", "y").mapInArrow(raw_scores, "raw double, y double")
    place = F.floor((F.least(F.greatest("raw", F.lit(-0.5)), F.lit(1.5)) + 0.5) / 2.0 * BINS)
    bins = scored.groupBy(place.alias("bin")).agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("y").alias("n"))
    bins = bins.toPandas().sort_values("bin")
    if len(bins):
        model.knots = isotonic(bins["raw"].tolist(), bins["y"].tolist(), bins["n"].tolist())
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``document_statistics``."""

    def run(batches):
        for batch in batches:
            p = np.clip(model.score(_matrix(batch.column("stats"))), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
