"""Quality scores by kernel ridge regression on statistics of a text, calibrated to probabilities.

Random Fourier features stand for a Gaussian kernel, so the fit is one set of normal equations of fixed
size, summed per partition. An isotonic map from raw scores to probabilities is fitted on other labelled
rows, from counts per bin of the raw score. Only labels and texts are learned from; both sums are over
all labelled rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wayfare.session import written

N_STATISTICS = 16
N_FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
BINS = 2_000
THRESHOLD = 0.3
FOLDS = 5
# rows of this fold calibrate, the others but 0 are fitted
CALIBRATION_FOLD = 4
SUM_GROUPS = 16

LOWER, UPPER, DIGIT, BLANK, SYMBOL, SHOUT, STOP, OTHER, WIDE = range(9)


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[128:] = WIDE
    for kind, members in (
        (LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, b"0123456789"),
        (BLANK, b" \t\n\r\x0b\x0c"), (SYMBOL, b"#*$%&|<>"), (SHOUT, b"!"), (STOP, b".,;:?"),
    ):
        table[list(members)] = kind
    return table


CLASSES = _classes()


def statistics(text: str | None) -> list[float]:
    """Numbers from 0 to about 3 that describe a whole text; an empty text has zeros."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATISTICS
    raw = text.encode()
    kinds = np.bincount(CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=9).tolist()
    letters = kinds[LOWER] + kinds[UPPER] + kinds[WIDE] or 1
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = max(n - 1, 1)
    return [
        math.log1p(n) / 4,
        min((len(raw) - kinds[BLANK]) / n, 40) / 8,
        kinds[UPPER] / letters,
        kinds[DIGIT] / len(raw) * 4,
        min(kinds[SYMBOL] / n, 3),
        min(kinds[SHOUT] / n, 3),
        min(kinds[STOP] / n, 3),
        min(kinds[OTHER] / n, 3),
        kinds[WIDE] / len(raw),
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / pairs,
        sum(map(operator.eq, words, words[1:])) / pairs,
        1 - len(set(lines)) / len(lines),
        min(math.log1p(n / len(lines)), 6) / 3,
        sum(map((1).__eq__, map(len, words))) / n,
        min(max(map(len, words)), 200) / 50,
    ]


def fold(doc_id: Column) -> Column:
    """Unsigned crc32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score statistics; its size is fixed."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    steps: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        waves = np.cos((x - self.centre) / self.scale @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights if self.weights is not None else np.full(len(x), 0.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return np.clip(np.interp(raw, self.steps, self.values) if len(self.steps) else raw, 0, 1)


def _of_columns(batch: pd.DataFrame) -> np.ndarray:
    return np.array(batch["x"].tolist(), dtype=float).reshape(-1, N_STATISTICS)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every text."""
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": pd.array(batch["doc_id"], dtype="Int64"), "x": [statistics(t) for t in batch["text"]],
            })

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInPandas(describe, "doc_id long, x array<double>")


def _normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    size = N_FEATURES + 1

    def of_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, target = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = model.features(_of_columns(batch))
            gram += z.T @ z
            target += z.T @ batch["quality"].to_numpy(dtype=float)
        yield pd.DataFrame({
            "part": [TaskContext.get().partitionId() % SUM_GROUPS], "sums": [np.vstack([gram, target]).tobytes()],
        })

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s) for s in group["sums"])
        return pd.DataFrame({"sums": [total.tobytes()]})

    parts = rows.mapInPandas(of_partition, "part int, sums binary").groupBy("part").applyInPandas(added, "sums binary")
    total = np.zeros((size + 1) * size)
    for r in parts.collect():  # SUM_GROUPS rows of fixed size
        total = total + np.frombuffer(r["sums"])
    total = total.reshape(size + 1, size)
    return total[:size], total[size]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values``, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([float(value), float(weight), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks.pop()
            blocks.append([(u * x + v * w) / (x + w), x + w, m + n])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.array([])


def fit(x: DataFrame, labels: DataFrame, seed: int = 11) -> Model:
    """A model from ``x`` (doc_id, x) and ``labels`` (doc_id, quality); fold 0 is never looked at.

    Of several labels for a document the least counts. Without labelled rows every score is 0.5.
    """
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = written(x.join(known, "doc_id").withColumn("fold", fold(F.col("doc_id"))).filter("fold != 0"), "labelled")
    moments = rows.agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(F.col("x")[i]) for i in range(N_STATISTICS)]).alias("centre"),
        F.array(*[F.stddev_pop(F.col("x")[i]) for i in range(N_STATISTICS)]).alias("spread"),
    ).first()
    draw = np.random.default_rng(seed)
    directions = draw.normal(size=(N_STATISTICS, N_FEATURES)) / WIDTH
    phases = draw.uniform(0, 2 * math.pi, N_FEATURES)
    none = np.array([])
    if not moments["n"]:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), None, none, none, directions, phases)
    centre, spread = np.array(moments["centre"]), np.array(moments["spread"])
    start = Model(centre, np.maximum(spread, 1e-3), None, none, none, directions, phases)
    fitted = rows.filter(F.col("fold") != CALIBRATION_FOLD)
    gram, target = _normal_equations(fitted if not fitted.isEmpty() else rows, start)
    ridge = RIDGE * gram[-1, -1] * np.eye(len(gram))
    ridge[-1, -1] = 0
    model = Model(centre, start.scale, np.linalg.solve(gram + ridge, target), none, none, directions, phases)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = np.clip(model.raw(_of_columns(batch)), -0.5, 1.5)
            yield pd.DataFrame({"bin": np.floor((raw + 0.5) * BINS / 2).astype(int), "quality": batch["quality"]})

    counts = (
        rows.filter(F.col("fold") == CALIBRATION_FOLD).select("x", F.col("quality").cast("double"))
        .mapInPandas(binned, "bin long, quality double")
        .groupBy("bin").agg(F.count("*").alias("n"), F.avg("quality").alias("share")).orderBy("bin").collect()
    )
    if not counts:
        return model
    values = isotonic(np.array([r["share"] for r in counts]), np.array([r["n"] for r in counts]))
    steps = (np.array([r["bin"] for r in counts]) + 0.5) * 2 / BINS - 0.5
    return Model(centre, model.scale, model.weights, steps, values, directions, phases)


def scored(x: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) from ``x`` (doc_id, x)."""
    @pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(xs.tolist(), dtype=float).reshape(-1, N_STATISTICS)))

    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    rows = x.select("doc_id", held_out.alias("held_out"), score("x").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text), learned from ``labels``.

    A null text counts as empty and gets a score like any other. Rows with a null doc_id are scored, never
    learned from, and not held out. Repeated rows get equal scores, an empty table gives no rows, and
    other columns are not looked at.
    """
    x = written(described(docs), "described")
    return scored(x, fit(x, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, in all their columns, that the model does not reject."""
    model = fit(written(described(docs), "described"), labels)

    @pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in texts]).reshape(-1, N_STATISTICS)) >= THRESHOLD)

    return docs.filter(keep(F.col("text").cast("string")))
