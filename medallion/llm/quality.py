"""Quality scores from a Gaussian kernel over document statistics.

Statistics of each text (numpy, whole texts) are mapped to random Fourier
features, whose inner products approximate a Gaussian kernel. Every partition
adds up its part of the normal equations; the sums are added by Spark, and
the ridge weights are solved from one matrix whose size is a parameter.
Raw scores of a fold that the weights have not seen are calibrated by
isotonic regression over a histogram (also of fixed size).

Labels are read from folds 1 to 4 of crc32(doc_id) mod 5 alone: 1 to 3 for
the weights, 4 for the calibration. Language, source, doc_id and label are
never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import fold, staged
from medallion.llm.textstats import document_stats
from medallion.llm.words import buffers, slices

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 4
N_STATS = 16


@dataclass(frozen=True)
class QualityParams:
    """features: number of random Fourier features. width: of the Gaussian
    kernel, in standard deviations. ridge: penalty per training row. bins: of
    the calibration histogram. salts: parts in which matrix rows are first
    added. threshold: scores from here on predict 1."""

    features: int = 200
    width: float = 3.0
    ridge: float = 1e-3
    bins: int = 2048
    salts: int = 16
    threshold: float = 0.3
    seed: int = 11


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        mapped = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([mapped, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score in 0 to 1; a small share of the raw score orders
        rows inside the flat parts of the calibration."""
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip((raw + 1) / 3, 0, 1)


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The :data:`N_STATS` statistics of each text; an empty text has zeros."""
    s = document_stats(data, at)
    words, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    size, letters = np.maximum(s["n_bytes"], 1), np.maximum(s["n_letters"], 1)
    columns = [
        np.log1p(s["n_words"]), s["word_chars"] / words, np.sqrt(s["n_symbols"] / words), s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words, s["n_distinct_words"] / words, s["n_same_as_before"] / words,
        np.sqrt(s["n_upper"] / letters), np.sqrt(s["n_digits"] / size), s["n_stops"] / words,
        np.sqrt(s["n_marks"] / words), s["n_wide"] / size, s["n_short_words"] / words,
        np.sqrt(s["n_marked_words"] / words), np.log1p(s["n_words"] / lines), np.log1p(s["n_lines"]),
    ]
    return np.stack(columns, 1)


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, fold, stats (array) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(2)):
                flat = pa.array(statistics(data, at).ravel())
                stats = pa.FixedSizeListArray.from_arrays(flat, N_STATS).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), stats], names=["doc_id", "fold", "stats"]
                )

    rows = documents.select("doc_id", fold(F.col("doc_id"), FOLDS).alias("fold"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fold int, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, N_STATS)


def _normal_equations(rows: DataFrame, model: QualityModel, salts: int) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over (stats, label) rows: summed per partition, then per
    matrix row in ``salts`` parts, then in all."""
    size = len(model.phases) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, seen = np.zeros((size, size + 1)), False
        for batch in batches:
            z = model.features(_matrix(batch.column(0)))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ np.asarray(batch.column(1), np.float64)
            seen = True
        if seen:
            salt = TaskContext.get().partitionId() % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, salt, np.int32)),
                 pa.array([r.tobytes() for r in total], pa.binary())],
                names=["i", "salt", "sums"],
            )

    def add(group: pa.Table) -> pa.Table:
        data, _ = buffers(group.column("sums"))
        total = data.view(np.float64).reshape(group.num_rows, size + 1).sum(0)
        return pa.table({"i": group.column("i")[:1], "salt": group.column("salt")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "i int, salt int, sums binary"
    parts = rows.select("stats", F.col("label").cast("double").alias("label")).mapInArrow(partial, kind)
    summed = parts.groupBy("i", "salt").applyInArrow(add, kind).groupBy("i").applyInArrow(add, kind).collect()
    total = np.zeros((size, size + 1))
    for row in summed:
        total[row["i"]] = np.frombuffer(row["sums"], np.float64)
    return total[:, :size], total[:, size]


def isotonic(x: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; (block centres, block means), both rising."""
    blocks: list[list[float]] = []
    for xi, m, w in zip(x, mean, weight, strict=True):
        blocks.append([xi * w, m * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> QualityModel:
    """The model from staged :func:`text_statistics` and (doc_id, quality).

    Null labels and ids are left out; of several labels of a document the
    largest counts. Without a training row all scores are 0.5; without a
    calibration row the raw scores are only cut to 0 to 1.
    """
    p = params or QualityParams()
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(
        F.max("quality").alias("label")
    )
    rows = staged(
        stats.where(F.col("fold") != HELD_OUT).join(known, F.col("doc_id") == F.col("__id")).select("fold", "stats", "label"),
        "quality-rows",
    )
    train = rows.where(F.col("fold") != CALIBRATION)
    each = [F.avg(F.col("stats")[k]).alias(f"m{k}") for k in range(N_STATS)]
    each += [F.stddev_pop(F.col("stats")[k]).alias(f"s{k}") for k in range(N_STATS)]
    moments = train.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"), *each).first()
    rng = np.random.Generator(np.random.PCG64(p.seed))
    directions = rng.normal(0, 1 / p.width, (N_STATS, p.features))
    phases = rng.uniform(0, 2 * np.pi, p.features)
    empty = not moments["n"]
    mean = np.zeros(N_STATS) if empty else np.array([moments[f"m{k}"] for k in range(N_STATS)])
    scale = np.ones(N_STATS) if empty else np.maximum([moments[f"s{k}"] for k in range(N_STATS)], 1e-6)
    model = QualityModel(mean, scale, directions, phases, np.zeros(p.features + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if empty:
        model.values = np.array([0.5, 0.5])
        return model
    left, right = _normal_equations(train, model, p.salts)
    penalty = np.eye(p.features + 1) * p.ridge * moments["n"]
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(left + penalty, right)

    def raw_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(_matrix(batch.column(0))) + 1) / 3, 0, 1) * (p.bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(at).astype(np.int32)), batch.column(1)], names=["bin", "label"])

    histogram = (
        rows.where(F.col("fold") == CALIBRATION).select("stats", F.col("label").cast("double").alias("label"))
        .mapInArrow(raw_bins, "bin int, label double")
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).orderBy("bin").collect()
    )
    if histogram:
        x = np.array([h["bin"] for h in histogram]) / (p.bins - 1) * 3 - 1
        model.knots, model.values = isotonic(x, np.array([h["mean"] for h in histogram]), np.array([h["n"] for h in histogram]))
        model.values = np.clip(model.values, 0, 1)
    return model


def score_statistics(stats: DataFrame, model: QualityModel, params: QualityParams | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted from :func:`text_statistics`."""
    p = params or QualityParams()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(model.score(_matrix(batch.column(2))))], names=["doc_id", "fold", "score"]
            )

    kind = stats.schema["doc_id"].dataType.simpleString()
    scored = stats.select("doc_id", "fold", "stats").mapInArrow(run, f"doc_id {kind}, fold int, score double")
    return scored.select(
        "doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"),
    )


def score_documents(documents: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per input row.

    A null or empty text is scored from its zero statistics. Equal texts get
    equal scores. An empty table gives no rows; other columns are not read.
    """
    stats = staged(text_statistics(documents), "quality-stats")
    return score_statistics(stats, fit(stats, labels, params), params)


def keep_good(documents: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """The rows of ``documents`` that the model predicts as good, all columns
    as they are, whatever their names. The texts are read once to learn and
    once to score, and are not shuffled. Null and empty texts are scored from
    zero statistics, rows without doc_id too; repeated rows share their
    verdict. An empty table, or one without labels, has nothing to learn from:
    the model then scores all alike."""
    p = params or QualityParams()
    model = fit(staged(text_statistics(documents), "quality-stats"), labels, p)
    mark = "__predicted"
    while mark in documents.columns:
        mark = "_" + mark
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(text)):
                part = batch.slice(i, j - i)
                good = pa.array(model.score(statistics(data, at)) >= p.threshold)
                yield pa.RecordBatch.from_arrays([*part.columns, good], names=[*part.schema.names, mark])

    schema = T.StructType([*documents.schema.fields, T.StructField(mark, T.BooleanType())])
    return documents.mapInArrow(run, schema).where(F.col(mark)).drop(mark)
