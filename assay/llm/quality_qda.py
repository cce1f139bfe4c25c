"""Quality classifier: regularised quadratic discriminant over transformed
statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import least_hashed, ready, written

FEATURES = ["log_words", "word_length", "upper", "digit", "symbol", "punctuation", "exclaim", "wide",
            "distinct_words", "top_word", "same_neighbour", "repeat_lines", "short_lines", "capital_words"]
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in "#*$%&|<>@^~_=+{}[]\\`/"]] = 4
_CLASS[[ord(c) for c in ".,;:?\"'()-"]] = 5
_CLASS[ord("!")] = 6
_CLASS[128:] = 7


def statistics_of(text: str | None) -> list[float]:
    """The features of a whole text: shares under a square root, counts under a
    logarithm; all 0 for a null or blank text."""
    raw = (text or "").encode("utf-8", "replace")
    tokens = raw.split()
    if not tokens:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)
    n, inked = len(tokens), sum(map(len, tokens))
    counts = Counter(tokens)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, tokens, tokens[1:]))
    # a few bytes or words more below the line: one odd word says little in a short text
    share = np.sqrt(kinds / (inked + 100))
    m = n + 20
    return [np.log1p(n), np.log(inked / n), share[1], share[3], share[4], share[5], share[6], share[7],
            np.log(len(counts) / n) / np.log(n + 2.0), np.sqrt(max(counts.values()) / m), np.sqrt(same / m),
            np.sqrt((len(lines) - len(set(lines))) / (len(lines) + 3)), np.log1p(n / len(lines)),
            np.sqrt(sum(map(bytes.isupper, tokens)) / m)]


FEATURE_ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [[float(v) for v in statistics_of(t.as_py())] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=FEATURE_ROW.names)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) of every row, written: texts are read once."""
    ready(docs.sparkSession)
    return written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                   .mapInArrow(_features, FEATURE_ROW), "quality-features")


class Discriminant:
    """Gaussian densities of two classes with cached Cholesky factors, and the
    logistic curve that turns their log ratio into a probability."""

    def __init__(self, moments: list[tuple[float, np.ndarray, np.ndarray]], shrink: float, ridge: float):
        total = sum(m[0] for m in moments)
        own = []
        pooled = 0.0
        for n, s, q in moments:
            mean = s / n
            cov = q / n - np.outer(mean, mean)
            own.append((n, mean, cov))
            pooled = pooled + cov * n / total
        floor = np.diag(np.diag(pooled)) + ridge * np.eye(len(pooled))
        self.parts = []
        for n, mean, cov in own:
            mixed = (1 - shrink) * cov + shrink * pooled + ridge * floor
            factor = np.linalg.cholesky(mixed + 1e-6 * np.eye(len(mixed)))
            self.parts.append((np.log(n / total), mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
        self.slope, self.shift = 1.0, 0.0

    def ratio(self, x: np.ndarray) -> np.ndarray:
        """Log of P(1)/P(0), its size compressed so that far points still differ."""
        logs = [prior - 0.5 * (np.square((x - mean) @ inverse.T).sum(1) + logdet)
                for prior, mean, inverse, logdet in self.parts]
        z = logs[1] - logs[0]
        return np.sign(z) * np.log1p(np.abs(z))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Newton steps for the two logistic parameters, lightly regularised."""
        z = self.ratio(x)
        design = np.stack([z, np.ones_like(z)], 1)
        w = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            grad = design.T @ (p - y) + 0.5 * (w - [1.0, 0.0])
            hess = (design * (p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2)
            w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
        self.slope, self.shift = max(float(w[0]), 0.05), float(w[1])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.ratio(x) + self.shift, -36, 36)))


MOMENT = T.StructType([T.StructField("quality", T.IntegerType()), T.StructField("n", T.DoubleType()),
                       T.StructField("s", T.ArrayType(T.DoubleType())), T.StructField("q", T.ArrayType(T.DoubleType()))])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.array(batch.column(1).to_pylist(), float).reshape(len(y), -1)
        for k in np.unique(y):
            own = x[y == k]
            n, s, q = sums.get(k, (0.0, 0.0, 0.0))
            sums[k] = (n + len(own), s + own.sum(0), q + own.T @ own)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()], pa.float64()),
             pa.array([v[1].tolist() for v in sums.values()], pa.list_(pa.float64())),
             pa.array([v[2].ravel().tolist() for v in sums.values()], pa.list_(pa.float64()))], names=MOMENT.names)


def train(rows: DataFrame, labels: DataFrame, shrink: float = 0.1, ridge: float = 0.02,
          calibration_rows: int = 20_000) -> Discriminant | None:
    """Discriminant of ``labels.quality`` (0 or 1) over ``rows`` (doc_id, x).

    Class means and covariances cover every labelled row, summed up in the
    tasks; the logistic curve is fitted on at most ``calibration_rows`` of them,
    in the order of a hash of the id. None unless both classes occur.
    """
    marks = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").cast("int").alias("quality")))
    known = written(rows.join(marks, F.col("doc_id") == F.col("label_id")).select("doc_id", "quality", "x"), "quality-train")
    sums = known.select("quality", "x").mapInArrow(_moments, MOMENT)
    k = len(FEATURES)
    added = (sums.select("quality", "n", F.posexplode(F.concat("s", "q")).alias("i", "v"))
             .groupBy("quality", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    moments = []
    for label in (0, 1):
        cells = {r["i"]: r for r in added if r["quality"] == label}
        if not cells:
            return None
        v = np.array([cells[i]["v"] for i in range(k + k * k)])
        moments.append((cells[0]["n"], v[:k], v[k:].reshape(k, k)))
    model = Discriminant(moments, shrink, ridge)
    sample = least_hashed(known, calibration_rows, sum(int(n) for n, _, _ in moments), "doc_id").collect()
    model.calibrate(np.array([r["x"] for r in sample], float), np.array([r["quality"] for r in sample], float))
    return model


SCORE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def score(rows: DataFrame, model: Discriminant | None) -> DataFrame:
    """(doc_id, score in 0..1) of every row of ``features``; 0.5 without a model.
    Null and blank texts have all features 0 and get a score like any other."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None or not batch.num_rows:
                p = np.full(batch.num_rows, 0.5)
            else:
                p = shared.value.probability(np.array(batch.column(1).to_pylist(), float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=SCORE.names)

    return rows.select("doc_id", "x").mapInArrow(run, SCORE)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0,
                   threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Rows whose crc32(id as text) mod ``folds`` is ``held_out_fold`` are not
    learned from; a null id counts as held out. Repeated rows come back each;
    a document labelled twice takes its lower label; extra columns are not read.
    """
    def out(c: str):
        return F.coalesce(F.crc32(F.col(c).cast("string")) % folds == held_out_fold, F.lit(True))
    rows = features(docs, id_col, text_col)
    model = train(rows.where(~out("doc_id")), labels)
    got = score(rows, model)
    return got.select("doc_id", out("doc_id").alias("held_out"), "score",
                      F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
