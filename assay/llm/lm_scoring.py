"""LM scoring: a hashed maximum-entropy model over word classes with a
class-factored softmax, trained by distributed gradient steps.

log P(word | history) = log P(class | classes before) + log P(word | class).
The first factor is a softmax over hashed n-gram and skip features of the three
classes before; the second has one parameter per training word (its count), so
that what is gathered grows with the corpus. Unknown words have a share of one
count in every class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import ready, written

CLASSES = 48
SHORT = 23            # classes of words of up to three bytes; the rest go by ending
END = b"\xff"         # never a byte of UTF-8 text
SLOTS = 1 << 12       # hashed feature rows
HISTORY = CLASSES ** 3


class _Endings(dict):
    """Class of a word by its last four bytes: 0 ends a text, words of up to
    three bytes are classed by a hash of themselves, longer ones by a hash of
    their last letters."""

    def __missing__(self, end: bytes) -> int:
        if end == END:
            cls = 0
        elif len(end) <= 3:
            cls = 1 + xxhash.xxh3_64_intdigest(end) % SHORT
        else:
            tail = end.rstrip(b".,;:!?|&*$%#") or end
            cls = 1 + SHORT + xxhash.xxh3_64_intdigest(tail[-2:]) % (CLASSES - 1 - SHORT)
        if len(self) < 200_000:
            self[end] = cls
        return cls


_CLASS_OF = _Endings()


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and classes of a text's words, A-Z lower-cased, and its end."""
    listed = (text or "").encode("utf-8", "replace").lower().split()
    listed.append(END)
    n = len(listed)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, n).view(np.int64)
    return hashes, np.fromiter(map(_CLASS_OF.__getitem__, [w[-4:] for w in listed]), np.int64, n)


def histories(cls: np.ndarray) -> np.ndarray:
    """Code of the three classes before each token; the end class before a text."""
    padded = np.concatenate([np.zeros(3, np.int64), cls])
    n = len(cls)
    return (padded[:n] * CLASSES + padded[1:n + 1]) * CLASSES + padded[2:n + 2]


def slots(history: np.ndarray) -> np.ndarray:
    """Hashed feature rows of each history: class n-grams and skips."""
    one, two, three = history % CLASSES, history // CLASSES % CLASSES, history // CLASSES ** 2
    names = [one, two, three, one * CLASSES + two, one * CLASSES + three, two * CLASSES + three]
    out = np.empty((len(history), len(names)), np.int64)
    with np.errstate(over="ignore"):
        for k, name in enumerate(names):
            mixed = (name.astype(np.uint64) + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
            out[:, k] = (mixed * np.uint64(0x94D049BB133111EB) >> np.uint64(52)).astype(np.int64) % SLOTS
    return out


def log_softmax(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Log class probabilities after each history; the last weight row is the bias."""
    logits = np.repeat(weights[-1:], len(history), 0)
    for row in slots(history).T:
        logits += weights[row]
    logits -= logits.max(1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(1, keepdims=True))
    return logits


COUNT = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()),
                      T.StructField("cls", T.IntegerType()), T.StructField("n", T.LongType())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: word hash, its class and count; kind 1: history, next class and count."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        hashes = np.concatenate([h for h, _ in held])
        cls = np.concatenate([c for _, c in held])
        context = np.concatenate([histories(c) for _, c in held])
        word, first, n = np.unique(hashes, return_index=True, return_counts=True)
        seen, m = np.unique(context * CLASSES + cls, return_counts=True)
        kind = np.repeat(np.array([0, 1], np.int32), [len(word), len(seen)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.concatenate([word, seen // CLASSES])),
             pa.array(np.concatenate([cls[first], seen % CLASSES]).astype(np.int32)),
             pa.array(np.concatenate([n, m]).astype(np.int64))], names=COUNT.names)
    for batch in batches:
        for text in batch.column(0):
            pair = tokens(text.as_py())
            held.append(pair)
            size += len(pair[0])
            if size > 3_000_000:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def train_weights(contexts: DataFrame, steps: int = 25, rate: float = 0.5, parts: int = 8) -> np.ndarray:
    """Softmax weights (SLOTS + 1 bias row) x CLASSES by full-batch gradient
    steps (Adagrad): each step broadcasts the weights, ``parts`` tasks sum the
    gradient over their histories, and the driver adds ``parts`` blocks up.
    ``contexts`` (history, cls, n) has at most CLASSES**4 rows at any size."""
    spark = contexts.sparkSession
    dense = written(contexts.groupBy("history").agg(F.map_from_entries(F.collect_list(F.struct("cls", "n"))).alias("m"))
                    .select("history", F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda c: F.coalesce(
                        F.element_at("m", c), F.lit(0)).cast("float")).alias("n")).repartition(parts, "history"), "lm-histories")
    totals = contexts.groupBy("cls").agg(F.sum("n").alias("n")).collect()
    mass = float(sum(r["n"] for r in totals))
    weights = np.zeros((SLOTS + 1, CLASSES), np.float32)
    for r in totals:
        weights[-1, r["cls"]] = np.log((r["n"] + 1.0) / (mass + CLASSES))
    weights[-1][weights[-1] == 0] = np.log(1.0 / (mass + CLASSES)) if mass else 0.0
    if not mass:
        return weights
    squares = np.full_like(weights, 1e-8)
    shape = weights.shape
    for _ in range(steps):
        shared = spark.sparkContext.broadcast(weights)

        def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.float64)
            seen = False
            for batch in batches:
                if not batch.num_rows:
                    continue
                seen = True
                history = batch.column(0).to_numpy()
                n = batch.column(1).flatten().to_numpy().reshape(-1, CLASSES)
                miss = n - n.sum(1, keepdims=True) * np.exp(log_softmax(shared.value, history))
                for row in slots(history).T:
                    order = np.argsort(row, kind="stable")
                    rows, start = np.unique(row[order], return_index=True)
                    total[rows] += np.add.reduceat(miss[order], start, axis=0)
                total[-1] += miss.sum(0)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["g"])
        blocks = dense.mapInArrow(gradient, "g binary").collect()
        step = sum(np.frombuffer(r["g"], np.float32).reshape(shape).astype(np.float64) for r in blocks) / mass
        squares += (step ** 2).astype(np.float32)
        weights = (weights + rate * step / np.sqrt(squares)).astype(np.float32)
        shared.unpersist()
    return weights


PART = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                     T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType()),
                     T.StructField("tokens", T.LongType()), T.StructField("known", T.LongType()),
                     T.StructField("base", T.DoubleType()), T.StructField("gain", T.DoubleType())])


class Scorer:
    """Sums over a text's tokens of what a task can know: class log
    probabilities, and log counts of the frequent words."""

    def __init__(self, weights: np.ndarray, class_mass: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        self.weights, self.log_mass = weights, np.log10(class_mass)
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], np.log10(counts[order] + 1.0)

    def parts(self, rows: np.ndarray, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        pairs = [tokens(t) for t in texts]
        sizes = np.array([len(h) for h, _ in pairs])
        owner = np.repeat(np.arange(len(texts)), sizes)
        hashes = np.concatenate([h for h, _ in pairs])
        cls = np.concatenate([c for _, c in pairs])
        # sparse: a softmax row only for the histories that occur in the batch
        history, place = np.unique(np.concatenate([histories(c) for _, c in pairs]), return_inverse=True)
        gain = log_softmax(self.weights, history)[place, cls] / np.log(10.0) - self.log_mass[cls]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            base = np.where(hit, self.logs[at], 0.0)
        else:
            hit, base = np.zeros(len(hashes), bool), np.zeros(len(hashes))
        k = len(texts)
        # the other words: one row per text and distinct word, looked up by a join
        rare = np.flatnonzero(~hit)
        order = rare[np.lexsort((hashes[rare], owner[rare]))]
        h, o = hashes[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])) if len(h) else np.empty(0, int)
        n = np.diff(np.append(new, len(h)))
        ids = np.asarray(ids.to_numpy(zero_copy_only=False))
        zero = np.zeros(len(new))
        some = pa.array(np.concatenate([ids, ids[o[new]]]), pa.int64(), from_pandas=True)
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([rows, rows[o[new]]])), some,
            # a text's own row meets no word: spread by its row number
            pa.array(np.concatenate([rows * np.int64(0x5851F42D4C957F2D), h[new]])),
            pa.array(np.concatenate([np.zeros(k), n]).astype(np.int32)),
            pa.array(np.concatenate([sizes, zero]).astype(np.int64)),
            pa.array(np.concatenate([np.bincount(owner, hit, k), zero]).astype(np.int64)),
            pa.array(np.concatenate([np.bincount(owner, base, k), zero])),
            pa.array(np.concatenate([np.bincount(owner, gain, k), zero]))], names=PART.names)


def lm_scores(docs: DataFrame, folds: int = 7, held_out_fold: int = 2, frequent: float = 1e-6,
              steps: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for
    every row of ``docs``; scores are log10 probabilities of whole texts.

    Learns from the rows whose crc32(id as text) mod ``folds`` is not
    ``held_out_fold`` (a null id is held out). Words with at least ``frequent``
    of all training tokens, fewer than 1/frequent by that bound, are broadcast;
    all others are looked up by a shuffle join.

    Null, empty and blank texts consist of their end alone. No training text:
    every word is unknown. Repeated rows come back each; extra columns are not
    read, whatever their names.
    """
    spark = docs.sparkSession
    ready(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_out_fold, F.lit(True))
    counts = written(base.where(~out).select("text").mapInArrow(_count, COUNT)
                     .groupBy("kind", "key", "cls").agg(F.sum("n").alias("n")), "lm-counts")
    vocabulary = counts.where("kind = 0").select("key", "cls", "n")
    weights = train_weights(counts.where("kind = 1").select(F.col("key").alias("history"), "cls", "n"), steps)
    per_class = vocabulary.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total, size = sum(r["n"] for r in per_class), sum(r["v"] for r in per_class)
    mass = np.ones(CLASSES)                     # one count for the unknown words of a class
    for r in per_class:
        mass[r["cls"]] += r["n"] + r["v"]
    common = vocabulary.where(F.col("n") >= F.lit(max(1.0, frequent * total))).select("key", "n").toPandas()
    shared = spark.sparkContext.broadcast(Scorer(
        weights, mass, common["key"].to_numpy(np.int64), common["n"].to_numpy(np.float64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # some texts at a time: memory follows the longest text
            rows, ids, texts = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_pylist()
            start, held = 0, 0
            for i, text in enumerate(texts):
                held += len(text or "")
                if held > 2_000_000 or i == len(texts) - 1:
                    yield shared.value.parts(rows[start:i + 1], ids.slice(start, i + 1 - start), texts[start:i + 1])
                    start, held = i + 1, 0

    parts = (base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(score, PART))
    seen = parts.join(vocabulary.select(F.col("key").alias("w"), F.col("n").alias("c")), F.col("key") == F.col("w"), "left")
    c = F.coalesce("c", F.lit(0))
    summed = seen.groupBy("row", "doc_id").agg(
        F.sum("tokens").alias("n_tokens"),
        (F.sum("known") + F.sum(F.when(c > 0, F.col("n")).otherwise(0))).cast("long").alias("n_known"),
        (F.sum("base") + F.sum(F.col("n") * F.log10(c + 1.0))).alias("logs"), F.sum("gain").alias("gain"))
    return summed.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(total + size + 1.0)))).alias("base_score"),
        (F.col("logs") + F.col("gain")).alias("score"))
