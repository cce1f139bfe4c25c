"""Substring dedup: words covered by a window of consecutive words that also
starts in a document with a smaller id are removed.

Windows are handled as runs. The least hash of a window's eight-word sequences,
its mark, is the same wherever the window occurs, and about one word in twenty
begins a run of windows with one mark. Pass one puts the marks of all runs into
a count-min sketch, merged over all partitions; its estimate for a mark is never
below the number of places of any window that has it. Pass two computes the runs
anew and sends on only those estimated repeated; a window whose estimate is one
occurs once. Those runs are grouped exactly:

* equal runs of several documents become one kind by a pre-aggregated minimum;
  in all documents but the kind's first every window of the run goes;
* where several kinds share a mark, their windows are compared one by one, by a
  128-bit name, so windows also shared across unequal runs are found.

No group is gathered into one task: kinds and windows are minima with partial
aggregation, and what is joined back has one row a key on the other side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm import count_min
from assay.llm.common import discard, ready, written
from assay.llm.jaccard_join import mix

WINDOW = 50             # words
MARK = 8                # words of the sequences that a mark is chosen from
PIECE = 400_000         # words handled at a time
#: Odd factor of the rolling hash (a 64-bit constant of the public PCG generator).
FACTOR = 6364136223846793005


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split parts at just these six."""
    return (text or "").encode("utf-8", "replace").split()


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2**64."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (FACTOR, pow(FACTOR, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.multiply.accumulate(out))
        _POWERS[size] = tuple(both)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` neighbours, by doubling."""
    step = 1
    while step * 2 <= size:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = size - step
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word hashes of a batch's texts, some texts or a part of one at a time:
    (hashes, row in the batch of every word, place in its text). Parts of a long
    text overlap by all but one word of a window, so no window is lost or met twice."""
    hashes, rows, places, held = [], [], [], 0
    for row, text in enumerate(batch.column("text")):
        listed = words_of(text.as_py())
        if len(listed) < WINDOW:
            continue
        for at in range(0, max(1, len(listed) - WINDOW + 1), PIECE):
            part = listed[at:at + PIECE + WINDOW - 1]
            hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, part), np.uint64, len(part)))
            rows.append(np.full(len(part), row))
            places.append(np.arange(at, at + len(part)))
            held += len(part)
            if held >= PIECE:
                yield np.concatenate(hashes), np.concatenate(rows), np.concatenate(places)
                hashes, rows, places, held = [], [], [], 0
    if hashes:
        yield np.concatenate(hashes), np.concatenate(rows), np.concatenate(places)


def _runs(hashes: np.ndarray, rows: np.ndarray, places: np.ndarray):
    """(mark, first word, number of windows, windows' hashes) of every run: marks
    and lengths a run, window hashes for all windows of all runs in order."""
    n = len(hashes)
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
        window = mix((total[WINDOW:] - total[:-WINDOW]) * down[:n - WINDOW + 1], 21)
        marks = _sliding_min(mix((total[MARK:] - total[:-MARK]) * down[:n - MARK + 1], 22), WINDOW - MARK + 1)
    # a window lies in one text, and in one part of it
    whole = (rows[WINDOW - 1:] == rows[:n - WINDOW + 1]) & (places[WINDOW - 1:] - places[:n - WINDOW + 1] == WINDOW - 1)
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (marks[1:] != marks[:-1]) | (places[1:n - WINDOW + 1] != places[:n - WINDOW] + 1)
    at = np.flatnonzero(first)
    lengths = np.add.reduceat(whole, at).astype(np.int64) if len(at) else np.empty(0, np.int64)
    return marks[at], at, lengths, window[whole]


def _cells(marks: np.ndarray, width: int) -> np.ndarray:
    """Cells of the marks, a line for each row of the sketch."""
    return np.stack([(row * width + (mix(marks, 31 + row) & np.uint64(width - 1)).astype(np.int64)) for row in range(count_min.DEPTH)])


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                if len(piece[0]) >= WINDOW:
                    yield pa.RecordBatch.from_arrays([pa.array(_cells(_runs(*piece)[0], width).ravel())], names=["cell"])
    return count_min.repeated_cells(docs.select("text").mapInArrow(run, "cell long"), width)


RUNS = "mark long, name long, d long, th long, first int, n int, windows array<long>"


def _candidates(docs: DataFrame, bits, width: int) -> DataFrame:
    """Runs whose mark the sketch estimates to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, th = batch.column("d").to_numpy(), batch.column("th").to_numpy()
            for hashes, rows, places in _pieces(batch):
                if len(hashes) < WINDOW:
                    continue
                marks, at, lengths, window = _runs(hashes, rows, places)
                hit = count_min.is_set(bits.value, _cells(marks, width)).all(0)
                if not hit.any():
                    continue
                flat = window[np.repeat(hit, lengths)]
                ends = np.concatenate([[0], np.cumsum(lengths[hit])])
                raw, begins = flat.tobytes(), ends.tolist()
                name = [xxhash.xxh3_64_intdigest(raw[8 * a:8 * b]) for a, b in zip(begins, begins[1:])]
                own = rows[at[hit]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks[hit].view(np.int64)), pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(d[own]), pa.array(th[own]),
                     pa.array(places[at[hit]].astype(np.int32)), pa.array(lengths[hit].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int64)))],
                    names=["mark", "name", "d", "th", "first", "n", "windows"])
    return docs.select("d", "th", "text").mapInArrow(run, RUNS)


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(d, th, spans: array of (from, to) word places, ``to`` left out) of the
    texts that lose words. ``keyed``: (d: id, th: text hash, text)."""
    spark = keyed.sparkSession
    ready(spark)
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about six bytes a word, one run in twenty words
    width = count_min.cells_for(size // 120)
    bits = spark.sparkContext.broadcast(_sketch(keyed, width))
    runs = written(_candidates(keyed, bits, width), "window-runs")
    kinds = written(runs.groupBy("mark", "name").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "window-kinds")
    # marks with several kinds: windows are compared one by one
    several = (kinds.groupBy("mark").agg(F.min("lo").alias("mark_lo"), F.max("hi").alias("mark_hi"), F.count("*").alias("kinds"))
               .where("kinds > 1 and mark_lo < mark_hi").select(F.col("mark").alias("open_mark"), "mark_lo"))
    open_kinds = kinds.join(several, F.col("mark") == F.col("open_mark")).select(
        F.col("mark").alias("k_mark"), F.col("name").alias("k_name"), "lo", (F.col("lo") > F.col("mark_lo")).alias("late"))
    # of an open kind one run gives the windows, a run of its first document
    chosen = written(runs.join(open_kinds, (F.col("mark") == F.col("k_mark")) & (F.col("name") == F.col("k_name")) & (F.col("d") == F.col("lo")))
                     .groupBy("mark", "name", "lo", "late").agg(F.min("windows").alias("windows")), "window-chosen")

    def each(some: DataFrame) -> DataFrame:
        # named by its hash and the mark, so that a hot mark's windows are dealt out
        return some.select("mark", "name", "lo", F.posexplode("windows").alias("at", "w1")).withColumn("w2", F.xxhash64(F.lit(5), "mark", "w1"))
    least = (each(chosen).groupBy("w1", "w2").agg(F.min("lo").alias("least"), F.max("lo").alias("most")).where("least < most")
             .select(F.col("w1").alias("l1"), F.col("w2").alias("l2"), "least"))
    # a kind of the mark's first document has nothing to find
    late = each(chosen.where("late"))
    more = written(late.join(least, (F.col("w1") == F.col("l1")) & (F.col("w2") == F.col("l2"))).where("least < lo")
                   .groupBy("mark", "name").agg(F.sort_array(F.collect_list("at")).alias("at"))
                   .select(F.col("mark").alias("k_mark"), F.col("name").alias("k_name"), "at"), "window-more")
    same = (F.col("mark") == F.col("k_mark")) & (F.col("name") == F.col("k_name"))
    places = runs.select("mark", "name", "d", "th", "first", "n")
    across = kinds.where("lo < hi").select(F.col("mark").alias("k_mark"), F.col("name").alias("k_name"), "lo")
    # a run met before goes whole; of the others the windows found in other kinds
    known = (places.join(across, same).where("d > lo")
             .select("d", "th", F.array(F.struct(F.col("first").alias("from"), (F.col("first") + F.col("n") + (WINDOW - 1)).alias("to"))).alias("spans")))
    partly = places.join(more, same).select(
        "d", "th", F.transform("at", lambda a: F.struct((F.col("first") + a).alias("from"), (F.col("first") + a + WINDOW).alias("to"))).alias("spans"))
    spans = written(known.unionByName(partly).groupBy("d", "th").agg(F.flatten(F.collect_set("spans")).alias("spans")), "window-spans")
    discard(runs, kinds, chosen, more)
    return spans


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, and the kept words joined by one
    space as ``text`` if asked for) for every row of ``docs``.

    A window is 50 consecutive words of one text; each word covered by a window
    that also starts in a document with a smaller id goes. Windows are judged on
    the input. Repeats within one id stay: no id there is smaller.

    Null or blank text, and texts of fewer than 50 words: nothing goes. A null id
    counts as smaller than any other. Repeated rows (same id and text) come back
    each, alike; two texts with one id are two texts of that id. Empty table: no
    rows. Extra columns are not read.
    """
    ready(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1 << 63)).alias("d"), F.xxhash64(F.col(text_col)).alias("th"),
                        F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    spans = repeated_spans(keyed).select(F.col("d").alias("s_d"), F.col("th").alias("s_th"), "spans")
    # the text meets its spans; texts without any are spread by their own hash as well
    joined = keyed.join(spans, (F.col("d") == F.col("s_d")) & (F.col("th") == F.col("s_th")), "left").select(
        "doc_id", "text", F.col("spans.from").alias("from"), F.col("spans.to").alias("to"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests, texts = [], [], [], []
            for text, begins, ends in zip(batch.column(1), batch.column(2), batch.column(3)):
                listed = words_of(text.as_py())
                counts.append(len(listed))
                if begins.is_valid:
                    edge = np.zeros(len(listed) + 1, np.int32)
                    np.add.at(edge, begins.values.to_numpy(), 1)
                    np.add.at(edge, ends.values.to_numpy(), -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    listed = [listed[i] for i in np.flatnonzero(stays).tolist()]
                removed.append(counts[-1] - len(listed))
                kept = b" ".join(listed)
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(texts, pa.string())] if with_text else [])],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", *["text"] * with_text])

    return joined.mapInArrow(cut, OUT + ", text string" * with_text)
