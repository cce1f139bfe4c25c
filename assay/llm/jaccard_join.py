"""N-gram Jaccard join by PartEnum signatures.

Sets are cut into size bands. For a band with sets of up to ``hi`` features, two
sets at the threshold differ in at most k features, k = hi * 2 * (1-t)/(1+t).
The feature domain is cut into n1 partitions of n2 cells; as n1 * (k2 + 1) > k,
in some partition at most k2 cells differ, so the two sets agree on a subset of
n2 - k2 of its cells, and the subset's content is a signature they share. Some partitions
more than that, and a pair shares several, of which the emptiest are left out. No
link is lost; candidates are then checked on their exact sets.

Groups of equal sets are one node from the start. Within a signature's bucket
pairs are not enumerated: every node is first checked against the bucket's
smallest node, found groups are merged, and only nodes of different groups are
compared further, in blocks, by parity sketches that bound the difference from
below and have as many bits as the sets ask for, before an exact check.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assay.llm.common import discard, ready, written
from assay.llm.components import connected_components

WIDTH = 4               # words of a shingle
PERCENT = 85            # least Jaccard similarity, in hundredths
BITS = 1024             # of a coarse parity sketch
FINE = 16384            # most bits of a fine one, which has at least a bit a feature below that
BLOCK = 2048            # nodes of a bucket compared at a time
NEAREST = 3             # partners of a node that a bucket proposes in a round
ROUNDS = 1              # of nearest partners, before all open pairs are checked


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2 ** 64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, A-Z lower-cased."""
    listed = (text or "").encode("utf-8", "replace").lower().split()
    if not listed:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))
    with np.errstate(over="ignore"):
        if len(w) < width:
            whole = np.uint64(len(w))
            for x in w:
                whole = whole * np.uint64(0x9E3779B97F4A7C15) + x
            return mix(np.array([whole], np.uint64), 9)
        n = len(w) - width + 1
        grams = w[:n].copy()
        for k in range(1, width):
            grams *= np.uint64(0xD6E8FEB86659FD93)
            grams += w[k:n + k]
    return np.unique(mix(grams, 8))


def names(grams: np.ndarray, seed: int) -> tuple[int, int]:
    """(node, check): two 64-bit hashes of a set of shingle hashes."""
    salt = np.uint64(0x2545F4914F6CDD1D * (seed + 1) & (2 ** 64 - 1))
    with np.errstate(over="ignore"):
        return (int((grams ^ salt).sum(dtype=np.uint64).view(np.int64)),
                int((grams * (grams | np.uint64(1))).sum(dtype=np.uint64).view(np.int64)))


def bands() -> Iterator[tuple[int, int]]:
    lo = 1
    while True:
        hi = max(lo, lo * 14 // 10)
        yield lo, hi
        lo = hi + 1


def band_of(size: int) -> tuple[int, int, int]:
    """(number, lowest, highest size) of the band that holds ``size``."""
    for i, (lo, hi) in enumerate(bands()):
        if size <= hi:
            return i, lo, hi
    raise AssertionError


_BANDS: dict[tuple[int, int], list[tuple[int, int]]] = {}


def instances(size: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(band number, greatest difference) of the bands a set takes part in: its
    own, and the next one if a similar set can lie there."""
    key = (size, percent)
    if key not in _BANDS:
        if len(_BANDS) > 200_000:
            _BANDS.clear()
        i, _, hi = band_of(size)
        out = [(i, hi)]
        if size * 100 // percent > hi:
            out.append((i + 1, band_of(hi + 1)[2]))
        _BANDS[key] = [(j, top * 2 * (100 - percent) // (100 + percent)) for j, top in out]
    return _BANDS[key]


def scheme(k: int, thin: bool = False) -> tuple[int, int, int]:
    """(n1, n2, k2) for a greatest difference k. A fifth more partitions than the
    least number, so that a pair agrees on several of them; for ``thin`` sets
    subsets of two cells in three, which are seldom void."""
    if k == 0:
        return 1, 1, 0
    if thin:
        return k // 2 + 2 + k * 3 // 20, 3, 1
    if k < 20:
        return k + 3 + k // 5, 1, 0
    return k // 2 + 2 + k // 5, 2, 1


def _contents(grams: np.ndarray, band: int, k: int, thin: bool) -> tuple[np.ndarray, np.ndarray]:
    """(names, numbers of features) of the subsets of cells that tell a similar set
    of the band: all but the ``agreed - 1`` with the fewest features."""
    n1, n2, k2 = scheme(k, thin)
    cell = ((grams >> np.uint64(11)) % np.uint64(n1 * n2)).astype(np.int64)
    sums = np.zeros(n1 * n2, np.uint64)
    np.add.at(sums, cell, grams)
    sums = sums.reshape(n1, n2)
    subsets = np.array(list(combinations(range(n2), n2 - k2)))
    # one name per partition and subset, from the sums of the subset's cells
    key = np.arange(n1 * len(subsets), dtype=np.uint64).reshape(n1, -1)
    with np.errstate(over="ignore"):
        for column in subsets.T:
            key = key * np.uint64(0x9FB21C651E98DF25) + sums[:, column]
    key = mix(key.ravel(), 16 + 2 * band + thin)
    held = np.bincount(cell, minlength=n1 * n2).reshape(n1, n2)[:, subsets].sum(2).ravel()
    agreed = n1 - k // (k2 + 1)         # partitions that a similar pair agrees on at least
    kept = np.lexsort((key, held))[agreed - 1:]
    return key[kept], held[kept]


def signatures(grams: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The set's signatures. A similar pair agrees on ``agreed`` subsets or more; in
    the order of (features in the subset, name), which is the same for both, the
    last of them is kept by both if each leaves out its first ``agreed - 1``. So the
    subsets that say least go, first those without a feature, which unlike sets
    share by the thousand.

    A thin set has so many void subsets that some would stay. They go as well, and
    it has signatures of a second scheme: two similar thin sets share one of those,
    and a thin one shares a filled subset with any other, which has fewer void ones
    than the pair agrees on. Only where the second scheme is thin too void subsets
    are named."""
    out = []
    for band, k in instances(len(grams), percent):
        key, held = _contents(grams, band, k, False)
        out.append(key[held > 0])
        if not held[0]:
            out.append(_contents(grams, band, k, True)[0])
    return np.concatenate(out)


def sketch(grams: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity of the number of features per hash cell: the bits in which two
    sketches differ are at most the features in which the sets differ. The low
    bits of a hash name its cell, so a sketch is cut to half its bits by the
    exclusive or of its halves."""
    cells = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(cells).view(np.int64)


def fine_sketch(grams: np.ndarray) -> np.ndarray:
    """A sketch whose bits grow with the set. With far fewer bits than features a
    sketch of unlike sets differs in half of its bits and no more, which says
    nothing about long texts."""
    return sketch(grams, min(FINE, max(BITS, 1 << (max(1, len(grams)) - 1).bit_length())))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Sketches (one a row) cut to ``size`` words."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _lists(rows: list[np.ndarray], size: int | None = None) -> pa.ListArray:
    """Rows of 64-bit integers as an Arrow list column."""
    ends = np.arange(len(rows) + 1) * size if size else np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                     T.StructField("node", T.LongType()), T.StructField("check", T.LongType()),
                     T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("fine", T.ArrayType(T.LongType()))])


def doc_sets(docs: DataFrame, seed: int, width: int) -> DataFrame:
    """(doc_id, n, node, check, sketch, fine): size, 2 x 64-bit hash and coarse and
    fine sketch of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, check, bits, fine = [], [], [], [], []
            for text in batch.column(1):
                grams = shingles(text.as_py(), width)
                n.append(len(grams))
                own = names(grams, seed)
                node.append(own[0])
                check.append(own[1])
                bits.append(sketch(grams))
                fine.append(fine_sketch(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64()),
                 _lists(bits, BITS // 64), _lists(fine)], names=SETS.names)
    return docs.mapInArrow(run, SETS)


SIGNED = T.StructType([T.StructField("sig", T.LongType()), T.StructField("node", T.LongType())])


def signed(docs: DataFrame, seed: int, width: int, percent: int) -> DataFrame:
    """(sig, node) of every distinct set of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            sigs, nodes = [], []
            for text in batch.column(1):
                grams = shingles(text.as_py(), width)
                if not len(grams):
                    continue
                node = names(grams, seed)[0]
                if node in known:
                    continue
                if len(known) > 500_000:
                    known.clear()
                known.add(node)
                own = signatures(grams, percent).view(np.int64)
                sigs.append(own)
                nodes.append(np.full(len(own), node))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(nodes))], names=SIGNED.names)
    return docs.mapInArrow(run, SIGNED)


def sketch_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def plausible(n_a: Column, n_b: Column, dist: Column, percent: int) -> Column:
    """No similar pair fails this: sizes and sketches bound the similarity."""
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
            & (dist * (100 + percent) <= (n_a + n_b) * (100 - percent)))


def exact_sets(docs: DataFrame, members: DataFrame, seed: int, width: int) -> DataFrame:
    """(node, grams) of the nodes in ``members`` (node, first_doc), from one
    document each. Of rows that share an id only those with the node's own set
    count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, grams = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = shingles(text.as_py(), width)
                if names(own, seed)[0] == node:
                    nodes.append(node)
                    grams.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(grams)], names=["node", "grams"])
    chosen = docs.join(members, docs["row_key"] == members["first_doc"]).select("node", "text")
    return written(chosen.mapInArrow(run, "node long, grams array<long>").dropDuplicates(["node"]), "jaccard-sets")


class ExactSets:
    """Exact sets of the nodes asked for so far, each fetched from its text once."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, seed: int, width: int, percent: int):
        self.docs, self.nodes, self.seed, self.tables = docs, nodes, seed, []
        self.width, self.percent = width, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose exact sets are similar enough."""
        used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        for t in self.tables:
            used = used.join(t.select("node"), "node", "left_anti")
        members = written(used.join(self.nodes.select("node", "first_doc"), "node"), "jaccard-used")
        if not members.isEmpty():
            self.tables.append(exact_sets(self.docs, members, self.seed, self.width))
        discard(members)
        if not self.tables:            # no pair so far
            return pairs.select("a", "b")
        sets = reduce(DataFrame.unionByName, self.tables)
        left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
        right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("ga", "gb"))
        return written(both.where(common * 100 >= (F.size("ga") + F.size("gb") - common) * self.percent).select("a", "b"), "jaccard-links")


PAIRS = "a long, b long, dist int"


def _across(nearest: bool, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, i, j): plausible pairs of nodes of different
    groups, block i against block j of a bucket; with ``nearest`` only the
    closest few of a node's partners there. Holds one block pair at a time."""
    held: list[pa.RecordBatch] = []

    def emit(rows: pa.Table):
        if rows.num_rows < 2:
            return
        cols = {c: rows.column(c).to_numpy() for c in ("bucket", "i", "j", "block", "node", "grp", "n")}
        lists = rows.column("fine").combine_chunks()
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy())
        length = np.diff(ends, prepend=0)
        change = np.flatnonzero((np.diff(cols["bucket"]) != 0) | (np.diff(cols["i"]) != 0) | (np.diff(cols["j"]) != 0)) + 1
        a, b, d = [], [], []
        for lo, hi in zip(np.append(0, change), np.append(change, rows.num_rows)):
            i, j = cols["i"][lo], cols["j"][lo]
            rows_i = lo + np.flatnonzero(cols["block"][lo:hi] == i)
            rows_j = rows_i if i == j else lo + np.flatnonzero(cols["block"][lo:hi] == j)
            # sketches by their own length, and cut to each shorter one in the block
            exact = {size: np.stack([flat[ends[r] - size:ends[r]] for r in lo + np.flatnonzero(length[lo:hi] == size)])
                     for size in np.unique(length[lo:hi])}
            place = np.empty(hi - lo, np.int64)
            for size in exact:
                own = length[lo:hi] == size
                place[own] = np.arange(own.sum())
            cut = {(size, to): folded(exact[size], to) for size in exact for to in exact if to <= size}
            for x in rows_i:
                y = rows_j[rows_j > x] if i == j else rows_j
                y = y[cols["grp"][y] != cols["grp"][x]]
                if not len(y):
                    continue
                nx, ny = cols["n"][x], cols["n"][y]
                y = y[np.minimum(nx, ny) * 100 >= np.maximum(nx, ny) * percent]
                if not len(y):
                    continue
                dist = np.empty(len(y), np.int64)
                for size in np.unique(length[y]):
                    to, of = min(size, length[x]), length[y] == size
                    dist[of] = np.bitwise_count(cut[size, to][place[y[of] - lo]] ^ cut[length[x], to][place[x - lo]]).sum(1, dtype=np.int64)
                ok = dist * (100 + percent) <= (nx + cols["n"][y]) * (100 - percent)
                y, dist = y[ok], dist[ok]
                if nearest and len(y) > NEAREST:
                    few = np.argsort(dist, kind="stable")[:NEAREST]
                    y, dist = y[few], dist[few]
                for z, e in zip(y, dist):
                    p, q = int(cols["node"][x]), int(cols["node"][z])
                    a.append(min(p, q))
                    b.append(max(p, q))
                    d.append(int(e))
                if len(a) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32())], names=["a", "b", "dist"])
                    a, b, d = [], [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32())], names=["a", "b", "dist"])

    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        key = np.stack([rows.column(c).to_numpy() for c in ("bucket", "i", "j")])
        # the last group may go on in the next batch
        change = np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1
        if len(change):
            yield from emit(rows.slice(0, change[-1]))
            held = rows.slice(change[-1]).combine_chunks().to_batches()
    if held:
        yield from emit(pa.Table.from_batches(held))


def open_buckets(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """(sig, node, grp) of the buckets that hold more than one group; buckets
    with the same members count once. Pairs of closed buckets are linked already."""
    marked = (buckets.select("sig", "node").distinct()
              .join(groups.select(F.col("node").alias("g_node"), "component"), F.col("node") == F.col("g_node"), "left")
              .select("sig", "node", F.coalesce("component", "node").alias("grp")))
    w = Window.partitionBy("sig")
    h = F.xxhash64("node")
    several = (marked.withColumn("lo", F.min("grp").over(w)).withColumn("hi", F.max("grp").over(w))
               .withColumn("size", F.count("*").over(w)).withColumn("f1", F.bit_xor(h).over(w))
               .withColumn("f2", F.bit_xor(F.xxhash64(F.lit(7), "node")).over(w)).where("lo <> hi"))
    return written(several.select(F.xxhash64("f1", "f2", "size").alias("sig"), "size", "node", "grp").distinct(), "jaccard-open")


def across_groups(opened: DataFrame, nodes: DataFrame, nearest: bool, percent: int) -> DataFrame:
    """(a, b, dist): plausible pairs that share a bucket but no group yet; with
    ``nearest`` only the closest partners of a node."""
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), "node"), count).cast("int")
    spread = (opened.withColumn("block", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
              .select(F.col("sig").alias("bucket"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "node", "grp"))
    full = spread.join(nodes.select(F.col("node").alias("s_node"), "n", "fine"), F.col("node") == F.col("s_node"))
    ordered = (full.select("bucket", "i", "j", "block", "node", "grp", "n", "fine")
               .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node"))
    return ordered.mapInArrow(lambda it: _across(nearest, percent, it), PAIRS).groupBy("a", "b").agg(F.min("dist").alias("dist"))


def nearest_each(pairs: DataFrame) -> DataFrame:
    """For every node the pair with the least sketch distance."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end"), F.struct("dist", "a", "b").alias("p"))
    return ends.groupBy("end").agg(F.min("p").alias("p")).select("p.a", "p.b", "p.dist").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    A text's set holds its distinct ``width``-word shingles (fewer words: the whole
    sequence; none: empty, linked with nothing). Texts are linked when their
    sets' Jaccard similarity is at least ``percent`` hundredths; ``component_id``
    is the smallest id reachable.

    Null text: empty. A row with a null id is linked with nothing and has a null
    component. Repeated rows come back each. Empty table: no rows. Extra columns
    are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    seed = 0
    while True:
        sets = written(doc_sets(plain, seed, width), "jaccard-docs")
        filled = sets.where("n > 0 and doc_id is not null")
        # equal 64-bit names of unequal sets: choose other names
        clash = filled.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y")
        if clash.isEmpty():
            break
        seed += 1
    nodes = written(filled.groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.first("n").alias("n"),
                                               F.first("sketch").alias("sketch"), F.first("fine").alias("fine")), "jaccard-nodes")
    w = Window.partitionBy("sig")
    buckets = written(signed(plain.where("doc_id is not null"), seed, width, percent).withColumn("center", F.min("node").over(w)).withColumn("far", F.max("node").over(w))
                      .where("center <> far").select("sig", "node", "center"), "jaccard-shared")
    side = nodes.select("node", "n", "sketch")
    left = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    star = buckets.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    dist = star.join(left, "a").join(right, "b").withColumn("dist", sketch_distance(F.col("sa"), F.col("sb")))
    pairs = written(dist.where(plausible(F.col("na"), F.col("nb"), F.col("dist"), percent)).select("a", "b", "dist"), "jaccard-star")
    by_key = plain.select(F.col("doc_id").alias("row_key"), "text").where("row_key is not null")
    exact = ExactSets(by_key, nodes, seed, width, percent)
    tested = written(nearest_each(pairs), "jaccard-tested")
    links = exact.links(tested)
    tested = tested.select("a", "b")
    groups = connected_components(links)
    # rounds of closest partners join most of what belongs together; then all
    # pairs that are still open are checked
    opened = open_buckets(buckets, groups)
    discard(pairs, buckets)
    for turn in range(ROUNDS + 1):
        nearest = turn < ROUNDS
        found = across_groups(opened, nodes, nearest, percent).join(tested, ["a", "b"], "left_anti")
        pairs = written(nearest_each(found) if nearest else found, "jaccard-tested")
        if pairs.isEmpty():
            if nearest:
                continue
            break
        links = links.unionByName(exact.links(pairs))
        tested = tested.unionByName(pairs.select("a", "b"))
        groups = connected_components(links)
        if nearest:
            old, opened = opened, open_buckets(opened, groups)
            discard(old)
    discard(opened, *exact.tables)
    named = (nodes.join(groups.select(F.col("node").alias("g_node"), "component"), F.col("node") == F.col("g_node"), "left")
             .select("node", "first_doc", F.coalesce("component", "node").alias("grp")))
    least = named.groupBy("grp").agg(F.min("first_doc").alias("component_id"))
    final = named.join(least, "grp").select(F.col("node").alias("f_node"), "component_id")
    return (sets.join(final, (F.col("node") == F.col("f_node")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
