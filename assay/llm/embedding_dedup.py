"""Embedding near-dedup with an inverted multi-index.

Vectors are cut in halves with a codebook each; a pair of codewords is a cell of
the product grid. Every vector visits the cells nearest to it in multi-sequence
order, as many as a measured target recall takes, and is compared there with the
vectors stored. Equal vectors are one node; a crowded cell is cut into blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import least_hashed, ready, written
from assay.llm.components import connected_components

COSINE = 0.93
BLOCK = 1024            # vectors of a cell on either side of one comparison
SAMPLE = 20_000         # vectors the codebooks are fitted on, at most
PROBES = 400            # vectors whose neighbours are all looked up to set the visits
TELLING = 100           # probes with neighbours that suffice to set the visits
SURE = 0.95             # share of synthetic neighbours found where fewer have any


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    # scaled first: squares of extreme components stay finite
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.square(v).sum(1, keepdims=True))


def codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's k-means from the first k rows; an empty codeword stays where it is."""
    centers = x[:k].copy()
    for _ in range(rounds):
        near = distances(x, centers).argmin(1)
        n = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.square(x).sum(1)[:, None] - 2 * x @ centers.T + np.square(centers).sum(1)


class MultiIndex:
    """The two codebooks and the number of cells that a query visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.first, self.second = first, second
        self.visits = visits

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def halves(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return distances(u[:, :cut], self.first), distances(u[:, cut:], self.second)

    def sequence(self, u: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, reach, own): the first ``visits`` cells of each vector by the
        sum of both halves' distances; a reach that lies between the last of
        them and the next one; the nearest cell.

        A cell at ranks (r, s) comes after (r+1)(s+1) - 1 others, so only rank
        pairs with (r+1)(s+1) <= visits + 1 are summed up and sorted.
        """
        d1, d2 = self.halves(u)
        o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
        visits = min(visits, self.cells)
        ranks = [(r, s) for r in range(d1.shape[1]) for s in range(min(d2.shape[1], (visits + 1) // (r + 1)))]
        r, s = np.array(ranks).T
        sums = np.take_along_axis(d1, o1, 1)[:, r] + np.take_along_axis(d2, o2, 1)[:, s]
        order = np.argsort(sums, 1, kind="stable")[:, :visits + 1]
        ordered = np.take_along_axis(sums, order, 1)
        cells = o1[:, r] * len(self.second) + o2[:, s]
        cells = np.take_along_axis(cells, order[:, :visits], 1)
        reach = (ordered[:, visits - 1] + ordered[:, visits]) / 2 if ordered.shape[1] > visits else np.full(len(u), np.inf)
        return cells, reach, cells[:, 0]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def fit(nodes: DataFrame, count: int) -> MultiIndex | None:
    """Codebooks from at most SAMPLE nodes in the order of a hash of their id."""
    rows = least_hashed(nodes, SAMPLE, count, "node").select("embedding").toPandas()
    if rows.empty:
        return None
    u = unit(np.stack(rows["embedding"].to_numpy()))
    k = int(np.clip(math.isqrt(max(count // 64, 1)), 4, 512))
    k = min(k, len(u))
    cut = u.shape[1] // 2
    return MultiIndex(codebook(u[:, :cut], k), codebook(u[:, cut:], k))


def synthetic_place(u: np.ndarray, index: MultiIndex) -> int:
    """Cells to visit so that SURE of the vectors at a cosine of just 0.93 to the
    probes, in random directions, would be found."""
    rng = np.random.default_rng(1)
    if u.shape[1] < 2:
        return 1
    places = []
    for x in u:
        noise = rng.normal(size=(16, len(x)))
        noise -= np.outer(noise @ x, x)
        noise /= np.maximum(np.sqrt(np.square(noise).sum(1, keepdims=True)), 1e-12)
        d1, d2 = index.halves(x[None])
        sums = np.sort((d1[0][:, None] + d2[0][None, :]).ravel())
        own = index.sequence(COSINE * x + math.sqrt(1 - COSINE ** 2) * noise, 1)[2]
        places.append(np.searchsorted(sums, d1[0][own // len(index.second)] + d2[0][own % len(index.second)] - 1e-12) + 1)
    return int(np.quantile(np.concatenate(places), SURE, method="higher"))


def set_visits(nodes: DataFrame, count: int, index: MultiIndex, recall: float) -> MultiIndex:
    """Looks up all neighbours of PROBES nodes by brute force, finds the place of
    each neighbour's cell in the probe's sequence, and visits as many cells as
    give ``recall`` of the neighbours, counted by pair and by probe. Where fewer
    than TELLING probes have neighbours, made-up neighbours of the probes at the
    least cosine have to be found as well."""
    spark = nodes.sparkSession
    probe = least_hashed(nodes, PROBES, count, F.lit(5), "node").select("node", "label", "embedding").toPandas()
    ids, labels = probe["node"].to_numpy(np.int64), probe["label"].to_numpy(np.int64)
    u = unit(np.stack(probe["embedding"].to_numpy()))
    shared = spark.sparkContext.broadcast((ids, labels, u, index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, u, index = shared.value
        d1, d2 = index.halves(u)
        sums = (d1[:, :, None] + d2[:, None, :]).reshape(len(u), -1)
        sums.sort(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = unit(_matrix(batch.column(2)))
            near = (u @ v.T >= COSINE) & (labels[:, None] == batch.column(1).to_numpy()) & (ids[:, None] != batch.column(0).to_numpy())
            q, m = np.nonzero(near)
            if len(q):
                own = index.sequence(v[m], 1)[2]
                d = d1[q, own // len(index.second)] + d2[q, own % len(index.second)]
                place = np.array([np.searchsorted(sums[i], x - 1e-12) + 1 for i, x in zip(q, d)])
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(place.astype(np.int64))], names=["probe", "place"])

    found = nodes.select("node", "label", "embedding").mapInArrow(run, "probe long, place long")
    seen = found.groupBy("probe", "place").count().toPandas()       # at most PROBES x cells rows
    need = synthetic_place(u, index) if seen["probe"].nunique() < TELLING else 1
    if not seen.empty:
        share = seen["count"] / seen.groupby("probe")["count"].transform("sum")
        for weight in (seen["count"], share):
            by = weight.groupby(seen["place"]).sum().sort_index().cumsum()
            need = max(need, int(by.index[np.searchsorted(by.to_numpy(), recall * by.iloc[-1] - 1e-9)]))
    return MultiIndex(index.first, index.second, max(need, 4))


ROLE = "label int, cell int, role int, node long, copies long, reach double, own int, embedding array<{kind}>"


def _roles(index: MultiIndex, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Role 0: a node stored in its cell; role 1: a node visiting a cell."""
    for batch in batches:
        k = batch.num_rows
        if not k:
            continue
        cells, reach, own = index.sequence(unit(_matrix(batch.column(3))), index.visits)
        take = np.concatenate([np.arange(k), np.repeat(np.arange(k), cells.shape[1])])
        where = np.concatenate([own, cells.ravel()]).astype(np.int32)
        role = np.repeat(np.array([0, 1], np.int32), [k, cells.size])
        rows = batch.take(pa.array(take))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(where), pa.array(role), rows.column(1), rows.column(2),
             pa.array(reach[take]), pa.array(own[take].astype(np.int32)), rows.column(3)],
            names=["label", "cell", "role", "node", "copies", "reach", "own", "embedding"])


FOUND = "node long, links long, other long"


def _compare(index: MultiIndex, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (label, cell, member block, visitor block). For each group:
    (node, links) counts, and links (node, other) that span the same components
    as all links of the group."""
    held: list[pa.RecordBatch] = []
    names = ("label", "cell", "mb", "vb")

    def group(rows: pa.Table):
        role = rows.column("role").to_numpy()
        member, visitor = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(member) or not len(visitor):
            return
        u = unit(rows.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(role), -1))
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        own, reach = rows.column("own").to_numpy(), rows.column("reach").to_numpy()
        near = u[visitor] @ u[member].T >= COSINE
        near &= node[visitor][:, None] != node[member][None, :]
        v, m = np.nonzero(near)
        if not len(v):
            return
        # found from both sides: counted where the smaller node visits
        width = len(index.second)
        d1, d2 = index.halves(u[member])
        back = d1[m, own[visitor[v]] // width] + d2[m, own[visitor[v]] % width] <= reach[member[m]]
        take = ~back | (node[visitor[v]] < node[member[m]])
        a, b = visitor[v[take]], member[m[take]]
        if not len(a):
            return
        links = np.bincount(a, copies[b], len(role)) + np.bincount(b, copies[a], len(role))
        linked = np.flatnonzero(links)
        yield node[linked], links[linked].astype(np.int64), np.full(len(linked), -1, np.int64), np.zeros(len(linked), bool)
        # labels by minimum over links, until none changes
        root = np.arange(len(role))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        ends = linked[root[linked] != linked]
        yield node[ends], np.zeros(len(ends), np.int64), node[root[ends]], np.ones(len(ends), bool)

    def emit(rows: pa.Table):
        key = np.stack([rows.column(c).to_numpy() for c in names])
        cut = np.concatenate([[0], np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1, [rows.num_rows]])
        for lo, hi in zip(cut, cut[1:]):
            if hi - lo > 1:
                for n, c, o, is_edge in group(rows.slice(lo, hi - lo)):
                    if len(n):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(n), pa.array(c), pa.array(o, mask=~is_edge)], names=["node", "links", "other"])

    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        key = np.stack([rows.column(c).to_numpy() for c in names])
        change = np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1
        if len(change):
            yield from emit(rows.slice(0, change[-1]))
            held = rows.slice(change[-1]).combine_chunks().to_batches()
    if held:
        yield from emit(pa.Table.from_batches(held))


def _named(nodes: DataFrame, count: int, kind: str, recall: float) -> DataFrame:
    """(n_label, n_embedding, found: links of each copy, component) of the nodes,
    which have one length."""
    spark = nodes.sparkSession
    index = set_visits(nodes, count, fit(nodes, count), recall)
    shared = spark.sparkContext.broadcast(index)
    roles = written(nodes.select("label", "node", "copies", "embedding")
                    .mapInArrow(lambda it: _roles(shared.value, it), ROLE.format(kind=kind)), "imi-roles")
    load = roles.groupBy("label", "cell").agg(
        F.ceil(F.sum(1 - F.col("role")) / BLOCK).cast("int").alias("n_mb"), F.ceil(F.sum("role") / BLOCK).cast("int").alias("n_vb"))
    load = load.where("n_mb > 0").select(F.col("label").alias("l_label"), F.col("cell").alias("l_cell"), "n_mb", "n_vb")
    placed = roles.join(load, (F.col("label") == F.col("l_label")) & (F.col("cell") == F.col("l_cell")))

    def block(n: str):
        return F.pmod(F.xxhash64(F.lit(9), "node"), F.col(n)).cast("int")

    def every(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)
    spread = (placed.withColumn("mb", F.explode(F.when(F.col("role") == 0, F.array(block("n_mb"))).otherwise(every("n_mb"))))
              .withColumn("vb", F.explode(F.when(F.col("role") == 1, F.array(block("n_vb"))).otherwise(every("n_vb")))))
    ordered = (spread.select("label", "cell", "mb", "vb", "role", "node", "copies", "reach", "own", "embedding")
               .repartition("label", "cell", "mb", "vb").sortWithinPartitions("label", "cell", "mb", "vb"))
    found = written(ordered.mapInArrow(lambda it: _compare(shared.value, it), FOUND), "imi-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = connected_components(edges)
    return (nodes.select("label", "embedding", "node", "copies")
            .join(links.select(F.col("node").alias("k_node"), "links"), F.col("node") == F.col("k_node"), "left")
            .join(groups.select(F.col("node").alias("g_node"), "component"), F.col("node") == F.col("g_node"), "left")
            .select(F.col("label").alias("n_label"), F.col("embedding").alias("n_embedding"),
                    (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("found"),
                    F.coalesce("component", "node").alias("component")))


def embedding_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         label_col: str = "label", recall: float = 0.995) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors are linked when their labels are equal and not null and their
    cosine is at least 0.93 in double precision; every reported link is checked,
    ``recall`` of them are found as measured on the probes. ``component_id`` is
    the smallest id reachable and ``kept`` says it is the row's own.

    Vectors of different lengths are not linked; each length has an index of its
    own. Vectors that are null or zero or that hold a null or non-finite component
    link with nothing; so do rows with a null label or a null id (component null,
    kept true). Repeated rows are copies linked with each other. Empty table: no
    rows. Extra columns are not read. Components are taken as they are stored,
    single or double.
    """
    spark = vectors.sparkSession
    ready(spark, 2048)
    kind = "float" if vectors.schema[vector_col].dataType.elementType == T.FloatType() else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
                          F.col(vector_col).cast(f"array<{kind}>").alias("embedding"))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    every = written(rows.where(fine).groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
                    .withColumn("length", F.size("embedding")), "imi-nodes")
    # a row a length
    lengths = sorted((r["length"], r["count"]) for r in every.groupBy("length").count().collect())
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    named = reduce(DataFrame.unionByName, [
        _named(every.where(F.col("length") == n).drop("length"), count, kind, recall) for n, count in lengths])
    own = rows.join(named, (F.col("label") == F.col("n_label")) & (F.col("embedding") == F.col("n_embedding"))
                    & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return own.select("vec_id", F.coalesce("found", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
