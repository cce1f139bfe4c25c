"""Prefix trie of conversations: one row for every distinct sequence of first
turns, with its members, children, leaves and what sharing it saves.

A prefix has a 128-bit digest: the exclusive or of its turns' hashes, each hash
made with the turn's place. Running digests need no text, and a conversation's
turns may lie in several partitions. A count-min sketch of all digests proves
most long prefixes unique: from the first depth whose estimate is one a
conversation shares nothing, and its tail of nodes is emitted from its own rows.
Only prefixes that may be shared are shuffled and grouped exactly.

Sums over subtrees are taken over the grouped nodes alone, by doubling: after
round k a node holds the sum over its descendants nearer than 2**k and points at
its ancestor at that distance. The number of rounds is the logarithm of the
greatest shared depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay.llm import count_min
from assay.llm.common import discard, ready, written

HUNDRED = 100           # conversations that share the first turns of one
HEAD = 6                # their number is a checksum modulo this
SEGMENT = 13            # bits of an id within a segment of members


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv, chunk, pos, h1, h2, chars): every turn with its place from 0 in its
    conversation, a 128-bit hash of (role, text), and the text's code points.

    Rows are range-partitioned by (conversation, order), so a conversation with a
    large share of all turns spans many tasks; ``chunk`` is the partition."""
    order = ["conv", "turn", "role", "text"]
    plain = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # ascending puts null turns first
    dealt = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = written(dealt.select("conv", F.monotonically_increasing_id().alias("ord"), F.xxhash64("role", "text").alias("h1"),
                                 F.xxhash64(F.lit(1), "role", "text").alias("h2"), F.char_length("text").cast("long").alias("chars"))
                    .withColumn("chunk", F.shiftright("ord", 33)), "turns")
    spans = turns.groupBy("conv", "chunk").agg(F.min("ord").alias("first"), F.count("*").alias("n"))
    # a row a conversation and partition
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(F.col("conv").alias("s_conv"), F.col("chunk").alias("s_chunk"), "first",
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return turns.join(starts, (F.col("conv") == F.col("s_conv")) & (F.col("chunk") == F.col("s_chunk"))).select(
        "conv", "chunk", (F.col("offset") + F.col("ord") - F.col("first")).alias("pos"), "h1", "h2", "chars")


def shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt: the first h turns of conversation c - c % 100
    (all if it has fewer, none if there is no such conversation), then c's own
    turns after its first h; h = crc32(decimal c) % 6. Returns (conv, size) and
    turns like ``ranked_turns`` with new places."""
    counted = turns.groupBy("conv").agg(F.count("*").alias("n"), F.min("chunk").alias("first_chunk"))
    convs = counted.select("conv", "n", "first_chunk", (F.crc32(F.col("conv").cast("string")) % HEAD).alias("h"),
                           (F.col("conv") - F.col("conv") % HUNDRED).alias("base"))
    bases = counted.where(F.col("conv") % HUNDRED == 0).select(F.col("conv").alias("b_conv"), F.col("n").alias("b_n"))
    sized = written(convs.join(bases, F.col("base") == F.col("b_conv"), "left")
                    .withColumn("m", F.least("h", F.coalesce("b_n", F.lit(0))))
                    .withColumn("size", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    named = sized.select(F.col("conv").alias("c"), "base", "h", "m", "size", "first_chunk")
    own = (turns.join(named, F.col("conv") == F.col("c")).where("pos >= h")
           .select("conv", "chunk", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "h1", "h2", "chars", "size"))
    heads = turns.where((F.col("conv") % HUNDRED == 0) & (F.col("pos") < HEAD - 1))
    lent = (named.join(heads, F.col("base") == F.col("conv")).where("pos < h")
            .select(F.col("c").alias("conv"), F.col("first_chunk").alias("chunk"), "pos", "h1", "h2", "chars", "size"))
    return sized.select("conv", "size"), own.unionByName(lent)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, size, depth, d1, d2, p1, p2, chars): the digest of every prefix and
    of the prefix before it. ``turns``: (conv, chunk, pos, h1, h2, chars, size)."""
    keyed = turns.select("conv", "chunk", "pos", "chars", "size",
                         *[F.xxhash64(F.lit(10 + i), "pos", "h1", "h2").alias(f"k{i}") for i in (1, 2)])
    upto = Window.partitionBy("conv", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = written(keyed.select("*", *[F.bit_xor(f"k{i}").over(upto).alias(f"r{i}") for i in (1, 2)]), "digests")
    # conversations in several partitions: what the earlier ones add, a row a partition
    whole = run.groupBy("conv", "chunk").agg(*[F.bit_xor(f"k{i}").alias(f"x{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    added = (whole.select(F.col("conv").alias("a_conv"), F.col("chunk").alias("a_chunk"),
                          *[F.bit_xor(f"x{i}").over(earlier).alias(f"e{i}") for i in (1, 2)],
                          F.row_number().over(Window.partitionBy("conv").orderBy("chunk")).alias("nth")).where("nth > 1"))
    full = run.join(added, (F.col("conv") == F.col("a_conv")) & (F.col("chunk") == F.col("a_chunk")), "left")
    digest = {i: F.col(f"r{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0))) for i in (1, 2)}
    return full.select("conv", "size", (F.col("pos") + 1).alias("depth"), digest[1].alias("d1"), digest[2].alias("d2"),
                       digest[1].bitwiseXOR(F.col("k1")).alias("p1"), digest[2].bitwiseXOR(F.col("k2")).alias("p2"), "chars")


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``cut``: the depth from which a conversation's prefixes are
    proved its own by the sketch (null: none are)."""
    spark = rows.sparkSession
    width = count_min.cells_for(rows.count())
    celled = rows.select("conv", "depth", *[count_min.cell(r, width, "d1", "d2").alias(f"cell{r}") for r in range(count_min.DEPTH)])
    bits = spark.sparkContext.broadcast(count_min.repeated_cells(
        celled.select(F.explode(F.array(*[f"cell{r}" for r in range(count_min.DEPTH)])).alias("cell")), width))

    @F.pandas_udf("boolean")
    def once(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(~(count_min.is_set(bits.value, a.to_numpy()) & count_min.is_set(bits.value, b.to_numpy())))

    cuts = (celled.where(once("cell0", "cell1")).groupBy("conv").agg(F.min("depth").alias("cut"))
            .select(F.col("conv").alias("cut_conv"), "cut"))
    return rows.join(cuts, F.col("conv") == F.col("cut_conv"), "left").drop("cut_conv")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (d1, d2, ids) sorted by node and segment -> SHA-256 of a node's ids."""
    node, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], names=["e1", "e2", "ends_sha256"])
    for batch in batches:
        out = []
        for d1, d2, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (d1, d2) != node:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (d1, d2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["e1", "e2", "ends_sha256"])
    if node:
        yield row()


def end_digests(ends: DataFrame) -> DataFrame:
    """(e1, e2, ends_sha256) of nodes at which conversations (d1, d2, conv) end:
    their ids ascending, joined by commas. Ids are joined in segments of 8,192 at
    most; the segments of a node pass through one digest, one at a time."""
    segments = (ends.groupBy("d1", "d2", F.shiftright("conv", SEGMENT).alias("segment"))
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))
    return (segments.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "segment").select("d1", "d2", "ids")
            .mapInArrow(_digests, "e1 long, e2 long, ends_sha256 string"))


def subtree_sums(nodes: DataFrame, greatest: int) -> DataFrame:
    """(v1, v2, leaves, saved): own values added up over subtrees. ``nodes``:
    (d1, d2, p1, p2 (null at the root), leaves, saved), all ancestors included."""
    state = written(nodes.select(F.col("d1").alias("v1"), F.col("d2").alias("v2"), F.col("p1").alias("a1"), F.col("p2").alias("a2"),
                                 "leaves", "saved"), "subtrees")
    reach = 1
    while reach <= greatest:
        more = (state.where("a1 is not null").groupBy("a1", "a2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
                .select(F.col("a1").alias("m1"), F.col("a2").alias("m2"), "more_leaves", "more_saved"))
        far = state.select(F.col("v1").alias("f1"), F.col("v2").alias("f2"), F.col("a1").alias("n1"), F.col("a2").alias("n2"))
        old, state = state, written(
            state.join(more, (F.col("v1") == F.col("m1")) & (F.col("v2") == F.col("m2")), "left")
            .join(far, (F.col("a1") == F.col("f1")) & (F.col("a2") == F.col("f2")), "left")
            .select("v1", "v2", F.col("n1").alias("a1"), F.col("n2").alias("a2"),
                    (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "subtrees")
        discard(old)
        reach *= 2
    return state.select("v1", "v2", "leaves", "saved")


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for every distinct prefix: (conv_id: the smallest member, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``convs``: (conv, size), one row each; ``turns``: (conv, chunk, pos, h1, h2,
    chars, size), places from 0 without gaps. The root is the empty prefix; all
    conversations, also those without a turn, are its members.
    """
    ready(convs.sparkSession, rows=10_000)
    rows = written(screened(written(prefixes(turns), "prefixes")), "screened")
    shared = rows.where("cut is null or depth < cut")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), F.lit(0).cast("long").alias("depth"), "conv", "n_convs",
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(0).cast("long").alias("chars"))
    grouped = written(shared.groupBy("d1", "d2").agg(
        F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
        *[F.min(c).alias(c) for c in ("p1", "p2", "chars")]).unionByName(root), "shared-nodes")
    below = (grouped.where("p1 is not null").select("p1", "p2").withColumn("tails", F.lit(0))
             .unionByName(rows.where("depth = cut").select("p1", "p2").withColumn("tails", F.lit(1)))
             .groupBy("p1", "p2").agg(F.count("*").alias("n_children"), F.sum("tails").alias("tails"))
             .select(F.col("p1").alias("b1"), F.col("p2").alias("b2"), "n_children", "tails"))
    nodes = written(grouped.join(below, (F.col("d1") == F.col("b1")) & (F.col("d2") == F.col("b2")), "left")
                    .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                    # a tail is one leaf; so is a node without children
                    .withColumn("leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("tails")))
                    .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).drop("b1", "b2", "tails"), "valued-nodes")
    greatest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(nodes, greatest)
    ends = shared.where("depth = size").select("d1", "d2", "conv").unionByName(
        convs.where("size = 0").select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "conv"))
    named = grouped.select(F.col("d1").alias("g1"), F.col("d2").alias("g2"), F.col("conv").alias("parent"))
    parent = (F.col("p1") == F.col("g1")) & (F.col("p2") == F.col("g2"))
    empty = _sha(F.lit(""))
    full = (nodes.join(named, parent, "left").join(sums, (F.col("d1") == F.col("v1")) & (F.col("d2") == F.col("v2")))
            .join(end_digests(ends), (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    sums["leaves"].alias("n_leaves"), sums["saved"].alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256")))
    tails = (rows.where("depth >= cut")
             # only a tail's first node looks for its parent; the others' is their own conversation's
             .withColumn("l1", F.when(F.col("depth") == F.col("cut"), F.col("p1"))).withColumn("l2", F.when(F.col("depth") == F.col("cut"), F.col("p2"))))
    first = tails.where("l1 is not null").join(named, (F.col("l1") == F.col("g1")) & (F.col("l2") == F.col("g2"))).select("conv", "depth", "size", "parent")
    rest = tails.where("l1 is null").select("conv", "depth", "size", F.col("conv").alias("parent"))
    ends_here = F.col("depth") == F.col("size")
    own = first.unionByName(rest).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(ends_here, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(ends_here, _sha(F.col("conv").cast("string"))).otherwise(empty).alias("ends_sha256"))
    return full.select(*NODE).unionByName(own.select(*NODE))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by turn, null first, and among equal turns by role and
    text; a null role or text is empty. Rows with a null conv_id belong to no
    conversation and are left out. Repeated rows are turns of their own. ``%`` is
    the remainder with the dividend's sign. Empty table: no rows (no
    conversation, so no root). Extra columns are not read.
    """
    turns = written(ranked_turns(conversations), "ranked-turns")
    return prefix_trie(*shared_heads(turns))
