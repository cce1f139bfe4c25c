"""Sharding by longest processing time first: groups of equal texts, largest
first, each to the shard with the least load so far."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import running, written


def fill_classes(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """LPT over (size, count) classes in falling size: (size, first, end, shard)
    ranges of the groups of each class, numbered 0..count-1.

    A heap of (load, shard) hands out one class at a time. While a class holds
    more groups than shards, whole rounds (one group to each shard) are given
    at once as soon as the loads lie within one group of each other: from then
    on the greedy rule visits every shard once a round.
    """
    loads = [(0, s) for s in range(shards)]
    heapq.heapify(loads)
    ranges = []
    for size, count in classes:
        given = [0] * shards
        left = count
        while left:
            spread = max(loads)[0] - loads[0][0]
            if left > shards and spread <= size:
                rounds = left // shards
                loads = [(load + rounds * size, s) for load, s in loads]
                heapq.heapify(loads)
                given = [g + rounds for g in given]
                left -= rounds * shards
                continue
            load, s = loads[0]
            # how many groups this shard takes before another one is lower
            others = min(loads[1:]) if shards > 1 else (load + left * size, s)
            ahead = min(left, max(1, -(-(others[0] - load) // size)))
            heapq.heapreplace(loads, (load + ahead * size, s))
            given[s] += ahead
            left -= ahead
        start = 0
        for s, n in enumerate(given):
            if n:
                ranges.append((size, start, start + n, s))
                start += n
    return ranges


def shard_groups(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    Size: UTF-8 bytes of the text plus 1. Rows of equal text form a group that
    stays in one shard; law ``bytes`` (``grown_shard`` is null). The driver sees
    the distinct group sizes with their counts only: with T bytes in all there
    are fewer than sqrt(2 T) of them, however many rows. Numbers inside a size
    class and inside a shard come from running sums over hash chunks.

    Null text: no text, grouped with empty ones. Repeated rows each get a slot.
    Null ids come first among equals. Empty table: no rows. Extra columns are
    not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"), F.sha2(text, 256).alias("grp"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("~"))).alias("draw")), "shard-rows")
    groups = written(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies"))
                     .withColumn("one", F.lit(1)), "shard-groups")
    n = groups.agg(F.count("*").alias("g"), F.sum("copies").alias("r")).first()
    classes = groups.groupBy("bytes").count().collect()
    ranges = fill_classes(sorted(((r["bytes"], r["count"]) for r in classes), reverse=True), shards)
    spark = docs.sparkSession
    # at most ``shards`` ranges a size class
    dealt = spark.createDataFrame(ranges, "r_bytes long, first long, past long, shard int")
    ranked = running(groups, ["bytes"], "grp", [], "one", "rank", n["g"] or 0)
    where = ranked.join(dealt, (F.col("bytes") == F.col("r_bytes")) & (F.col("rank") >= F.col("first"))
                        & (F.col("rank") < F.col("past"))).select(F.col("grp").alias("g_grp"), "shard")
    placed = rows.join(where, rows["grp"] == where["g_grp"]).withColumn("one", F.lit(1))
    numbered = running(placed.drop("g_grp"), ["shard"], "draw", ["doc_id", "grp"], "one", "slot", n["r"] or 0)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
