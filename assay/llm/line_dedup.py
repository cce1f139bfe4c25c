"""Line dedup: windows of three consecutive lines that occur again anywhere in
the corpus lose their later occurrences.

Native DataFrame functions only. The text itself is shuffled once, to put the
lists of lost lines back to their rows; windows travel as 128-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import let, written

WINDOW = 3


def _windows(lines: Column) -> Column:
    """Per window start: two independent 64-bit hashes of its three lines."""
    return F.transform(
        F.sequence(F.lit(0), F.size(lines) - WINDOW),
        lambda i: let(F.slice(lines, i + 1, WINDOW),
                      lambda w: F.struct(i.alias("at"), F.xxhash64(w).alias("h1"),
                                         F.xxhash64(F.lit(1), w).alias("h2"))))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               carry: list[str] | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_removed, then the columns named in ``carry``):
    every row of ``docs`` with the lines gone that lie in a repeated three-line
    window's later occurrence.

    Lines are the ``\\n``-separated parts of a text, compared as they stand.
    Occurrences are ordered by (id, text hash, line number); the first one
    stays and the covered lines of all later ones, merged, are removed. Within
    one text a later occurrence that overlaps the first one also goes.

    Null text: null comes back with no lines. Fewer than three lines: unchanged.
    Repeated rows (same id and text) are one document, so both come back alike;
    a null id sorts first. Texts that lose every line become the empty text.
    Other columns, whatever their names, are not read.
    """
    more = [F.col(f"`{c}`").alias(f"_carried_{i}") for i, c in enumerate(carry or [])]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    keyed = rows.withColumn("th", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    # a text with a window in it has at least two line breaks
    cut = (keyed.where(F.col("text").contains("\n"))
           .select("doc_id", "th", lines.alias("lines")).where(F.size("lines") >= WINDOW)
           .select("doc_id", "th", F.explode(let(F.col("lines"), _windows)).alias("w"))
           .select("doc_id", "th", F.col("w.at").alias("at"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2")))
    seen = written(cut, "line-windows")
    place = F.struct("doc_id", "th", "at")
    # pre-aggregated before the shuffle; only windows found twice go on
    first = (seen.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first <> last"))
    first = written(first, "line-repeats")
    later = seen.join(first, ["h1", "h2"]).where(place != F.col("first"))
    lost = (later.select("doc_id", "th", F.explode(F.sequence(F.col("at"), F.col("at") + (WINDOW - 1))).alias("line"))
            .groupBy("doc_id", "th").agg(F.collect_set("line").alias("lost"))
            .select(F.col("doc_id").alias("lost_id"), F.col("th").alias("lost_th"), "lost"))
    joined = keyed.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("th") == F.col("lost_th")), "left")
    # bound once a row: a filter on the result would paste the split into the lambdas
    kept = let(F.col("lines"), lambda parts: let(F.array_sort("lost"), lambda gone: let(
        F.concat(F.array(F.lit(-1)), gone, F.array(F.size(parts))),
        lambda edge: F.array_join(F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(edge) - 1),
            lambda i: F.slice(parts, F.get(edge, i - 1) + 2,
                              F.get(edge, i) - F.get(edge, i - 1) - 1))), "\n"))))
    cut_up = joined.withColumn("lines", lines)
    return cut_up.select(
        "doc_id", F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), F.lit(0)).otherwise(F.size("lost")).cast("long").alias("n_removed"),
        *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry or [])])
