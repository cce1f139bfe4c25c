"""Quality rules: base counts of every text, then the length-normalised
log-likelihood ratio of its hashed word n-grams between a trusted target and
the raw corpus.

Native DataFrame functions only. Counts leave a task as one row per n-gram
bucket, and a document is scored within its own row. Texts are shuffled once, to
meet the trusted ids, whose number has no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import let, words, written

#: Counted symbols (fixed by the contract).
SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 5


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the text.

    Windows are compared by a 64-bit hash over their word hashes. Without a
    repeat nothing is sorted; otherwise repeated windows are found as equal
    neighbours in (hash, place) order and the covered words are summed up from
    the gaps between their places.
    """
    count = F.size(hashes) - (REPEAT_WINDOW - 1)
    windows = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
        *[F.get(hashes, i + k) for k in range(REPEAT_WINDOW)]))

    def covered(win: Column) -> Column:
        ranked = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return let(ranked, lambda r: let(
            F.array_sort(F.transform(
                F.filter(r, lambda x, i: (x["h"] == F.get(r, i + 1)["h"]) | (x["h"] == F.get(r, i - 1)["h"])),
                lambda x: x["p"])),
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(REPEAT_WINDOW), F.coalesce(
                    F.get(p, i + 1) - x, F.lit(REPEAT_WINDOW)))),
                F.lit(0), lambda a, b: a + b)))

    return F.when(count < 2, F.lit(0)).otherwise(let(windows, lambda win: F.when(
        F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(covered(win)))).cast("long")


def with_base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, hashes, base_failed)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    # words twice in the list of columns: kept as a column, split once
    base = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"))
            .withColumn("text_hash", F.xxhash64("text")).withColumn("w", words(F.col("text")))
            .withColumn("hashes", F.transform("w", lambda x: F.xxhash64(x))))
    counted = base.select(
        "doc_id", "text_hash", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.col("hashes"), repeated_words).alias("n_repeat_words"), "hashes")
    return counted.withColumn("base_failed", (F.col("n_words") < 10)
                              | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def _buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all one- and two-word sequences."""
    one = F.transform(hashes, lambda h: F.pmod(F.xxhash64(F.lit(1), h), F.lit(buckets)).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.size(hashes) - 2), lambda i: F.pmod(
        F.xxhash64(F.lit(2), F.get(hashes, i), F.get(hashes, i + 1)), F.lit(buckets)).cast("int"))
    return F.when(F.size(hashes) < 2, one).otherwise(F.concat(one, two))


def ratio_table(docs: DataFrame, trusted: DataFrame, buckets: int, prior: float,
                id_col: str, text_col: str) -> DataFrame:
    """(bucket, llr): log of the bucket's share in the trusted texts over its
    share in all texts, each with ``prior`` counts more a bucket, so that a
    bucket with little evidence stays near 0. Counts cover every document."""
    mark = trusted.select(F.col("doc_id").alias("trusted_id"), F.lit(1).alias("hit"), F.lit(0).cast("long").alias("spread"))
    # null ids meet no trusted id: spread by their text
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    grams = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .join(mark.hint("merge"), (F.col("doc_id") == F.col("trusted_id")) & (spread == F.col("spread")), "left")
             .select("hit", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("hashes"))
             .select("hit", F.explode(let(F.col("hashes"), lambda h: _buckets(h, buckets))).alias("bucket")))
    counts = written(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("hit").alias("target")),
                     "ngram-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = total["raw"] or 0, total["target"] or 0
    if not target:                     # nothing to compare with: every ratio is even
        return counts.select("bucket", F.lit(0.0).alias("llr"))
    # both sides at the trusted side's size, so that the prior weighs equally
    scaled = F.col("raw") * F.lit(target / raw)
    return counts.select("bucket", F.log((F.col("target") + prior) / (scaled + prior)).alias("llr"))


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = 65536, threshold: float = -0.19,
                  prior: float = 5.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, llr, kept, text_hash) for every row of ``docs``.

    ``llr`` is the mean over all one- and two-word sequences (a text's words
    hashed to ``buckets``) of log P_trusted - log P_corpus; a document is kept
    if it passes the base rules and ``llr >= threshold``. Trusted texts are
    all those labelled ``quality`` = 1. The corpus side and the scores cover all
    documents.

    Null or blank text: no words, so the base rules fail; ``llr`` is 0. No
    labels: every ratio is 0 and the base rules alone decide. Repeated rows are
    judged each on its own, alike. Extra columns are not read.
    """
    trusted = written(labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
                      .where("doc_id is not null").distinct(), "trusted-ids")
    ratios = written(ratio_table(docs, trusted, buckets, prior, id_col, text_col), "ngram-ratios")
    base = with_base(docs, id_col, text_col)
    # one row of ``buckets`` numbers, looked up by place: no row per sequence is made
    by_place = (docs.sparkSession.range(buckets).join(ratios, F.col("id") == F.col("bucket"), "left")
                .agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("llr", F.lit(0.0)).alias("llr"))))["llr"]).scalar())
    # bound once a row: a filter on the result would paste the split into the lambdas
    total = let(F.col("hashes"), lambda h: F.aggregate(_buckets(h, buckets), F.lit(0.0), lambda a, b: a + F.get(F.col("by_place"), b)))
    n = F.greatest(2 * F.size("hashes") - 1, F.lit(1))
    scored = base.withColumn("by_place", by_place).withColumn("llr", F.when(F.size("hashes") > 0, total / n).otherwise(F.lit(0.0)))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr",
                         (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "text_hash")
