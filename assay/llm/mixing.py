"""Mixing sources to target weights: temperature-scaled token shares, an
exponent found by bisection, and block permutations within a token budget.

Native DataFrame functions only; document texts are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay.llm.common import running, words, written

#: Exponents are multiples of 2**-EXPONENT_BITS, so every engine finds the same one.
EXPONENT_BITS = 20
#: Levels of the bisection tree that one aggregation evaluates.
LEVELS = 5


def source_shares(sized: DataFrame) -> DataFrame:
    """(source, tokens): token total of every source; null is a source of its own."""
    return sized.groupBy("source").agg(F.sum("size").cast("long").alias("tokens"))


def _evaluate(shares: DataFrame, total: int, steps: list[int], budget: int) -> dict[int, tuple[float, float]]:
    """step -> (entropy, greatest repetition) of the weights share**exponent / sum."""
    grid = F.explode(F.array(*[F.lit(int(k)) for k in steps])).alias("k")
    log_share = F.log(F.col("tokens") / F.lit(float(total)))
    powered = shares.select("tokens", log_share.alias("lp"), grid).withColumn(
        "x", F.col("k") / F.lit(float(1 << EXPONENT_BITS)) * F.col("lp"))
    got = powered.groupBy("k").agg(
        F.sum(F.exp("x")).alias("z"), F.sum(F.exp("x") * F.col("x")).alias("zx"),
        F.max(F.exp("x") / F.col("tokens")).alias("top")).collect()
    return {r["k"]: (math.log(r["z"]) - r["zx"] / r["z"], r["top"] / r["z"] * budget) for r in got}


def find_exponent(shares: DataFrame, budget: int, entropy_gain: float = 0.5,
                  max_repeats: float = 4.0) -> int:
    """The exponent, in steps of 2**-EXPONENT_BITS, that flattens the shares
    until their entropy has covered ``entropy_gain`` of the way from its own
    value to that of even weights, unless a source would then be repeated more
    than ``max_repeats`` times within ``budget`` tokens; then the smallest
    exponent that keeps that limit (1, the plain shares, if none does).

    Both quantities are monotone in the exponent, so each is bisected; the
    driver sees a few numbers a round, never the sources.
    """
    whole = 1 << EXPONENT_BITS
    stats = shares.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not stats["n"]:
        return whole
    known = _evaluate(shares, stats["t"], [whole], budget)
    target = known[whole][0] + entropy_gain * (math.log(stats["n"]) - known[whole][0])

    def enough(k: int) -> bool:        # true for small exponents
        return known[k][0] >= target

    def within(k: int) -> bool:        # true for large exponents
        return known[k][1] <= max_repeats

    flat, calm = [0, whole], [-1, whole]
    while flat[1] - flat[0] > 1 or calm[1] - calm[0] > 1:
        steps = sorted({m for lo, hi in (flat, calm) for m in _middles(lo, hi, LEVELS)} - set(known))
        if steps:
            known |= _evaluate(shares, stats["t"], steps, budget)
        for _ in range(LEVELS):
            if flat[1] - flat[0] > 1:
                mid = (flat[0] + flat[1]) // 2
                flat[0 if enough(mid) else 1] = mid
            if calm[1] - calm[0] > 1:
                mid = (calm[0] + calm[1]) // 2
                calm[1 if within(mid) else 0] = mid
    return max(whole if enough(whole) else flat[0], calm[1])


def _middles(lo: int, hi: int, levels: int) -> list[int]:
    """All midpoints that ``levels`` halvings of (lo, hi) can visit."""
    if levels == 0 or hi - lo <= 1:
        return []
    mid = (lo + hi) // 2
    return [mid, *_middles(lo, mid, levels - 1), *_middles(mid, hi, levels - 1)]


def _draw(*parts: Column) -> Column:
    """md5 of the parts, a null written as a bar-free marker."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))


def block_of(blocks: int) -> Column:
    """The block of a place ``start`` in a part, start * blocks div part. In
    decimals: the product passes 64 bits on large corpora, and a quotient of
    doubles could cross a block's edge."""
    return F.expr(f"cast(cast(start as decimal(20,0)) * cast({blocks} as decimal(16,0)) div cast(part as decimal(20,0)) as long)")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", budget_tokens: int | None = None,
                entropy_gain: float = 0.5, max_repeats: float = 4.0,
                block_tokens: int = 65536, seed: int = 11) -> DataFrame:
    """One row per document drawn: (doc_id, text_hash, source, n_tokens, epoch, start,
    block, slot, weight).

    Sizes are word counts, at least 1. A source with weight w fills
    ``floor(w * budget)`` tokens (budget: the corpus' own total unless given):
    its documents stand in an order drawn anew per epoch, ``start`` is the
    tokens before a document over all epochs, and a document is drawn while its
    start lies within the source's part. ``block`` numbers equal slices of the
    budget, each holding every source at its weight; ``slot`` is a drawn
    permutation inside the block.

    Null source: a source of its own. Null, empty or blank text: size 1.
    Repeated rows (same id and text) are one document. Empty table: no rows.
    Extra columns are not read, whatever their names.
    """
    sized = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    F.greatest(F.size(words(F.col(text_col))), F.lit(1)).cast("long").alias("size"),
                    F.xxhash64(F.col(text_col)).alias("th"))
        .dropDuplicates(["doc_id", "source", "th"])
        # a text stand-in for null, so that joins on the source are plain equalities
        .withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))), "mix-sizes")
    shares = written(source_shares(sized), "mix-shares")
    total = shares.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget_tokens is None else int(budget_tokens)
    step = find_exponent(shares, budget, entropy_gain, max_repeats)
    power = F.exp(F.lit(step / float(1 << EXPONENT_BITS)) * F.log(F.col("tokens") / F.lit(float(total or 1))))
    z = shares.agg(F.sum(power)).first()[0] or 1.0
    plan = shares.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("~")).alias("p_src"), "tokens", (power / F.lit(z)).alias("weight")
    ).withColumn("part", F.floor(F.col("weight") * F.lit(budget)).cast("long"))
    epochs = F.ceil(F.col("part") / F.col("tokens")).cast("int")
    # one row per source: Spark broadcasts it only while it is small
    spread = (sized.join(plan, sized["src"] == plan["p_src"]).drop("p_src").where("part > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
              .withColumn("draw", _draw(F.lit(seed), F.col("epoch"), F.col("doc_id"))))
    rows = sized.count()
    placed = running(spread, ["src", "epoch"], "draw", ["doc_id", "th"], "size", "within", rows)
    drawn = (placed.withColumn("start", F.col("epoch") * F.col("tokens") + F.col("within"))
             .where(F.col("start") < F.col("part")))
    blocks = max(1, math.ceil(budget / block_tokens))
    numbered = drawn.withColumn("block", block_of(blocks))
    order = Window.partitionBy("block").orderBy("shuffle", "doc_id", "th", "epoch")
    return (numbered.withColumn("shuffle", _draw(F.lit(seed + 1), F.col("epoch"), F.col("doc_id")))
            .withColumn("slot", (F.row_number().over(order) - 1).cast("long"))
            .select("doc_id", F.col("th").alias("text_hash"), "source", F.col("size").alias("n_tokens"),
                    F.col("epoch").cast("long").alias("epoch"), "start", "block", "slot", "weight"))
