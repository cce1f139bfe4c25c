"""Verdict labelling: one worst-verdict label per unit (AG1-AG3, AG13, SC7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay import constants as K
from assay.functions.scalar import line_label


def label_lines(results: DataFrame, result: str = K.RESULT, out: str = "LAB",
                trim_result: bool = False) -> DataFrame:
    """Add the per-test 0/1 label: exactly 'W' is 1, anything else 0."""
    return results.withColumn(out, line_label(result, trim=trim_result))


def worst_label(lines: DataFrame, key: str = K.SERIAL, line_label_col: str = "LAB",
                attributes: Sequence[str] = (K.PRODUCT, K.STAND),
                order: Sequence[str] | None = None, label: str = K.LABEL,
                count_name: str = "nb_tests") -> DataFrame:
    """One row per unit: worst verdict wins (``max``), number of tests, and a
    representative value of each attribute.

    The reference takes ``first()`` after a shuffle, which depends on task
    timing. Here the representative comes from the first test in ``order``
    (a total order, e.g. test date then test id) through ``min_by``; without an
    order it is the test with the smallest attributes, compared one after the
    other and known ones first. All attributes come from that one test. ``max``, ``count`` and
    ``min_by`` all combine map-side, so a unit holding a third of all rows is
    reduced to one partial row per input partition before the shuffle.
    """
    aggs = [F.max(line_label_col).alias(label), F.count(F.lit(1)).alias(count_name)]
    if not attributes:
        return lines.groupBy(key).agg(*aggs)
    first = ([F.col(c) for c in order] if order
             else [x for a in attributes for x in (F.col(a).isNull(), F.col(a))])
    aggs.append(F.min_by(F.struct(*attributes), F.struct(*first)).alias("_one"))
    out = lines.groupBy(key).agg(*aggs)
    return out.select(key, label, count_name, *[F.col("_one")[a].alias(a) for a in attributes])


def label_distribution(units: DataFrame, label: str = K.LABEL,
                       digits: int | None = None) -> DataFrame:
    """Count and share (percent, double) of each label value, ordered by label.
    ``digits=2`` gives the reference's display rounding.

    The window for the total spans the label values only (two rows), never
    the units.
    """
    counts = units.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    pct = F.col("count").cast("double") * 100.0 / total
    return (counts
            .withColumn("percentage", F.round(pct, digits) if digits is not None else pct)
            .orderBy(label))
