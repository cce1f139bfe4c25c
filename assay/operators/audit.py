"""Data-quality and exploration audits (QA1-QA9, AG12, AG14-AG16, IO15).

Every audit is one aggregation pass (map-side partial, then a tiny final
aggregate) returning a small DataFrame; nothing is collected to the driver.
Wide one-row results are turned into long form with ``inline(array(struct))``
on that single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from assay import constants as K
from assay.functions.scalar import is_known_verdict, place_among, safe_ratio


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _unpivot(one_row: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn a one-row frame into len(rows) rows; each row is a list of
    (field name, expression over the one-row frame)."""
    structs = [F.struct(*[e.alias(n) for n, e in r]) for r in rows]
    return one_row.select(F.inline(F.array(*structs)))


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """SO2: the first ``n`` rows. With ``order_by`` (default: the first
    column) it is a deterministic top-n (TakeOrderedAndProject), not whatever
    rows the first task returns."""
    cols = list(order_by) if order_by else [df.columns[0]]
    return df.orderBy(*[_q(c) for c in cols]).limit(n)


def grain_check(df: DataFrame, key: str = K.SERIAL) -> DataFrame:
    """QA1/AG12: rows vs distinct keys; one row per key iff equal."""
    return (df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct(_q(key)).alias("unique_keys"))
            .withColumn("one_row_per_key", F.col("total_rows") == F.col("unique_keys")))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AG14: one row, the number of NULLs of every column (same names)."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG15: ``describe()`` with numbers instead of strings: rows
    count / mean / stddev / min / max, one column per feature, one pass."""
    aggs = []
    for i, c in enumerate(columns):
        x = _q(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"c{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"n{i}"),
                 F.max(x).alias(f"x{i}")]
    one = df.agg(*aggs)
    rows = []
    for stat, p in [("count", "c"), ("mean", "a"), ("stddev", "s"), ("min", "n"), ("max", "x")]:
        rows.append([("summary", F.lit(stat))] +
                    [(c, F.col(f"{p}{i}")) for i, c in enumerate(columns)])
    return _unpivot(one, rows)


def label_means(df: DataFrame, columns: Sequence[str], label: str = K.LABEL,
                digits: int | None = None) -> DataFrame:
    """AG16: feature means per label (the reference shows them to 3 decimals)."""
    def m(c):
        a = F.avg(_q(c))
        return (F.round(a, digits) if digits is not None else a).alias(c)
    return df.groupBy(label).agg(*[m(c) for c in columns]).orderBy(label)


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """QA4: per numeric column min, max, NULL count and whether it is constant
    (one distinct non-NULL value, or all NULL)."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.min(x).alias(f"n{i}"), F.max(x).alias(f"x{i}"),
                 F.count_if(x.isNull()).alias(f"z{i}")]
    one = df.agg(*aggs)
    rows = [[("column", F.lit(c)), ("min", F.col(f"n{i}")), ("max", F.col(f"x{i}")),
             ("nulls", F.col(f"z{i}")),
             ("is_constant", F.coalesce(F.col(f"n{i}") == F.col(f"x{i}"), F.lit(True)))]
            for i, c in enumerate(cols)]
    return _unpivot(one, rows)


def contradictory_results(lines: DataFrame, key: str = K.SERIAL,
                          line_label_col: str = "LAB") -> DataFrame:
    """QA5: units with a verdict, re-tested units (> 1 test), units whose
    tests disagree (min label <> max label), units with a positive."""
    per = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                 F.min(line_label_col).alias("lo"),
                                 F.max(line_label_col).alias("hi"))
    return per.agg(F.count(F.lit(1)).alias("units"),
                   F.count_if(F.col("hi") == 1).alias("positives"),
                   F.count_if(F.col("n") > 1).alias("retested"),
                   F.count_if(F.col("lo") != F.col("hi")).alias("contradictory"))


def unknown_verdicts(results: DataFrame, result: str = K.RESULT) -> DataFrame:
    """Verdict values other than 'G' / 'W' (NULL, padded, lower case...) with
    their counts: they all become label 0 and must be visible."""
    r = F.col(result)
    return (results.where(~is_known_verdict(r))
            .groupBy(r.alias("verdict")).agg(F.count(F.lit(1)).alias("count")))


#: Rows of a chunk of ordered rows; at most so many chunks, a power of two.
ROWS_A_CHUNK = 4_000_000
MOST_CHUNKS = 1024


def _cut_points(rows: DataFrame, place: Column, chunks: int, count: int) -> Column:
    """Scalar: ``MOST_CHUNKS`` - 1 ascending cut points of ``place`` over the rows,
    from a sample drawn by hash (64 rows a cut point), the same in every run."""
    want = 64 * MOST_CHUNKS
    h = F.xxhash64(place)
    some = rows.select(place.alias("_p"), h.alias("_h"))
    if count > want:
        some = some.where(F.col("_h") < F.lit(int(-(1 << 63) + (1 << 64) * (want / count))))
    ordered = some.agg(F.sort_array(F.collect_list("_p")).alias("_all"))
    pick = F.transform(F.sequence(F.lit(1), F.lit(MOST_CHUNKS - 1)),
                       lambda i: F.get(F.col("_all"), F.floor(i * F.size("_all") / F.lit(MOST_CHUNKS)).cast("int")))
    return ordered.select(pick).scalar()


def time_inversions(series: DataFrame, key: str = K.SERIAL, ts: str = K.TS,
                    order: Sequence[str] = (), chunks: int | None = None) -> DataFrame:
    """QA6: share of consecutive pairs (in arrival ``order``) whose time goes
    backwards (strictly; an equal second is not an inversion).

    A plain ``lag`` over ``partitionBy(key)`` puts a whole unit in one task;
    a unit holding a third of the data would be one task. Rows are cut into
    chunks by cut points of (key, order), as many as the number of rows asks for;
    a row's chunk is a pure function of the row. ``lag`` and the aggregation run
    per (key, chunk) behind one exchange; the first row of a chunk is compared
    with the last one of the key's previous chunk in a table of at most (#keys +
    #chunks) rows.
    """
    if not order:
        raise ValueError("time_inversions needs the arrival order columns (a total "
                         "order within a unit); without them 'consecutive' is undefined")
    rows = series.select(key, ts, *[c for c in order if c not in (key, ts)])
    count = rows.count()
    n = min(MOST_CHUNKS, chunks or -(-count // ROWS_A_CHUNK))
    place = F.struct(F.col(key), *[F.col(c) for c in order])
    chunk = F.lit(0)
    if n > 1:
        rows = rows.withColumn("_cuts", _cut_points(rows, place, n, count))
        chunk = F.floor(place_among(place, F.col("_cuts"), MOST_CHUNKS - 1) * F.lit(n) / F.lit(MOST_CHUNKS)).cast("int")
    ordering = [F.col(c) for c in order]
    w = Window.partitionBy(key, "_chunk").orderBy(*ordering)
    per = (rows.withColumn("_chunk", chunk).drop("_cuts").withColumn("_prev", F.lag(ts).over(w))
           .groupBy(key, "_chunk").agg(
               F.count("_prev").alias("_pairs"), F.count_if(F.col(ts) < F.col("_prev")).alias("_inversions"),
               F.min_by(F.col(ts), F.struct(*ordering)).alias("_first"),
               F.max_by(F.col(ts), F.struct(*ordering)).alias("_last")))
    above = Window.partitionBy(key).orderBy("_chunk")
    total = per.withColumn("_before", F.lag("_last").over(above)).agg(
        F.coalesce(F.sum("_pairs") + F.count("_before"), F.lit(0)).alias("pairs"),
        F.coalesce(F.sum("_inversions") + F.count_if(F.col("_first") < F.col("_before")), F.lit(0)).alias("inversions"))
    return total.withColumn("share", safe_ratio(F.col("inversions"), F.col("pairs")))


def sequence_variability(series: DataFrame, sensors: Sequence[str],
                         key: str = K.SERIAL) -> DataFrame:
    """QA7 (our definition; the reference gives none): coefficient of
    variation of the per-unit means, ``stddev(mean_i) / |avg(mean_i)|``."""
    means = series.groupBy(key).agg(*[F.avg(_q(s)).alias(s) for s in sensors])
    one = means.agg(*[F.stddev_samp(_q(s)).alias(f"s{i}") for i, s in enumerate(sensors)],
                    *[F.avg(_q(s)).alias(f"a{i}") for i, s in enumerate(sensors)])
    rows = [[("sensor", F.lit(s)),
             ("variability", F.try_divide(F.col(f"s{i}"), F.abs(F.col(f"a{i}"))))]
            for i, s in enumerate(sensors)]
    return _unpivot(one, rows)


def parse_failures(df: DataFrame, parsed_from: Mapping[str, str]) -> DataFrame:
    """QA9: for each parsed column, how many non-NULL inputs became NULL."""
    aggs, rows = [], []
    for i, (out, src) in enumerate(parsed_from.items()):
        aggs += [F.count(_q(src)).alias(f"i{i}"),
                 F.count_if(_q(src).isNotNull() & _q(out).isNull()).alias(f"f{i}")]
        rows.append([("column", F.lit(out)), ("non_null_input", F.col(f"i{i}")),
                     ("failed", F.col(f"f{i}"))])
    return _unpivot(df.agg(*aggs), rows)


def layer_counts(layers: Mapping[str, DataFrame],
                 key: str | None = None) -> DataFrame:
    """IO15: one row per table: rows (and distinct keys when the table has
    ``key``), as a union of one-row aggregates instead of N driver counts."""
    out = None
    for name, df in layers.items():
        aggs = [F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")]
        aggs.append((F.count_distinct(_q(key)) if key and key in df.columns
                     else F.lit(None).cast("long")).alias("units"))
        one = df.agg(*aggs)
        out = one if out is None else out.unionByName(one)
    return out
