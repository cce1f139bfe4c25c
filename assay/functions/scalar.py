"""Column expressions. All built-in Spark functions: they stay inside
whole-stage codegen, and never fail a job on dirty input (ANSI is on by default
in Spark 4, so every parse is a ``try_*``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from assay import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def serial_from_path(path: str | Column, scope: str = "name",
                     pattern: str = K.SERIAL_PATTERN) -> Column:
    """First 32-hex run of a file path, NULL when there is none.

    ``scope="name"`` looks at the file name only (a hex-named folder above the
    file cannot leak in); ``scope="path"`` searches the whole path as the
    reference does. ``regexp_extract`` yields '' on no match; that '' is turned
    into NULL so unmatched files never form one bogus serial.
    """
    p = col(path)
    if scope == "name":
        p = F.regexp_extract(p, r"([^/\\]*)$", 1)
    elif scope != "path":
        raise ValueError(f"scope must be 'name' or 'path', not {scope!r}")
    return F.nullif(F.regexp_extract(p, pattern, 1), F.lit(""))


def parse_timestamp(date: str | Column, time: str | Column,
                    fmt: str = K.SOURCE_TS_FORMAT) -> Column:
    """DATE + ' ' + HEURE -> timestamp; NULL when either part is missing or bad.

    ``concat_ws`` skips NULLs, so a missing DATE would leave '07:11:45'; the
    ``try_to_timestamp`` then returns NULL instead of raising.
    """
    return F.try_to_timestamp(F.concat_ws(" ", col(date), col(time)), F.lit(fmt))


def to_double(c: str | Column) -> Column:
    """String -> double, NULL for '2,5', '' or text (no ANSI failure)."""
    return F.expr(f"try_cast(`{c}` as double)") if isinstance(c, str) else c.try_cast("double")


def line_label(result: str | Column, trim: bool = False,
               anomaly: str = K.ANOMALY_VERDICT) -> Column:
    """Exactly ``RESULT == 'W'`` -> 1, anything else including NULL -> 0."""
    r = F.trim(col(result)) if trim else col(result)
    return F.when(r == F.lit(anomaly), F.lit(1)).otherwise(F.lit(0))


def is_known_verdict(result: str | Column) -> Column:
    """TRUE for exactly 'W' or 'G'; NULL, padded or lower-case text is unknown."""
    r = col(result)
    return F.coalesce(r.isin(K.ANOMALY_VERDICT, K.GOOD_VERDICT), F.lit(False))


def epoch_seconds(c: str | Column, dtype=None) -> Column:
    """Floored epoch seconds of a timestamp.

    For ``TIMESTAMP`` this is ``cast(long)`` (the reference's form). A
    ``TIMESTAMP_NTZ`` cannot be cast to long; its seconds since
    1970-01-01 00:00:00 are taken with ``timestamp_diff`` on the wall clock,
    which does not depend on the session time zone (floor = truncation for
    times after 1970).
    """
    x = col(c)
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), x)
    return x.cast("long")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den in double, 0 when den is 0 (the reference's rule)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def f1_from(precision: Column, recall: Column) -> Column:
    return safe_ratio(F.lit(2.0) * precision * recall, precision + recall)


def apply_threshold(score: str | Column, threshold: float | Column) -> Column:
    """Inclusive: ``score >= threshold`` -> 1 else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col(score) >= t).cast("int")


def outcome_label(label: str | Column, prediction: str | Column) -> Column:
    y, p = col(label), col(prediction)
    return (F.when((y == 1) & (p == 1), F.lit(K.OUTCOME_TP))
            .when((y == 0) & (p == 1), F.lit(K.OUTCOME_FP))
            .when((y == 1) & (p == 0), F.lit(K.OUTCOME_FN))
            .otherwise(F.lit(K.OUTCOME_TN)))


def place_among(value: Column, cuts: Column, size: int) -> Column:
    """How many of the ascending ``cuts`` (an array of ``size``, a power of two
    less one) lie below ``value``: a binary search of log2(size) steps."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(size.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at))


def split_hash(key: str | Column, seed: int = K.SPLIT_SEED) -> Column:
    """First 8 hex digits of md5(key || ':' || seed) as a non-negative bigint."""
    h = F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def split_bucket(key: str | Column, seed: int = K.SPLIT_SEED, buckets: int = 1000) -> Column:
    """Deterministic bucket in [0, buckets) from md5(key || ':' || seed).

    Row-local (no shuffle), stable under any re-partitioning and expressible
    in other SQL engines: first 8 hex digits of the md5 as an unsigned int.
    """
    return split_hash(key, seed) % F.lit(buckets)


def round_ieee(c: Column, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` (see ``round_doubles``)."""
    return F.round(c.cast("double") * F.lit(10.0 ** digits), 0) / F.lit(10.0 ** digits)


def round_doubles(df, digits: int = 6, cols: Sequence[str] | None = None):
    """Round double/float columns for comparisons with other engines.

    ``round(x * 10^d) / 10^d``: the product and quotient are plain IEEE
    operations and ``round(., 0)`` is half-away-from-zero on the exact double,
    so any engine that rounds this way returns the bit-identical value (a
    decimal ``round(x, d)`` splits ties differently across engines).
    ``+ 0.0`` folds -0.0 into 0.0."""
    from pyspark.sql.types import DoubleType, FloatType
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select([
        (F.round(F.col(f"`{f.name}`").cast("double") * F.lit(10.0 ** digits), 0)
         / F.lit(10.0 ** digits) + F.lit(0.0)).alias(f.name)
        if f.name in targets else F.col(f"`{f.name}`")
        for f in df.schema.fields])
