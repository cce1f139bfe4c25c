"""Silver cleaning: stateless row transforms (SC1-SC7, PR1, SO1).

One ``select`` per table (Catalyst would collapse a ``withColumn`` chain
anyway); every parse is a ``try_*`` so dirty input becomes NULL and is
counted by ``audit.parse_failures`` instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from assay import constants as K
from assay.functions.scalar import line_label, parse_timestamp, serial_from_path, to_double
from assay.sources.delimited import ARRIVAL, SOURCE_FILE


def clean_measurements(raw: DataFrame, sensors: Sequence[str] = K.SENSORS,
                       path_col: str = SOURCE_FILE, scope: str = "name",
                       date: str = K.DATE, time: str = K.TIME, phase: str = K.PHASE,
                       fmt: str = K.SOURCE_TS_FORMAT, keep_arrival: bool = False) -> DataFrame:
    """PR1 + SC1-SC4: serial from the file path, timestamp from DATE + HEURE,
    sensors to double, constant sensors dropped (by not being listed).
    Rows whose file carries no serial keep a NULL serial: see ``quarantine``.
    ``keep_arrival`` carries the arrival-order columns (for ``time_inversions``)."""
    arrival = [c for c in ARRIVAL if keep_arrival and c in raw.columns]
    return raw.select(
        serial_from_path(path_col, scope).alias(K.SERIAL),
        parse_timestamp(date, time, fmt).alias(K.TS),
        F.col(phase).alias(K.PHASE),
        *[to_double(c).alias(c) for c in sensors],
        *arrival,
    )


def split_quarantine(clean: DataFrame, key: str = K.SERIAL) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows without a serial). Rows without a serial would
    otherwise form one bogus, possibly huge, unit."""
    return clean.where(F.col(key).isNotNull()), clean.where(F.col(key).isNull())


def sort_series(clean: DataFrame, key: str = K.SERIAL, ts: str = K.TS) -> DataFrame:
    """SO1: order by (serial, time) for the silver write. The global sort
    range-partitions on both columns, so a unit with a third of all rows is
    spread over many partitions instead of one."""
    return clean.orderBy(key, ts)


def clean_results(raw: DataFrame, ids: Sequence[str] = (K.SERIAL, K.PRODUCT),
                  result: str = K.RESULT, trim_result: bool = False,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """SC5 + SC7: trim the ids (spaces only) and add the 0/1 line label.
    ``RESULT`` itself is not trimmed unless asked (reference behaviour)."""
    present = [c for c in ids if c in raw.columns]
    rest = [c for c in (keep if keep is not None else raw.columns) if c not in present]
    return raw.select(*[F.trim(F.col(c)).alias(c) for c in present],
                      *[F.col(c) for c in rest],
                      line_label(result, trim=trim_result).alias("LAB"))


def trim_all(df: DataFrame, skip_prefix: str = "_") -> DataFrame:
    """SC6: trim every string column whose name does not start with '_'."""
    return df.select(*[
        F.trim(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, StringType) and not f.name.startswith(skip_prefix)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def clean_warranty(raw: DataFrame, key: str = K.SERIAL) -> DataFrame:
    return raw.withColumn(key, F.trim(F.col(key)))
