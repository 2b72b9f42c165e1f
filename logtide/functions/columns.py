"""Small column helpers shared by the models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` of a timestamp as an integer."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def run_timestamp(run_ts: datetime | str | None = None) -> Column:
    """One load time for the whole run; the current time when none is given."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(str(run_ts)).cast("timestamp")


def with_optional_column(
    df: DataFrame, name: str, default: object = None, data_type: str = "string"
) -> DataFrame:
    """``df`` with column ``name``: unchanged when it has one, else the default."""
    if name.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(default).cast(data_type))


def megabytes_text(size: Column) -> Column:
    """Bytes as ``"x.xx MB"``, ties to even, by integer arithmetic only."""
    unit = 1024 * 1024
    hundredths = size.cast("decimal(38,0)") * 100
    rest = (hundredths % unit).cast("long")
    floor = ((hundredths - rest) / unit).cast("long")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (floor % 2 == 1))
    rounded = F.when(up, floor + 1).otherwise(floor)
    cents = rounded % 100
    whole = ((rounded - cents) / 100).cast("long")
    return F.concat(
        whole.cast("string"), F.lit("."), F.lpad(cents.cast("string"), 2, "0"), F.lit(" MB")
    )
