"""Joins against a lookup side whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Upper bound of a row's payload: text and binary by length, others flat."""
    sizes = []
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16)
        elif field.dataType.typeName() in ("array", "map", "struct"):
            sizes.append(F.octet_length(F.to_json(F.struct(field.name))) + 16)
        else:
            sizes.append(F.lit(16))
    return sum(sizes[1:], sizes[0])


def fits_broadcast(
    df: DataFrame,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> bool:
    """Measure ``df``: its rows and bytes are summed in the tasks that read it."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    rows, size = df.agg(F.count("*"), F.sum(_row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, **limits: int) -> DataFrame:
    """``df`` with a broadcast hint when it was measured small, else as it is.

    Without the hint the join shuffles, and adaptive execution splits skewed
    keys of the large side.
    """
    return F.broadcast(df) if fits_broadcast(df, **limits) else df


def lookup_keys(keys: DataFrame) -> DataFrame:
    """Keys for a semi or anti join, where copies do not matter: broadcast with their
    copies when these were measured small, which shuffles nothing, else reduced."""
    return F.broadcast(keys) if fits_broadcast(keys) else keys.distinct()


def lookup_join(
    df: DataFrame, lookup: DataFrame, on, how: str = "inner", **limits: int
) -> DataFrame:
    return df.join(broadcast_if_small(lookup, **limits), on, how)
