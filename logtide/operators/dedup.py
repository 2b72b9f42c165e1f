"""Keep one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

APART = "row_without_key"
LOG_KEY = ["transaction_hash", "log_index"]


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; ties go to the smallest row.

    An aggregate rather than a window: every task reduces its own copies first,
    so a key that holds a third of the rows is never gathered in one task. Rows
    with a NULL in the key are no copies of each other; all of them stay.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    candidate = F.struct(*[c for c in order if c not in keys], *rest)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = F.when(no_key, F.monotonically_increasing_id())
    return (
        df.withColumn(APART, apart)
        .groupBy(*keys, APART)
        .agg(F.min(candidate).alias("first"))
        .select(*keys, "first.*")
        .select(*df.columns)
    )


def newest_first(load_id: str = "_dlt_load_id") -> list[Column]:
    """Sort keys that put logs of the newest stamped file first: by its date, its
    last block, then its name. Names without a stamp come last."""
    stamp = r"(?:_(\d{6}))?_(\d+)_(\d+)\.parquet$"
    name = F.coalesce(F.col(load_id), F.lit(""))
    day, last = F.regexp_extract(name, stamp, 1), F.regexp_extract(name, stamp, 3)
    return [
        -F.coalesce(F.nullif(day, F.lit("")).cast("long"), F.lit(0)),
        -F.coalesce(F.nullif(last, F.lit("")).cast("long"), F.lit(-1)),
        F.xxhash64(name),
    ]


def dedup_logs(logs: DataFrame, newest: list[Column] | None = None) -> DataFrame:
    """One row per (transaction_hash, log_index), for overlapping block ranges.

    Copies go by the sort keys ``newest`` first. Among equal ones, copies that were
    not removed by a chain reorganisation come first, then the lowest block.
    """
    ranks = {f"rank_{n}": key for n, key in enumerate(newest or [])}
    ranked = first_by_key(logs.withColumns(ranks) if ranks else logs, LOG_KEY, [*ranks, "removed", "block_number"])
    return ranked.drop(*ranks)
