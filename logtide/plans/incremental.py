"""Incremental builds of the facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions.hexnum import bytes_to_hex
from logtide.operators.joins import fits_broadcast, lookup_keys
from logtide.plans.marts import FACT_KEY, FACTS
from logtide.session import new_run_dir
from logtide.sources import storage
from logtide.sources.storage import layer_path
from logtide.sources.tables import KeyedTable, block_buckets

BLOCKS_PER_BUCKET = 100_000


def fact_table(
    spark: SparkSession, root: str, name: str, blocks_per_bucket: int = BLOCKS_PER_BUCKET
) -> KeyedTable:
    """The stored fact ``name`` below ``root``, bucketed and sorted by block."""
    schema = FACTS[name][1]
    bucket = block_buckets(blocks_per_bucket)
    return KeyedTable(spark, layer_path(root, name, "mart"), schema, FACT_KEY, bucket, ["block_number"])


def start_after(table: KeyedTable, lookback_blocks: int = 0) -> int | None:
    """The block to go on from, or None before the first build.

    ``lookback_blocks`` reads that many blocks again, for late rows.
    """
    if not table.exists():
        return None
    return table.high_water("block_number") - lookback_blocks


def newer_than(df: DataFrame, block: int | None) -> DataFrame:
    """Rows after ``block``. A literal, so that the filter reaches the scan."""
    return df if block is None else df.where(F.col("block_number") > F.lit(block))


def refresh_fact(
    table: KeyedTable,
    name: str,
    transfers: DataFrame,
    run_ts: datetime | str | None = None,
    lookback_blocks: int = 0,
) -> int:
    """Upsert the transfers newer than the fact into it; the rows inserted.

    A log that stood under another block before loses that row, however far away.
    """
    start = start_after(table, lookback_blocks)
    return table.upsert(FACTS[name][0](newer_than(transfers, start), run_ts))


def replace_blocks(
    table: KeyedTable,
    name: str,
    transfers: DataFrame,
    logs: DataFrame,
    run_ts: datetime | str | None,
) -> int:
    """Make the fact hold ``transfers`` for the keys of ``logs``; the rows inserted.

    Rows that are there already, but for their run, stay as they are. Keys that
    have no transfer of this fact any more, such as logs that a reorganisation
    removed, lose their rows. Rows are looked for wherever the keys stand.
    """
    built = FACTS[name][0](transfers, run_ts)
    keys = logs.select(bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash"), "log_index")
    buckets = table.holding(keys)
    if not buckets:
        # None of the keys is stored, so no row stays and none goes.
        return table.append(built)
    content = [c for c in built.columns if c not in ("date_key", "dbt_loaded_at")]
    stored = table.within(buckets).dropna(subset=FACT_KEY)
    # Rows meet by 128 bits of hashes; what differs is written, so it is found out once.
    path = new_run_dir(table.spark, f"changed-{name}")
    try:
        told = _hashed(built, content).select(*_HASHES)
        told.join(_hashed(stored, content).select(*_HASHES), _HASHES, "left_anti").write.parquet(f"{path}/fresh")
        fresh = table.spark.read.parquet(f"{path}/fresh")
        changed = _hashed(built, content).join(lookup_keys(fresh), _HASHES, "left_semi").select(*built.columns)
        gone = _gone(stored.select(*FACT_KEY), built.select(*FACT_KEY), keys, path)
        return table.upsert(changed, also_delete=gone)
    finally:
        storage.delete(table.spark, path)


_HASHES = ["first_hash", "second_hash"]


def _hashed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with 128 bits of hashes of some columns; a NULL is a value of its own."""
    values = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return rows.withColumns(
        {"first_hash": F.xxhash64(*values), "second_hash": F.xxhash64(F.lit(1), *values)}
    )


def _gone(stored: DataFrame, built: DataFrame, keys: DataFrame, path: str) -> DataFrame:
    """Stored keys that are not built, though they are among the keys of the logs."""
    spark = stored.sparkSession
    missing = _hashed(stored, FACT_KEY).join(_hashed(built, FACT_KEY).select(*_HASHES), _HASHES, "left_anti")
    missing.write.parquet(f"{path}/missing")
    missing = spark.read.parquet(f"{path}/missing")
    asked, few = _hashed(keys, FACT_KEY).select(*_HASHES), missing.select(*_HASHES)
    if fits_broadcast(few):
        asked = asked.join(F.broadcast(few), _HASHES, "left_semi")
    missing.join(asked, _HASHES, "left_semi").select(*FACT_KEY).write.parquet(f"{path}/gone")
    return spark.read.parquet(f"{path}/gone")
