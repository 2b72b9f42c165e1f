"""Type-2 history by comparing columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.functions.columns import run_timestamp

VALIDITY = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _version_id(keys: list[str], stamp):
    parts = []
    for key in keys:
        text = F.coalesce(F.col(key).cast("string"), F.lit(""))
        parts += [F.length(text).cast("string"), text]
    return F.md5(F.concat_ws("|", *parts, stamp.cast("string")))


def start_history(rows: DataFrame, keys: list[str], run_ts: datetime | str | None) -> DataFrame:
    """Open one version per row, as of the run."""
    stamp = run_timestamp(run_ts)
    return rows.select(
        *rows.columns,
        _version_id(keys, stamp).alias("dbt_scd_id"),
        stamp.alias("dbt_updated_at"),
        stamp.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )


def scd2_snapshot(
    history: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    check_columns: list[str],
    run_ts: datetime | str | None = None,
    close_deleted: bool = True,
) -> DataFrame:
    """The next history: changed and (optionally) vanished keys are closed, new
    and changed rows are opened.

    Only open versions are compared; closed ones pass through without a shuffle.
    One full outer join decides every case, and a changed key gives its two rows
    from the same join row.
    """
    stamp = run_timestamp(run_ts)
    columns = incoming.columns
    current = history.where(F.col("dbt_valid_to").isNull())
    closed = history.where(F.col("dbt_valid_to").isNotNull())

    old = current.select(F.struct(*[F.col(k) for k in keys]).alias("key"), F.struct("*").alias("old"))
    new = start_history(incoming, keys, run_ts).select(
        F.struct(*[F.col(k) for k in keys]).alias("key"), F.struct("*").alias("new")
    )
    paired = old.join(new, "key", "full_outer").select("old", "new")

    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns],
    )
    missing_old, missing_new = F.col("old").isNull(), F.col("new").isNull()
    ended = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col("old.dbt_scd_id").alias("dbt_scd_id"),
        F.col("old.dbt_updated_at").alias("dbt_updated_at"),
        F.col("old.dbt_valid_from").alias("dbt_valid_from"),
        stamp.alias("dbt_valid_to"),
    )
    kept = F.struct(*[F.col(f"old.{c}").alias(c) for c in [*columns, *VALIDITY]])
    opened = F.struct(*[F.col(f"new.{c}").alias(c) for c in [*columns, *VALIDITY]])
    versions = (
        F.when(missing_old, F.array(opened))
        .when(missing_new, F.array(ended if close_deleted else kept))
        .when(differs, F.array(ended, opened))
        .otherwise(F.array(kept))
    )
    decided = paired.select(F.inline(versions))
    return closed.select(*columns, *VALIDITY).unionByName(decided)


def scd2_replay(
    snapshots: DataFrame,
    keys: list[str],
    check_columns: list[str],
    taken_at: str = "taken_at",
    times: DataFrame | None = None,
    close_deleted: bool = True,
) -> DataFrame:
    """The history that ``scd2_snapshot`` gives when it takes in all snapshots in turn.

    ``snapshots`` holds the rows of every snapshot with the time it was taken, each key
    once a snapshot; ``times`` names the times where a snapshot may have had no row. One
    sort per key decides all versions, instead of a join of the whole table per
    snapshot: a version begins where a key is new, comes back, or differs from the
    snapshot before, and ends at the snapshot after its last one. Only the times, one
    row per snapshot, are broadcast.
    """
    columns = [c for c in snapshots.columns if c != taken_at]
    in_turn = Window.orderBy("_at")
    known = snapshots.select(F.col(taken_at).alias("_at")) if times is None else times.toDF("_at")
    turns = known.distinct().select(
        "_at", F.row_number().over(in_turn).alias("_turn"), F.lead("_at").over(in_turn).alias("_next")
    )
    rows = snapshots.withColumnRenamed(taken_at, "_at").join(F.broadcast(turns), "_at")
    by_key = Window.partitionBy(*keys).orderBy("_turn")
    before = F.lag(F.struct("_turn", *check_columns)).over(by_key)
    changed = reduce(
        lambda a, b: a | b, [~F.col(f"_before.{c}").eqNullSafe(F.col(c)) for c in check_columns]
    )
    new = F.col("_before").isNull() | changed
    if close_deleted:
        new = new | (F.col("_before._turn") < F.col("_turn") - 1)
    marked = rows.withColumn("_before", before).withColumn("_begins", new)
    numbered = marked.withColumn("_version", F.sum(F.col("_begins").cast("int")).over(by_key))
    # What a version says is what its first row said; the rows after it only prolong it.
    if close_deleted:
        ends = F.last("_next").over(
            Window.partitionBy(*keys, "_version").orderBy("_turn").rowsBetween(0, Window.unboundedFollowing)
        )
        versions = numbered.withColumn("_ends", ends).where("_begins")
    else:
        versions = numbered.where("_begins").withColumn("_ends", F.lead("_at").over(by_key))
    return versions.select(
        *columns,
        _version_id(keys, F.col("_at")).alias("dbt_scd_id"),
        F.col("_at").alias("dbt_updated_at"),
        F.col("_at").alias("dbt_valid_from"),
        F.col("_ends").alias("dbt_valid_to"),
    )
