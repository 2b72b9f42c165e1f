"""Data-quality checks.

Row-level checks are predicates that hold for a *failing* row; any number of
them is counted in one pass over the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.constants import ADDRESS_LENGTH, MAX_PLAUSIBLE_BLOCK

# Table, name, and a predicate that holds for failing rows.
Check = tuple[str, str, Column]

# --- predicates ------------------------------------------------------------


def not_null_checks(columns: list[str]) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in columns}


def not_accepted(column: str, values: list[str]) -> Column:
    """Holds for values outside the list; NULL passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def invalid_address(column: str) -> Column:
    c = F.col(column)
    return c.isNull() | (F.length(c) != ADDRESS_LENGTH) | (F.substring(c, 1, 2) != "0x")


def implausible_block(column: str) -> Column:
    return (F.col(column) < 0) | (F.col(column) > MAX_PLAUSIBLE_BLOCK)


# --- failing rows ----------------------------------------------------------


def failing_rows(df: DataFrame, failing: Column) -> DataFrame:
    return df.where(failing)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Rows with a NULL in the key are not counted, as in a unique constraint.
    Counting starts in the map tasks, so a hot key costs one row per task.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unexpected_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    bad = df.where(not_accepted(column, values))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_records"))


def invalid_addresses(df: DataFrame, column: str = "contract_address") -> DataFrame:
    bad = df.where(invalid_address(column))
    return bad.groupBy(column).agg(F.count("*").alias("invalid_count"))


# --- reports ---------------------------------------------------------------


def checks_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check with its failing rows, from one scan of ``df``.

    A check is (table, name, predicate); one pass may serve several tables.
    """
    counted = df.agg(*[F.count_if(failing).alias(f"c{i}") for i, (*_, failing) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.col(f"c{i}").alias("failed_rows"),
        )
        for i, (table, name, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def row_check_report(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    return checks_report(df, [(table, name, failing) for name, failing in checks.items()])


def unique_report(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of keys that are not unique.

    Keys are counted by 128 bits of hashes: sixteen bytes a row go through the shuffle,
    however long the keys are.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    halves = [F.xxhash64(*keys).alias("key_hash"), F.xxhash64(F.lit(1), *keys).alias("second_hash")]
    hashed = df.where(present).select(*halves)
    return duplicate_keys(hashed, ["key_hash", "second_hash"]).agg(F.count("*").alias("failed_rows")).select(
        F.lit("unique:" + ",".join(keys)).alias("check_name"),
        F.lit(table).alias("table_name"),
        "failed_rows",
    )


def combine_reports(reports: list[DataFrame]) -> DataFrame:
    merged = reduce(DataFrame.unionByName, reports)
    status = F.when(F.col("failed_rows") > 0, "fail").otherwise("pass")
    return merged.withColumn("status", status)
