"""Shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id and content, whatever files they come
from. A Feistel network over two coordinates, the row number divided by a width and
the remainder, permutes slightly more numbers than there are rows; a number that
lands beyond the last row is sent through again until it does not (cycle walking).
So shard and slot of a row follow from its number, and the number from shard and
slot, without a table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.workspace import Workspace

SHARDS, SEED, ROUNDS = 40, 2_024, 8
ROW_BYTES = 16
ROWS_PER_PART = 500_000
_LOCAL_BITS = 33


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def _sides(total: int) -> tuple[int, int]:
    """Sizes of the two coordinates: their product is at least ``total``, and by less
    than its square root larger."""
    rows = max(1, math.isqrt(max(total - 1, 0)) + 1)
    return rows, max(1, -(-total // rows))


def _network(value: Column, total: int, seed: int, rounds: int, back: bool) -> Column:
    """One pass of the network, or of its inverse, over all its numbers."""
    rows, width = _sides(total)
    sizes = F.array(F.lit(rows).cast("long"), F.lit(width).cast("long"))
    keys = range(rounds - 1, -1, -1) if back else range(rounds)

    def forward(state: Column, key: Column) -> Column:
        size = sizes[key % 2]
        mixed = F.xxhash64(F.lit(seed).cast("long"), key, state["y"])
        return F.struct(
            state["y"].alias("x"), F.pmod(state["x"] + F.pmod(mixed, size), size).alias("y")
        )

    def inverse(state: Column, key: Column) -> Column:
        size = sizes[key % 2]
        mixed = F.xxhash64(F.lit(seed).cast("long"), key, state["x"])
        return F.struct(
            F.pmod(state["y"] - F.pmod(mixed, size), size).alias("x"), state["x"].alias("y")
        )

    start = F.struct(_div(value, width).alias("x"), F.pmod(value, F.lit(width).cast("long")).alias("y"))
    return F.aggregate(
        F.array(*(F.lit(k) for k in keys)), start, inverse if back else forward,
        lambda state: state["x"] * F.lit(width).cast("long") + state["y"],
    )


def _walked(number: Column, total: int, seed: int, rounds: int, back: bool) -> Column:
    if rounds % 2:
        raise ValueError("an even number of rounds")
    number = number.cast("long")
    rows, width = _sides(total)
    beyond = rows * width - total
    once = _network(number, total, seed, rounds, back)
    if not beyond:
        return once
    # A walk meets each number beyond the last row at most once.
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(beyond)), once,
        lambda at, _: F.when(at < total, at).otherwise(_network(at, total, seed, rounds, back)),
    )
    return F.when(once < total, once).otherwise(again)


def permuted(number: Column, total: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """Place of row ``number`` among ``total``; every place is taken once."""
    return _walked(number, total, seed, rounds, back=False)


def row_at(
    shard: Column, slot: Column, total: int, shards: int = SHARDS, seed: int = SEED,
    rounds: int = ROUNDS,
) -> Column:
    """Number of the row that stands at a slot of a shard."""
    place = slot.cast("long") * F.lit(shards).cast("long") + shard.cast("long")
    return _walked(place, total, seed, rounds, back=True)


def numbered(
    rows: DataFrame, order: list[str], work: Workspace, rows_per_part: int = ROWS_PER_PART
) -> tuple[DataFrame, int]:
    """All rows with ``row_no`` from 0 in the order of the columns, and their count.

    Rows equal in ``order`` are told apart by the place they were written at, so any
    number of them is split over tasks. Rows are sorted by range in one shuffle; only
    the row count of each range is gathered, one number per ``rows_per_part`` rows.
    """
    if {"row_no", "_place"} & set(rows.columns):
        raise ValueError("columns row_no and _place are made here")
    written = work.saved(rows.withColumn("_place", F.monotonically_increasing_id()), "rows")
    total = written.count()
    parts = max(1, -(-total // rows_per_part))
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order] + [F.col("_place")]
    in_order = work.saved(
        written.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "in-order",
    )
    work.drop("rows")
    part = F.shiftright("_place", _LOCAL_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        in_order.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    found = (
        in_order.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn("row_no", F.col("_offset") + local)
    )
    return found.drop("_part", "_offset", "_place"), total


def keys_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What sharding reads of a document: id, hash, size in bytes and checksum of the text."""
    text = F.col(f"`{text_col}`").cast("string")
    kept = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row_fp"),
        (F.octet_length(kept) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(kept.cast("binary")).cast("long").alias("text_crc32"),
    )


def assigned(
    rows: DataFrame, order: list[str], work: Workspace, shards: int = SHARDS, seed: int = SEED,
    rounds: int = ROUNDS,
) -> DataFrame:
    """All rows with ``row_no``, ``shard`` and ``slot``.

    Shards are as many rows as one another, but for one. Slots of a shard are gapless
    from 0. The same rows get the same places, however they are split into files and
    tasks; nulls in ``order`` come first, and rows equal in all its columns may change
    places with one another. No rows give no rows.
    """
    found, total = numbered(rows, order, work)
    place = permuted(F.col("row_no"), max(total, 1), seed, rounds)
    return (
        found.withColumn("_at", place)
        .withColumn("shard", F.pmod("_at", F.lit(shards).cast("long")).cast("int"))
        .withColumn("slot", _div(F.col("_at"), shards)).drop("_at")
    )


def shard_documents(
    docs: DataFrame, work: Workspace, shards: int = SHARDS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, hash, size, checksum, ``row_no``, ``shard``, ``slot``.

    Texts are read once and not shuffled: their order is that of id and text hash. Null
    ids come first; a null text counts as empty; repeated rows take places of their own.
    Other columns are left out, so no name clashes.
    """
    return assigned(keys_of(docs, id_col, text_col), ["doc_id", "row_fp"], work, shards, seed)


def write_shards(placed: DataFrame, path: str, parts: int) -> None:
    """Whole rows, from ``assigned``, as a folder per shard with files in slot order."""
    keys = ["shard", "slot"]
    placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.partitionBy("shard").parquet(path)
