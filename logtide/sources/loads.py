"""Load a frame into a table with append, replace or merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.sources.tables import KeyedTable, hash_buckets

DISPOSITIONS = ("append", "replace", "merge")


def with_load_lineage(df: DataFrame, load_id: str | Column, key: list[str]) -> DataFrame:
    """``_dlt_load_id`` of the load and a ``_dlt_id`` per row, from its key.

    Parts are joined with their lengths, so that different keys never run
    together into the same text.
    """
    parts = []
    for name in key:
        text = F.coalesce(_as_text(df, name), F.lit(""))
        parts += [F.length(text).cast("string"), text]
    load_id = load_id if isinstance(load_id, Column) else F.lit(load_id)
    return df.withColumn("_dlt_load_id", load_id).withColumn(
        "_dlt_id", F.sha2(F.concat_ws(":", F.col("_dlt_load_id"), *parts), 256)
    )


def _as_text(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    return F.hex(column) if dict(df.dtypes)[name] == "binary" else column.cast("string")


def load(
    df: DataFrame,
    root: str,
    disposition: str = "append",
    key: list[str] | None = None,
    bucket: Column | None = None,
    buckets: int = 64,
) -> KeyedTable:
    """Load ``df`` into the table at ``root`` and return the table.

    ``bucket`` places the rows; by default the hash of the key, or of the whole
    row where there is none.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown disposition {disposition!r}, use one of {DISPOSITIONS}")
    if disposition == "merge" and not key:
        raise ValueError("merge needs a key, for example key=['contract_address', 'chain']")
    place = hash_buckets(key or df.columns, buckets) if bucket is None else bucket
    table = KeyedTable(df.sparkSession, root, df.schema, key or [], place)
    write = {"append": table.append, "replace": table.replace, "merge": table.upsert}
    write[disposition](df)
    return table
