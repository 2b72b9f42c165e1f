"""Table schemas and the drift guard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_LOGS = T.StructType(
    [
        T.StructField("removed", T.BooleanType()),
        T.StructField("log_index", T.LongType()),
        T.StructField("transaction_index", T.LongType()),
        T.StructField("transaction_hash", T.BinaryType()),
        T.StructField("block_hash", T.BinaryType()),
        T.StructField("block_number", T.LongType()),
        T.StructField("address", T.BinaryType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("topic0", T.BinaryType()),
        T.StructField("topic1", T.BinaryType()),
        T.StructField("topic2", T.BinaryType()),
    ]
)

# The stored raw table: a log, the file it came from, and an id of its load.
STORED_LOGS = T.StructType(
    RAW_LOGS.fields
    + [T.StructField("_dlt_load_id", T.StringType()), T.StructField("_dlt_id", T.StringType())]
)

EVENT_SIGNATURES = T.StructType(
    [
        T.StructField("topic0", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("signature", T.StringType()),
    ]
)

# Columns of one streamed transfer, in message order.
TRANSFER_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("block_number", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("contract_address", T.StringType()),
        T.StructField("from_address", T.StringType()),
        T.StructField("to_address", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

TRANSFER_SINK = T.StructType(
    TRANSFER_EVENT.fields + [T.StructField("created_at", T.TimestampType())]
)

# Field names of the indexer's JSON records -> our column names.
INDEXER_FIELDS = {
    "id": "id",
    "blockNumber": "block_number",
    "timestamp": "timestamp",
    "contractAddress": "contract_address",
    "from": "from_address",
    "to": "to_address",
    "value": "value",
}
INDEXER_RECORD = T.StructType(
    [
        T.StructField(name, TRANSFER_EVENT[column].dataType)
        for name, column in INDEXER_FIELDS.items()
    ]
)

AMOUNT_RAW = T.DecimalType(38, 0)
AMOUNT = T.DecimalType(38, 18)


class SchemaDrift(ValueError):
    """The columns or types of a batch differ from those of its table."""


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` in the column order of ``expected``; raise on any drift.

    Nullability is not compared: Spark derives it from the plan, not the data.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    missing = sorted(wanted.keys() - actual.keys())
    extra = sorted(actual.keys() - wanted.keys())
    changed = sorted(
        f"{name}: {actual[name].simpleString()} instead of {wanted[name].simpleString()}"
        for name in wanted.keys() & actual.keys()
        if actual[name] != wanted[name]
    )
    if missing or extra or changed:
        raise SchemaDrift(f"missing={missing} unexpected={extra} changed={changed}")
    return df.select(*[f.name for f in expected.fields])
