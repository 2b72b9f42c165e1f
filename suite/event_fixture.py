"""Log, signature, ABI and message rows derived from the given tables.

Every row is a projection of a row of ``events`` or ``part``, so the data grows
with those tables and expected answers can be stated without decoding anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.constants import (
    APPROVAL_SIGNATURE,
    APPROVAL_TOPIC,
    TRANSFER_SIGNATURE,
    TRANSFER_TOPIC,
)
from logtide.functions.hexnum import bytes_to_hex, decode_amount, topic_to_address

UNKNOWN_TOPIC = "0x" + "9" * 64
ZERO_WORD = "0" * 64
# Event names of the derived catalog rows; a part takes one by its key.
CATALOG_EVENTS = [
    "RoleGranted",
    "RoleRevoked",
    "Upgraded",
    "Initialized",
    "AuctionStarted",
    "RebalanceStarted",
    "Paused",
]


def _word(number: Column, digits: int = 64) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _bytes(hex_text: Column) -> Column:
    return F.unhex(hex_text)


def _div(column: str, by: int) -> Column:
    return F.expr(f"{column} div {by}")


def log_rows(events: DataFrame) -> DataFrame:
    """One raw log per event: click mints, purchase burns, view transfers."""
    kind, event, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    topic0 = (
        F.when(kind == "signup", APPROVAL_TOPIC[2:])
        .when(kind == "error", UNKNOWN_TOPIC[2:])
        .otherwise(TRANSFER_TOPIC[2:])
    )
    cents = F.round(F.col("value") * 100).cast("long")
    data = F.when(event % 97 == 0, F.lit("")).otherwise(
        F.lpad(F.concat(F.lower(F.hex(cents)), F.lit("0" * 14)), 64, "0")
    )
    return events.select(
        (event % 50 == 7).alias("removed"),
        (event % 10).alias("log_index"),
        (event % 4).alias("transaction_index"),
        _bytes(F.sha2(_div("event_id", 2).cast("string"), 256)).alias("transaction_hash"),
        _bytes(F.sha2(_div("event_id", 10).cast("string"), 256)).alias("block_hash"),
        _div("event_id", 10).alias("block_number"),
        _bytes(_word(user % 3 + 1, 40)).alias("address"),
        _bytes(data).alias("data"),
        _bytes(topic0).alias("topic0"),
        _bytes(F.when(kind == "click", ZERO_WORD).otherwise(_word(user + 1))).alias("topic1"),
        _bytes(F.when(kind == "purchase", ZERO_WORD).otherwise(_word(user + 1000))).alias("topic2"),
    )


def signature_rows(part: DataFrame) -> DataFrame:
    """The two real token events, and one made-up event per part.

    A part's event has as many parameters as its size, which takes some
    signatures past the stored length.
    """
    spark = part.sparkSession
    real = spark.createDataFrame(
        [
            (TRANSFER_TOPIC, "Transfer", TRANSFER_SIGNATURE),
            (APPROVAL_TOPIC, "Approval", APPROVAL_SIGNATURE),
        ],
        "topic0 string, event_name string, signature string",
    )
    names = F.array(*[F.lit(n) for n in CATALOG_EVENTS])
    key = F.col("p_partkey")
    name = F.concat(
        F.element_at(names, (key % len(CATALOG_EVENTS) + 1).cast("int")),
        F.when(key >= len(CATALOG_EVENTS), _div("p_partkey", len(CATALOG_EVENTS)).cast("string"))
        .otherwise(""),
    )
    types = F.array_join(F.array_repeat(F.lit("uint256"), F.col("p_size")), ",")
    made_up = part.select(
        F.concat(F.lit("0x"), F.sha2(key.cast("string"), 256)).alias("topic0"),
        name.alias("event_name"),
        F.concat(name, F.lit("("), types, F.lit(")")).alias("signature"),
    )
    return real.unionByName(made_up)


def nested_abi_rows(part: DataFrame) -> DataFrame:
    """One contract per part with an event of one parameter: a tuple as deep as the
    part's size, at most 30, of arrays as long, with an address beside each level."""
    depth = F.least(F.greatest(F.col("p_size"), F.lit(1)), F.lit(30))
    head = F.concat(
        F.lit('{"name":"t","type":"tuple['), depth, F.lit(']","components":[{"name":"a","type":"address"},')
    )
    inputs = F.concat(
        F.repeat(head, depth), F.lit('{"name":"v","type":"uint256"}'), F.repeat(F.lit("]}"), depth)
    )
    name = F.concat(F.lit("Nested"), F.col("p_partkey"))
    return part.select(
        F.concat(F.lit('[{"type":"event","name":"'), name, F.lit('","inputs":['), inputs, F.lit("]}]")).alias("abi"),
        F.lit(None).cast("string").alias("implementation_abi"),
    )


def abi_rows(part: DataFrame) -> DataFrame:
    """One contract per part: its event, a function, and the Transfer event that
    every implementation shares; the event comes again in the implementation."""
    signature = signature_rows(part)
    own = signature.where(~F.col("topic0").isin(TRANSFER_TOPIC, APPROVAL_TOPIC))
    count = F.size(F.split("signature", ","))
    inputs = F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.struct(F.concat(F.lit("p"), i).alias("name"), F.lit("uint256").alias("type")),
    )
    event = F.struct(F.lit("event").alias("type"), F.col("event_name").alias("name"), inputs.alias("inputs"))
    function = F.struct(F.lit("function").alias("type"), F.lit("pause").alias("name"), inputs.alias("inputs"))
    transfer_inputs = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"))
            for n, t in (("from", "address"), ("to", "address"), ("value", "uint256"))
        ]
    )
    transfer = F.struct(
        F.lit("event").alias("type"), F.lit("Transfer").alias("name"), transfer_inputs.alias("inputs")
    )
    return own.select(
        F.to_json(F.array(event, function)).alias("abi"),
        F.to_json(F.array(event, transfer)).alias("implementation_abi"),
    )


def token_rows(logs: DataFrame) -> DataFrame:
    """Decimals of every contract that occurs in the logs."""
    last = F.substring("contract_address", 42, 1)
    return (
        logs.select(bytes_to_hex(F.col("address")).alias("contract_address"))
        .distinct()
        .withColumn("decimals", F.when(last == "1", 6).when(last == "2", 8).otherwise(18))
    )


def transfer_events(logs: DataFrame, *extra: Column, events_per_block: int = 10) -> DataFrame:
    """The speed layer's record of every log, with extra columns of it."""
    topic1, topic2 = bytes_to_hex(F.col("topic1")), bytes_to_hex(F.col("topic2"))
    number = F.col("block_number") * events_per_block + F.col("log_index")
    return logs.select(
        number.cast("string").alias("id"),
        "block_number",
        F.concat(F.lit("t"), number.cast("string")).alias("timestamp"),
        bytes_to_hex(F.col("address")).alias("contract_address"),
        topic_to_address(topic1).alias("from_address"),
        topic_to_address(topic2).alias("to_address"),
        decode_amount(bytes_to_hex(F.col("data")), trusted=True).cast("string").alias("value"),
        *extra,
    )
