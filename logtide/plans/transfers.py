"""Decode token transfers from raw logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.constants import DEFAULT_TOKEN_DECIMALS, TOPIC_LENGTH, TRANSFER_EVENT
from logtide.functions.hexnum import (
    amount_digits,
    amount_value,
    convert_token_amount,
    token_amount,
    topic_to_address,
)
from logtide.operators.joins import lookup_join
from logtide.operators.quality import duplicate_keys
from logtide.plans.staging import LINEAGE, int_event, log_columns

MAX_LITERAL_TOPICS = 1000


def event_logs(
    logs: DataFrame, signatures: DataFrame, event_name: str, data_encoding: str = "binary"
) -> DataFrame:
    """Staged logs of one event that no reorganisation removed, with its name.

    Signatures and logs meet on the raw topic bytes: one event has few topics, so
    they also become literals, and the scan skips row groups without them. Hex
    text could not be pushed down. Staged topics are whole bytes in lower-case
    hex, so no other signature text could match.
    """
    topic = F.col("topic0_hash")
    topics = (
        int_event(signatures)
        .where((F.col("event_name") == event_name) & topic.rlike("^0x([0-9a-f]{2})*$"))
        .select(F.unhex(F.substring(topic, 3, TOPIC_LENGTH)).alias("topic0"), "event_name")
    )
    live = logs.where(F.col("removed") == F.lit(False))
    found = topics.select("topic0").distinct().limit(MAX_LITERAL_TOPICS + 1).collect()
    if len(found) <= MAX_LITERAL_TOPICS:
        live = live.where(F.col("topic0").isin([row.topic0 for row in found]))
    named = lookup_join(live, topics, "topic0")
    return named.select(*log_columns(logs, data_encoding), "event_name")


def int_all_transfer(
    logs: DataFrame,
    signatures: DataFrame,
    mode: str = "exact",
    data_encoding: str = "binary",
    decimals: int = DEFAULT_TOKEN_DECIMALS,
) -> DataFrame:
    """Decoded transfers.

    ``amount_raw`` is NULL for values of 10^38 and more in exact mode, and
    ``amount`` also where fewer decimals take it out of range; such rows have
    ``amount_overflow`` set and keep all digits in ``amount_hex``.
    """
    transfers = event_logs(logs, signatures, TRANSFER_EVENT, data_encoding)
    # Digits, value and amount one after the other: each is computed once.
    digits = transfers.select(
        "transaction_hash",
        "log_index",
        "block_number",
        "block_hash",
        "contract_address",
        topic_to_address(F.col("topic1")).alias("from_address"),
        topic_to_address(F.col("topic2")).alias("to_address"),
        amount_digits(F.col("event_data")).alias("amount_hex"),
        "event_name",
        "transaction_index",
        *[c for c in LINEAGE if c in transfers.columns],
    )
    valued = digits.withColumn("amount_raw", amount_value(F.col("amount_hex"), mode, trusted=True))
    amount = token_amount(F.col("amount_raw"), decimals)
    return valued.withColumn("amount", amount).select(
        "transaction_hash",
        "log_index",
        "block_number",
        "block_hash",
        "contract_address",
        "from_address",
        "to_address",
        "amount_raw",
        "amount",
        "event_name",
        "transaction_index",
        "amount_hex",
        F.col("amount").isNull().alias("amount_overflow"),
        *[c for c in LINEAGE if c in valued.columns],
    )


def with_token_amount(
    transfers: DataFrame, tokens: DataFrame, precision: int = 8,
    default_decimals: int = DEFAULT_TOKEN_DECIMALS, chain: str | None = None,
) -> DataFrame:
    """``token_amount`` by the decimals of each token; unknown tokens get the default.

    A token is a contract on a chain. Tokens with a ``chain`` meet the ``chain`` of
    the transfers, or that of the parameter, by which all transfers are of one
    chain. Two rows for a token are an error, so a transfer stays one row.
    ``token_amount_overflow`` marks amounts that do not fit.
    """
    keys = ["contract_address"]
    if "chain" in tokens.columns:
        if chain is not None:
            tokens = tokens.where(F.col("chain") == chain)
        elif "chain" in transfers.columns:
            keys.append("chain")
        else:
            raise ValueError("tokens are on several chains: name the chain of the transfers")
    known = tokens.select(*keys, F.col("decimals").alias("token_decimals"))
    twice = duplicate_keys(known, keys).first()
    if twice:
        raise ValueError(f"token metadata repeats {twice.asDict()}")
    joined = lookup_join(transfers, known, keys, "left")
    decimals = F.coalesce("token_decimals", F.lit(default_decimals))
    amount = convert_token_amount(F.col("amount_raw"), decimals, precision)
    return joined.withColumn("token_amount", amount).withColumn(
        "token_amount_overflow", F.col("token_amount").isNull()
    ).drop("token_decimals")
