"""Staging views: raw columns renamed, cast and turned into hex text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.constants import EVENT_NAME_LENGTH, SIGNATURE_LENGTH, TOPIC_LENGTH
from logtide.functions.hexnum import base64_to_hex, bytes_to_hex

LINEAGE = ["_dlt_load_id", "_dlt_id"]


def log_columns(logs: DataFrame, data_encoding: str = "binary") -> list[Column]:
    """Staging columns of raw logs. ``data`` is binary, or base64 text in some
    sources."""
    if data_encoding not in ("binary", "base64"):
        raise ValueError(f"unknown data encoding {data_encoding!r}")
    data = base64_to_hex(F.col("data")) if data_encoding == "base64" else bytes_to_hex(F.col("data"))
    return [
        F.col("removed").cast("boolean").alias("is_removed"),
        F.col("log_index").cast("bigint").alias("log_index"),
        F.col("transaction_index").cast("bigint").alias("transaction_index"),
        F.col("block_number").cast("bigint").alias("block_number"),
        bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash"),
        bytes_to_hex(F.col("block_hash")).alias("block_hash"),
        bytes_to_hex(F.col("address")).alias("contract_address"),
        *[bytes_to_hex(F.col(topic)).alias(topic) for topic in ("topic0", "topic1", "topic2")],
        data.alias("event_data"),
        *[F.col(c) for c in LINEAGE if c in logs.columns],
    ]


def stg_open_logs(logs: DataFrame, data_encoding: str = "binary") -> DataFrame:
    """One row per raw log."""
    return logs.select(*log_columns(logs, data_encoding))


def stg_event_signature(signatures: DataFrame) -> DataFrame:
    return signatures.select(
        F.substring("topic0", 1, TOPIC_LENGTH).alias("topic0_hash"),
        F.substring("event_name", 1, EVENT_NAME_LENGTH).alias("event_name"),
        F.substring("signature", 1, SIGNATURE_LENGTH).alias("event_signature"),
        *[c for c in LINEAGE if c in signatures.columns],
    )


def int_event(signatures: DataFrame) -> DataFrame:
    return stg_event_signature(signatures).select("topic0_hash", "event_name", "event_signature")
