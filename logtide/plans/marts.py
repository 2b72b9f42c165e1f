"""Event dimension and the mint, burn and transfer facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import (
    ACCESS_CONTROL_EVENTS,
    AUCTION_PREFIX,
    CONTRACT_UPGRADE_EVENTS,
    REBALANCE_PREFIX,
    ZERO_ADDRESS,
)
from logtide.functions.columns import date_key, run_timestamp
from logtide.plans.staging import int_event
from logtide.schemas import AMOUNT, AMOUNT_RAW

FACT_KEY = ["transaction_hash", "log_index"]

_TYPES = {
    "transaction_hash": T.StringType(),
    "log_index": T.LongType(),
    "date_key": T.IntegerType(),
    "block_number": T.LongType(),
    "block_hash": T.StringType(),
    "contract_address": T.StringType(),
    "from_address": T.StringType(),
    "to_address": T.StringType(),
    "minting_address": T.StringType(),
    "burned_from_address": T.StringType(),
    "amount_raw": AMOUNT_RAW,
    "amount": AMOUNT,
    "minted_amount": AMOUNT,
    "burned_amount": AMOUNT,
    "amount_hex": T.StringType(),
    "amount_overflow": T.BooleanType(),
    "event_name": T.StringType(),
    "transaction_index": T.LongType(),
    "dbt_loaded_at": T.TimestampType(),
}


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[name]) for name in names])


FCT_MINT_SCHEMA = _schema(
    "transaction_hash", "log_index", "date_key", "block_number", "contract_address",
    "minting_address", "minted_amount", "amount_hex", "amount_overflow", "dbt_loaded_at",
)
FCT_BURN_SCHEMA = _schema(
    "transaction_hash", "log_index", "date_key", "block_number", "block_hash",
    "contract_address", "burned_from_address", "amount_raw", "burned_amount", "event_name",
    "transaction_index", "amount_hex", "amount_overflow", "dbt_loaded_at",
)
FCT_TRANSFER_SCHEMA = _schema(
    "transaction_hash", "log_index", "date_key", "block_number", "block_hash",
    "contract_address", "from_address", "to_address", "amount_raw", "amount", "event_name",
    "transaction_index", "amount_hex", "amount_overflow", "dbt_loaded_at",
)
DIM_EVENT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "topic0_hash", "event_name", "event_signature", "event_base_name",
            "event_parameters", "event_category",
        )
    ]
)


def dim_event(signatures: DataFrame) -> DataFrame:
    name = F.col("event_name")
    signature = F.col("event_signature")
    after_bracket = F.split_part(signature, F.lit("("), F.lit(2))
    category = (
        F.when(name == "Transfer", "token_transfer")
        .when(name == "Approval", "token_approval")
        .when(name.isin(ACCESS_CONTROL_EVENTS), "access_control")
        .when(name.isin(CONTRACT_UPGRADE_EVENTS), "contract_upgrade")
        .when(name.startswith(AUCTION_PREFIX), "auction")
        .when(name.startswith(REBALANCE_PREFIX), "rebalancing")
        .otherwise("other")
    )
    return int_event(signatures).select(
        "topic0_hash",
        "event_name",
        "event_signature",
        F.split_part(signature, F.lit("("), F.lit(1)).alias("event_base_name"),
        F.split_part(after_bracket, F.lit(")"), F.lit(1)).alias("event_parameters"),
        category.alias("event_category"),
    )


def _with_run(df: DataFrame, run_ts: datetime | str | None, schema: T.StructType) -> DataFrame:
    """Date key and load time are those of the run; no block time is on record."""
    loaded = run_timestamp(run_ts)
    stamped = df.withColumn("date_key", date_key(loaded)).withColumn("dbt_loaded_at", loaded)
    return stamped.select(*schema.fieldNames())


def fct_mint(transfers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Transfers out of the zero address."""
    minted = transfers.where(F.col("from_address") == ZERO_ADDRESS)
    renamed = minted.withColumnsRenamed({"to_address": "minting_address", "amount": "minted_amount"})
    return _with_run(renamed, run_ts, FCT_MINT_SCHEMA)


def fct_burn(transfers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Transfers into the zero address."""
    burned = transfers.where(F.col("to_address") == ZERO_ADDRESS)
    renamed = burned.withColumnsRenamed(
        {"from_address": "burned_from_address", "amount": "burned_amount"}
    )
    return _with_run(renamed, run_ts, FCT_BURN_SCHEMA)


def fct_transfer(transfers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Transfers between two other addresses."""
    regular = transfers.where(
        (F.col("from_address") != ZERO_ADDRESS) & (F.col("to_address") != ZERO_ADDRESS)
    )
    return _with_run(regular, run_ts, FCT_TRANSFER_SCHEMA)


FACTS = {
    "fct_mint": (fct_mint, FCT_MINT_SCHEMA),
    "fct_burn": (fct_burn, FCT_BURN_SCHEMA),
    "fct_transfer": (fct_transfer, FCT_TRANSFER_SCHEMA),
}
