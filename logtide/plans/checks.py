"""The checks that every model declares, run together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.constants import EVENT_CATEGORIES
from logtide.operators import quality
from logtide.plans.marts import FACT_KEY, dim_event
from logtide.plans.staging import (
    int_event,
    log_columns,
    stg_event_signature,
    stg_open_logs,
)
from logtide.plans.transfers import int_all_transfer

# The columns that must not be NULL, by model.
NOT_NULL = {
    "open_logs": ["log_index", "transaction_hash", "block_number", "address"],
    "event_signature": ["topic0"],
    "stg_open_logs": ["log_index", "block_number", "transaction_hash", "contract_address"],
    "stg_event_signature": ["topic0_hash"],
    "int_event": ["topic0_hash"],
    "int_all_transfer": [
        "transaction_hash", "log_index", "block_number", "contract_address", "from_address",
        "to_address",
    ],
    "dim_event": ["topic0_hash"],
    "fct_mint": [
        "transaction_hash", "log_index", "date_key", "contract_address", "minting_address",
        "dbt_loaded_at",
    ],
    "fct_burn": [
        "transaction_hash", "log_index", "date_key", "block_number", "contract_address",
        "burned_from_address", "dbt_loaded_at",
    ],
}


def _not_null(model: str) -> list[quality.Check]:
    checks = quality.not_null_checks(NOT_NULL.get(model, []))
    return [(model, name, failing) for name, failing in checks.items()]


def source_report(logs: DataFrame, signatures: DataFrame) -> list[DataFrame]:
    """Raw and staged logs in one pass, and the signatures."""
    names = stg_open_logs(logs).columns
    staged = [c.alias(f"staged_{n}") for n, c in zip(names, log_columns(logs))]
    both = logs.select(*logs.columns, *staged)
    checks = _not_null("open_logs")
    for column in NOT_NULL["stg_open_logs"]:
        checks.append(("stg_open_logs", f"not_null:{column}", F.col(f"staged_{column}").isNull()))
    reports = []
    if "_dlt_id" in logs.columns:
        checks.append(("open_logs", "not_null:_dlt_id", F.col("_dlt_id").isNull()))
        reports.append(quality.unique_report(logs, "open_logs", ["_dlt_id"]))
    reports += [
        quality.checks_report(both, checks),
        quality.checks_report(signatures, _not_null("event_signature")),
        quality.checks_report(stg_event_signature(signatures), _not_null("stg_event_signature")),
        quality.checks_report(int_event(signatures), _not_null("int_event")),
        quality.unique_report(
            stg_event_signature(signatures), "stg_event_signature", ["topic0_hash"]
        ),
    ]
    return reports


def transfer_report(transfers: DataFrame) -> list[DataFrame]:
    """Decoded transfers: required columns and plausible blocks in one pass, and keys."""
    block = ("int_all_transfer", "block_range:block_number", quality.implausible_block("block_number"))
    return [
        quality.checks_report(transfers, [*_not_null("int_all_transfer"), block]),
        quality.unique_report(transfers, "int_all_transfer", FACT_KEY),
    ]


def mart_report(facts: dict[str, DataFrame], signatures: DataFrame) -> list[DataFrame]:
    """Stored facts (required columns, addresses, keys) and the dimension."""
    reports = []
    for name, fact in facts.items():
        address = (name, "valid_address:contract_address", quality.invalid_address("contract_address"))
        reports.append(quality.checks_report(fact, [*_not_null(name), address]))
        reports.append(quality.unique_report(fact, name, FACT_KEY))
    dimension = dim_event(signatures)
    category = quality.not_accepted("event_category", EVENT_CATEGORIES)
    accepted = ("dim_event", "accepted_values:event_category", category)
    reports.append(quality.checks_report(dimension, [*_not_null("dim_event"), accepted]))
    reports.append(quality.unique_report(dimension, "dim_event", ["topic0_hash"]))
    return reports


def quality_suite(
    logs: DataFrame, signatures: DataFrame, facts: dict[str, DataFrame],
    transfers: DataFrame | None = None,
) -> DataFrame:
    """Failed rows and status of every declared check.

    ``transfers`` are the decoded logs, where they are at hand.
    """
    if transfers is None:
        transfers = int_all_transfer(logs, signatures)
    return quality.combine_reports(
        [
            *source_report(logs, signatures),
            *transfer_report(transfers),
            *mart_report(facts, signatures),
        ]
    )
