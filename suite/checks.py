"""Data-quality checks, on good data and on data that must fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from logtide.constants import EVENT_CATEGORIES
from logtide.operators import quality
from logtide.plans.checks import quality_suite
from logtide.plans.incremental import fact_table, refresh_fact
from logtide.plans.marts import FACTS, dim_event, fct_transfer
from logtide.session import new_run_dir
from suite.common import EV, RUN_TS, logs, signatures, table, transfers

BLOCKS_PER_BUCKET = 500


def dq_not_null(spark, sf):
    """All required columns of the decoded transfers, then with views' from
    addresses taken away."""
    decoded = transfers(spark, sf)
    columns = [
        "transaction_hash", "log_index", "block_number", "contract_address", "from_address",
        "to_address",
    ]
    minted = F.col("from_address") == "0x" + "0" * 40
    broken = decoded.withColumn("from_address", F.when(minted, F.col("from_address")))
    checks = quality.not_null_checks(columns)
    return quality.combine_reports(
        [
            quality.row_check_report(decoded, "int_all_transfer", checks),
            quality.row_check_report(broken, "broken_transfer", checks),
        ]
    )


def dq_unique(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_unique_logs(spark, sf):
    decoded = transfers(spark, sf)
    return quality.unique_report(decoded, "int_all_transfer", ["transaction_hash", "log_index"])


def dq_accepted_values(spark, sf):
    """Categories of the dimension against all of them but ``auction``."""
    allowed = [c for c in EVENT_CATEGORIES if c != "auction"]
    return quality.unexpected_values(dim_event(signatures(spark, sf)), "event_category", allowed)


def dq_valid_address(spark, sf):
    """Contract addresses that lost their prefix for one contract in three."""
    fact = fct_transfer(transfers(spark, sf), RUN_TS)
    address = F.col("contract_address")
    broken = F.when(address.endswith("2"), F.substring(address, 3, 40)).otherwise(address)
    return quality.invalid_addresses(fact.withColumn("contract_address", broken))


def dq_block_range(spark, sf):
    """Block numbers of views moved out of the plausible range, mints below 0."""
    decoded = transfers(spark, sf)
    block = F.col("block_number")
    zero = "0x" + "0" * 40
    moved = (
        F.when(F.col("from_address") == zero, -block)
        .when(F.col("to_address") == zero, block)
        .otherwise(block + 1_000_000_000)
    )
    found = quality.failing_rows(
        decoded.withColumn("block_number", moved), quality.implausible_block("block_number")
    )
    return found.select("transaction_hash", "log_index", "block_number")


def dq_report(spark, sf):
    """Every declared check, over raw logs, models and freshly built facts."""
    root = new_run_dir(spark, "checked")
    decoded = transfers(spark, sf)
    for name in FACTS:
        refresh_fact(fact_table(spark, root, name, BLOCKS_PER_BUCKET), name, decoded, RUN_TS)
    stored = {name: fact_table(spark, root, name, BLOCKS_PER_BUCKET).read() for name in FACTS}
    return quality_suite(logs(spark, sf), signatures(spark, sf), stored)


def dq_report_broken(spark, sf):
    """Every declared check on inputs that break it: every tenth raw log loses its
    required columns, every transfer comes twice with a block out of range, facts
    lose their columns and come twice, and signatures lose their topic."""
    raw, sigs = logs(spark, sf), signatures(spark, sf)
    tenth = F.col("block_number") % 10 == 0
    columns = ["log_index", "transaction_hash", "address"]
    broken_logs = raw.withColumns(
        {c: F.when(~tenth, F.col(c)) for c in columns}
        | {"block_number": F.when(~tenth, F.col("block_number"))}
    )
    decoded = transfers(spark, sf)
    facts = {}
    for name, (build, _) in FACTS.items():
        fact = build(decoded, RUN_TS)
        gone = fact.withColumns({c: F.lit(None).cast(fact.schema[c].dataType) for c in fact.columns})
        # Each row once as it is, once more, and once with nothing in it.
        facts[name] = fact.unionByName(fact).unionByName(gone)
    far = decoded.withColumn("block_number", F.lit(-1).cast("long"))
    empty = decoded.withColumns({c: F.lit(None).cast(decoded.schema[c].dataType) for c in decoded.columns})
    no_topic = sigs.where("event_name = 'Transfer'").withColumn("topic0", F.lit(None).cast("string"))
    twice = sigs.unionByName(sigs).unionByName(no_topic)
    return quality_suite(broken_logs, twice, facts, far.unionByName(far).unionByName(empty))


QUERIES = {
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_logs": dq_unique_logs,
    "dq_accepted_values": dq_accepted_values,
    "dq_valid_address": dq_valid_address,
    "dq_block_range": dq_block_range,
    "dq_report": dq_report,
    "dq_report_broken": dq_report_broken,
}

_LOG_COLUMNS = ["transaction_hash", "log_index", "block_number"]
_FACT_COLUMNS = ["transaction_hash", "log_index", "date_key", "contract_address", "dbt_loaded_at"]
_REQUIRED = {
    "open_logs": ("ev", [*_LOG_COLUMNS, "address"]),
    "stg_open_logs": ("ev", [*_LOG_COLUMNS, "contract_address"]),
    "int_all_transfer": (
        "transfers", [*_LOG_COLUMNS, "contract_address", "from_address", "to_address"]
    ),
    "fct_mint": ("transfers WHERE event_type = 'click'", [*_FACT_COLUMNS, "minting_address"]),
    "fct_burn": (
        "transfers WHERE event_type = 'purchase'",
        [*_FACT_COLUMNS, "block_number", "burned_from_address"],
    ),
    "fct_transfer": ("transfers WHERE event_type = 'view'", []),
    "event_signature": ("part", ["topic0"]),
    "stg_event_signature": ("part", ["topic0_hash"]),
    "int_event": ("part", ["topic0_hash"]),
    "dim_event": ("part", ["topic0_hash"]),
}
_COLUMN_SQL = {
    "date_key": "20240301", "dbt_loaded_at": f"'{RUN_TS}'", "address": "contract_address",
    "minting_address": "to_address", "burned_from_address": "from_address",
    "topic0": "p_partkey", "topic0_hash": "p_partkey",
}


def _report_sql() -> str:
    """Failed rows per check, counted on the rows behind each model."""
    lines = []

    def add(check, model, failed):
        lines.append(f"SELECT '{check}', '{model}', {failed} FROM {_REQUIRED[model][0]}")

    for model, (_, columns) in _REQUIRED.items():
        for column in columns:
            expression = _COLUMN_SQL.get(column, column)
            add(f"not_null:{column}", model, f"count(*) FILTER ({expression} IS NULL)")
    add("block_range:block_number", "int_all_transfer",
        "count(*) FILTER (block_number < 0 OR block_number > 999999999)")
    add("unique:transaction_hash,log_index", "int_all_transfer",
        "count(*) - count(DISTINCT (transaction_hash, log_index))")
    for fact in ("fct_mint", "fct_burn", "fct_transfer"):
        add("valid_address:contract_address", fact,
            "count(*) FILTER (length(contract_address) <> 42 OR left(contract_address, 2) <> '0x')")
        add("unique:transaction_hash,log_index", fact,
            "count(*) - count(DISTINCT (transaction_hash, log_index))")
    add("accepted_values:event_category", "dim_event", "count(*) FILTER (p_partkey IS NULL)")
    for model in ("stg_event_signature", "dim_event"):
        add("unique:topic0_hash", model, "count(*) - count(DISTINCT p_partkey)")
    return " UNION ALL ".join(lines)


def _not_null_sql() -> str:
    columns = [
        "transaction_hash", "log_index", "block_number", "contract_address", "from_address",
        "to_address",
    ]
    lines = []
    for column in columns:
        lines.append(
            f"SELECT 'not_null:{column}', 'int_all_transfer', "
            f"count(*) FILTER ({column} IS NULL) FROM transfers"
        )
        failing = "event_type <> 'click'" if column == "from_address" else f"{column} IS NULL"
        lines.append(
            f"SELECT 'not_null:{column}', 'broken_transfer', "
            f"count(*) FILTER ({failing}) FROM transfers"
        )
    return " UNION ALL ".join(lines)


def _broken_sql() -> str:
    """Failed rows per check of ``dq_report_broken``."""
    kinds = {"fct_mint": "click", "fct_burn": "purchase", "fct_transfer": "view"}
    lines = []

    def add(check, model, number, source):
        lines.append(f"SELECT '{check}', '{model}', CAST({number} AS BIGINT) FROM {source}")

    for model, (_, columns) in _REQUIRED.items():
        for column in columns:
            check = f"not_null:{column}"
            if model in ("open_logs", "stg_open_logs"):
                add(check, model, "count(*)", "ev WHERE block_number % 10 = 0")
            elif model == "int_all_transfer":
                add(check, model, "count(*)", "transfers")
            elif model in kinds:
                add(check, model, "count(*)", f"transfers WHERE event_type = '{kinds[model]}'")
            else:
                add(check, model, "1", "(SELECT 1)")
    add("block_range:block_number", "int_all_transfer", "2 * count(*)", "transfers")
    add("unique:transaction_hash,log_index", "int_all_transfer", "count(*)", "transfers")
    for model, kind in kinds.items():
        source = f"transfers WHERE event_type = '{kind}'"
        add("valid_address:contract_address", model, "count(*)", source)
        add("unique:transaction_hash,log_index", model, "count(*)", source)
    add("accepted_values:event_category", "dim_event", "0", "(SELECT 1)")
    for model in ("stg_event_signature", "dim_event"):
        add("unique:topic0_hash", model, "count(*) + 2", "part")
    return " UNION ALL ".join(lines)


_STATUS = "CASE WHEN failed_rows > 0 THEN 'fail' ELSE 'pass' END AS status"

ORACLES = {
    "dq_not_null": f"""WITH {EV}, report(check_name, table_name, failed_rows) AS (
        {_not_null_sql()}) SELECT *, {_STATUS} FROM report""",
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_unique_logs": f"""WITH {EV} SELECT 'unique:transaction_hash,log_index' AS check_name,
        'int_all_transfer' AS table_name, count(*) AS failed_rows FROM (
          SELECT 1 FROM transfers GROUP BY transaction_hash, log_index HAVING count(*) > 1)""",
    "dq_accepted_values": """SELECT 'auction' AS value, count(*) AS n_records FROM part
        WHERE p_partkey % 7 = 4 HAVING count(*) > 0""",
    "dq_valid_address": f"""WITH {EV} SELECT substr(contract_address, 3) AS contract_address,
        count(*) AS invalid_count FROM transfers WHERE event_type = 'view' AND user_id % 3 = 1
        GROUP BY 1""",
    "dq_block_range": f"""WITH {EV} SELECT transaction_hash, log_index,
        CASE WHEN event_type = 'view' THEN block_number + 1000000000 ELSE -block_number END
          AS block_number
        FROM transfers WHERE event_type = 'view' OR (event_type = 'click' AND block_number > 0)""",
    "dq_report": f"""WITH {EV}, report(check_name, table_name, failed_rows) AS (
        {_report_sql()}) SELECT *, {_STATUS} FROM report""",
    "dq_report_broken": f"""WITH {EV}, report(check_name, table_name, failed_rows) AS (
        {_broken_sql()}) SELECT *, {_STATUS} FROM report""",
}
