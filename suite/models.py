"""Scans, scalar functions, models, facts and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from logtide.functions.columns import date_key, with_optional_column
from logtide.functions.hexnum import (
    base64_to_hex,
    bytes_to_hex,
    hex_exact,
    hex_low64,
    strip_hex_prefix,
    token_amount,
    topic_to_address,
    trim_leading_zeros,
    uint256_to_decimal,
)
from logtide.operators.event_catalog import event_catalog
from logtide.operators.metrics import MINT_MODEL, metric_query, top_minters
from logtide.plans.marts import dim_event, fct_burn, fct_mint, fct_transfer
from logtide.plans.staging import stg_event_signature, stg_open_logs
from logtide.plans.transfers import int_all_transfer, with_token_amount
from suite.common import EV, RUN_TS, as_text, logs, once, signatures, table, tokens_sql, transfers
from suite.event_fixture import abi_rows, nested_abi_rows, token_rows

KEY = ["block_number", "log_index"]


def scan_logs(spark, sf):
    return logs(spark, sf).select(
        "removed", "log_index", "transaction_index", "block_number",
        F.octet_length("transaction_hash").alias("hash_bytes"),
        F.octet_length("data").alias("data_bytes"),
    )


def scan_signatures(spark, sf):
    return signatures(spark, sf)


def _hexed(spark, sf):
    return stg_open_logs(logs(spark, sf)).withColumn("digits", F.substring("event_data", 3, 64))


def q_bytes_to_hex(spark, sf):
    return logs(spark, sf).select(
        *KEY,
        bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash"),
        bytes_to_hex(F.col("address")).alias("contract_address"),
    )


def q_base64_to_hex(spark, sf):
    """Data as base64 text; removed logs have a character that base64 has not."""
    text = F.base64("data")
    sent = F.when(F.col("removed"), F.concat(text, F.lit("*"))).otherwise(text)
    return logs(spark, sf).select(*KEY, base64_to_hex(sent).alias("event_data"))


def q_topic_to_address(spark, sf):
    return stg_open_logs(logs(spark, sf)).select(
        *KEY,
        topic_to_address(F.col("topic1")).alias("from_address"),
        topic_to_address(F.col("topic2")).alias("to_address"),
    )


def q_trim_leading_zeros(spark, sf):
    return _hexed(spark, sf).select(*KEY, trim_leading_zeros(F.col("digits")).alias("digits"))


def q_hex_exact(spark, sf):
    value = F.coalesce(hex_exact(F.col("digits")), F.lit(-1))
    return as_text(_hexed(spark, sf).select(*KEY, value.alias("amount_raw")), "amount_raw")


def q_hex_low64(spark, sf):
    digits = strip_hex_prefix(trim_leading_zeros(F.col("digits")))
    return as_text(_hexed(spark, sf).select(*KEY, hex_low64(digits).alias("amount_raw")), "amount_raw")


def q_uint256_to_numeric(spark, sf):
    staged = stg_open_logs(logs(spark, sf))
    return as_text(
        staged.select(*KEY, uint256_to_decimal(F.col("topic2")).alias("topic_value")), "topic_value"
    )


def q_token_amount(spark, sf):
    decoded = _hexed(spark, sf).select(*KEY, token_amount(hex_exact(F.col("digits"))).alias("amount"))
    return as_text(decoded, "amount")


def q_convert_token_amount(spark, sf):
    raw = logs(spark, sf)
    tokens = token_rows(raw).withColumn("chain", F.lit("ethereum"))
    # The same contracts on another chain, with other decimals.
    others = tokens.withColumns({"chain": F.lit("polygon"), "decimals": F.col("decimals") - 3})
    converted = with_token_amount(transfers(spark, sf), tokens.unionByName(others), chain="ethereum")
    return as_text(
        converted.select(*KEY, "contract_address", "token_amount", "token_amount_overflow"),
        "token_amount",
    )


def q_date_key(spark, sf):
    return table(spark, sf, "events").select("event_id", date_key(F.col("ts")).alias("date_key"))


def q_optional_column(spark, sf):
    """A column that the logs lack gets its default, one they have stays."""
    staged = stg_open_logs(logs(spark, sf)).select(*KEY, "contract_address")
    filled = with_optional_column(staged, "topic3", "0x")
    return with_optional_column(filled, "CONTRACT_ADDRESS", "none")


def q_event_catalog(spark, sf):
    part = table(spark, sf, "part")
    path = once(spark, sf, "abi", lambda p: abi_rows(part).write.parquet(p))
    return event_catalog(spark.read.parquet(path), signatures(spark, sf)).select(
        "topic0", "event_name", "signature",
        F.size(F.from_json("inputs", "array<struct<name string>>")).alias("n_inputs"),
    )


def q_event_catalog_nested(spark, sf):
    """Signatures of tuples nested up to 30 deep."""
    part = table(spark, sf, "part")
    path = once(spark, sf, "nested_abi", lambda p: nested_abi_rows(part).write.parquet(p))
    return event_catalog(spark.read.parquet(path), signatures(spark, sf)).select(
        "event_name", "signature", F.col("topic0").isNull().alias("unknown")
    )


def decode_transfers(spark, sf):
    return as_text(transfers(spark, sf), "amount_raw", "amount")


def q_decode_low64(spark, sf):
    return as_text(transfers(spark, sf, "low64").select(*KEY, "amount_raw", "amount"), "amount_raw", "amount")


def q_decode_high16(spark, sf):
    return as_text(transfers(spark, sf, "high16").select(*KEY, "amount_raw"), "amount_raw")


def mint(spark, sf):
    return fct_mint(transfers(spark, sf), RUN_TS)


def q_fct_mint(spark, sf):
    return as_text(mint(spark, sf), "minted_amount", "dbt_loaded_at")


def q_fct_burn(spark, sf):
    burned = fct_burn(transfers(spark, sf), RUN_TS)
    return as_text(burned, "amount_raw", "burned_amount", "dbt_loaded_at")


def q_fct_transfer(spark, sf):
    regular = fct_transfer(transfers(spark, sf), RUN_TS)
    return as_text(regular, "amount_raw", "amount", "dbt_loaded_at")


def q_top_minters(spark, sf):
    return as_text(top_minters(mint(spark, sf), 3), "total_minted")


def q_top_minters_large(spark, sf):
    """The largest mints when every amount is 2^160 times as large, past 10^38."""
    zeros = F.unhex(F.lit("00" * 20))
    raised = logs(spark, sf).withColumn(
        "data", F.when(F.length("data") == 32, F.concat(F.substring("data", 21, 12), zeros)).otherwise(F.col("data"))
    )
    decoded = int_all_transfer(raised, signatures(spark, sf))
    return as_text(top_minters(fct_mint(decoded, RUN_TS), 3), "total_minted")


def q_metric_query(spark, sf):
    """Minted amount and mints by contract and day, of the larger mints."""
    result = metric_query(
        mint(spark, sf),
        MINT_MODEL,
        dimensions=["contract_address", "date_key"],
        measures={
            "total_minted": ("sum", "minted_amount"),
            "largest_mint": ("max", "minted_amount"),
            "mint_count": ("count", "*"),
        },
        where=F.col("minted_amount") >= 1,
        order_by=["total_minted"],
    )
    return as_text(result, "total_minted", "largest_mint")


QUERIES = {
    "scan_logs": scan_logs,
    "scan_signatures": scan_signatures,
    "stg_open_logs": lambda spark, sf: stg_open_logs(logs(spark, sf)),
    "stg_event_signature": lambda spark, sf: stg_event_signature(signatures(spark, sf)),
    "bytes_to_hex": q_bytes_to_hex,
    "base64_to_hex": q_base64_to_hex,
    "topic_to_address": q_topic_to_address,
    "trim_leading_zeros": q_trim_leading_zeros,
    "hex_exact": q_hex_exact,
    "hex_low64": q_hex_low64,
    "uint256_to_numeric": q_uint256_to_numeric,
    "token_amount": q_token_amount,
    "convert_token_amount": q_convert_token_amount,
    "date_key": q_date_key,
    "optional_column": q_optional_column,
    "dim_event": lambda spark, sf: dim_event(signatures(spark, sf)),
    "event_catalog": q_event_catalog,
    "event_catalog_nested": q_event_catalog_nested,
    "decode_transfers": decode_transfers,
    "decode_transfers_low64": q_decode_low64,
    "decode_transfers_high16": q_decode_high16,
    "fct_mint": q_fct_mint,
    "fct_burn": q_fct_burn,
    "fct_transfer": q_fct_transfer,
    "top_minters": q_top_minters,
    "top_minters_large": q_top_minters_large,
    "metric_query": q_metric_query,
}

SIG = """
sig AS (
  SELECT '0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef' AS topic0,
    'Transfer' AS event_name, 'Transfer(address,address,uint256)' AS signature
  UNION ALL
  SELECT '0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925',
    'Approval', 'Approval(address,address,uint256)'
  UNION ALL
  SELECT '0x' || sha256(CAST(p_partkey AS VARCHAR)), name, name || '(' || types || ')'
  FROM (
    SELECT p_partkey,
      ['RoleGranted', 'RoleRevoked', 'Upgraded', 'Initialized', 'AuctionStarted',
       'RebalanceStarted', 'Paused'][p_partkey % 7 + 1]
        || CASE WHEN p_partkey >= 7 THEN CAST(p_partkey // 7 AS VARCHAR) ELSE '' END AS name,
      'uint256' || repeat(',uint256', p_size - 1) AS types
    FROM part
  )
)
"""

_TRANSFER_AMOUNTS = f"CAST(raw AS VARCHAR) AS amount_raw, {tokens_sql('raw')} AS amount"
_RUN = f"20240301 AS date_key, '{RUN_TS}' AS dbt_loaded_at"

_DIGITS = "ltrim(substr(event_data, 3), '0') AS amount_hex, false AS amount_overflow"
_TOP_MINTED = """summed AS (
    SELECT to_address, sum(raw) AS total, count(*) AS n, count(*) FILTER (raw = 0) AS zeros
    FROM transfers WHERE event_type = 'click'
    GROUP BY to_address ORDER BY total DESC, to_address LIMIT 3)"""


def _hex_sql(number: str) -> str:
    """Hex digits of a HUGEINT, from two parts that fit a BIGINT."""
    part = "1152921504606846976"
    return (
        f"(printf('%x', CAST(CAST({number} AS HUGEINT) // {part} AS BIGINT))"
        f" || lpad(printf('%x', CAST(CAST({number} AS HUGEINT) % {part} AS BIGINT)), 15, '0'))"
    )


ORACLES = {
    "scan_logs": f"""WITH {EV} SELECT is_removed AS removed, log_index, transaction_index,
        block_number, 32 AS hash_bytes, CASE WHEN event_data = '0x' THEN 0 ELSE 32 END AS data_bytes
        FROM ev""",
    "scan_signatures": f"WITH {SIG} SELECT * FROM sig",
    "stg_open_logs": f"""WITH {EV} SELECT is_removed, log_index, transaction_index, block_number,
        transaction_hash, block_hash, contract_address, topic0, topic1, topic2, event_data FROM ev""",
    "stg_event_signature": f"""WITH {SIG} SELECT topic0 AS topic0_hash,
        left(event_name, 100) AS event_name, left(signature, 255) AS event_signature FROM sig""",
    "bytes_to_hex": f"""WITH {EV} SELECT block_number, log_index, transaction_hash,
        contract_address FROM ev""",
    "base64_to_hex": f"""WITH {EV} SELECT block_number, log_index,
        CASE WHEN NOT is_removed THEN event_data END AS event_data FROM ev""",
    "topic_to_address": f"""WITH {EV} SELECT block_number, log_index, from_address, to_address
        FROM ev""",
    "trim_leading_zeros": f"""WITH {EV} SELECT block_number, log_index,
        ltrim(substr(event_data, 3), '0') AS digits FROM ev""",
    "hex_exact": f"""WITH {EV} SELECT block_number, log_index, CAST(raw AS VARCHAR) AS amount_raw
        FROM ev""",
    "hex_low64": f"""WITH {EV} SELECT block_number, log_index,
        CAST(raw % 18446744073709551616 AS VARCHAR) AS amount_raw FROM ev""",
    "uint256_to_numeric": f"""WITH {EV} SELECT block_number, log_index,
        CAST(CASE WHEN event_type = 'purchase' THEN 0 ELSE user_id + 1000 END AS VARCHAR)
          AS topic_value FROM ev""",
    "token_amount": f"""WITH {EV} SELECT block_number, log_index, {tokens_sql('raw')} AS amount
        FROM ev""",
    "convert_token_amount": f"""WITH {EV}, scaled AS (
          SELECT block_number, log_index, contract_address,
            (raw * 100000000 + unit // 2) // unit AS n
          FROM (SELECT *, CAST([1000000, 100000000, 1000000000000000000][user_id % 3 + 1]
                  AS HUGEINT) AS unit FROM transfers))
        SELECT block_number, log_index, contract_address,
          (n // 100000000) || '.' || lpad(CAST(n % 100000000 AS VARCHAR), 8, '0') AS token_amount,
          false AS token_amount_overflow
        FROM scaled""",
    "date_key": """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key
        FROM events""",
    "optional_column": f"""WITH {EV} SELECT block_number, log_index, contract_address,
        '0x' AS topic3 FROM ev""",
    "dim_event": f"""WITH {SIG}, s AS (SELECT topic0, event_name, left(signature, 255) AS sign FROM sig)
        SELECT topic0 AS topic0_hash, event_name, sign AS event_signature,
          split_part(sign, '(', 1) AS event_base_name,
          split_part(split_part(sign, '(', 2), ')', 1) AS event_parameters,
          CASE WHEN event_name = 'Transfer' THEN 'token_transfer'
            WHEN event_name = 'Approval' THEN 'token_approval'
            WHEN event_name IN ('RoleGranted', 'RoleRevoked', 'RoleAdminChanged')
              THEN 'access_control'
            WHEN event_name IN ('Upgraded', 'AdminChanged', 'Initialized') THEN 'contract_upgrade'
            WHEN event_name LIKE 'Auction%' THEN 'auction'
            WHEN event_name LIKE 'Rebalance%' THEN 'rebalancing'
            ELSE 'other' END AS event_category
        FROM s""",
    "event_catalog": f"""WITH {SIG} SELECT topic0, event_name, signature,
          CAST(length(signature) - length(replace(signature, ',', '')) + 1 AS INTEGER) AS n_inputs
        FROM sig WHERE event_name <> 'Approval'""",
    "event_catalog_nested": """WITH p AS (
          SELECT 'Nested' || p_partkey AS event_name, least(greatest(p_size, 1), 30) AS n FROM part)
        SELECT event_name, event_name || '(' || repeat('(address,', n) || 'uint256'
          || repeat(')[' || n || ']', n) || ')' AS signature, true AS unknown FROM p""",
    "decode_transfers": f"""WITH {EV} SELECT transaction_hash, log_index, block_number, block_hash,
        contract_address, from_address, to_address, {_TRANSFER_AMOUNTS}, 'Transfer' AS event_name,
        transaction_index, ltrim(substr(event_data, 3), '0') AS amount_hex,
        false AS amount_overflow FROM transfers""",
    "decode_transfers_low64": f"""WITH {EV}, low AS (
          SELECT block_number, log_index, raw % 18446744073709551616 AS raw FROM transfers)
        SELECT block_number, log_index, {_TRANSFER_AMOUNTS} FROM low""",
    "decode_transfers_high16": f"""WITH {EV}, hexed AS (
          SELECT block_number, log_index, raw, length(ltrim(substr(event_data, 3), '0')) AS n
          FROM transfers)
        SELECT block_number, log_index,
          CAST(CASE WHEN n <= 16 THEN raw ELSE raw // CAST(power(16, n - 16) AS HUGEINT) END
            AS VARCHAR) AS amount_raw FROM hexed""",
    "fct_mint": f"""WITH {EV} SELECT transaction_hash, log_index, block_number, contract_address,
        to_address AS minting_address, {tokens_sql('raw')} AS minted_amount, {_DIGITS}, {_RUN}
        FROM transfers WHERE event_type = 'click'""",
    "fct_burn": f"""WITH {EV} SELECT transaction_hash, log_index, block_number, block_hash,
        contract_address, from_address AS burned_from_address, CAST(raw AS VARCHAR) AS amount_raw,
        {tokens_sql('raw')} AS burned_amount, 'Transfer' AS event_name, transaction_index,
        {_DIGITS}, {_RUN} FROM transfers WHERE event_type = 'purchase'""",
    "fct_transfer": f"""WITH {EV} SELECT transaction_hash, log_index, block_number, block_hash,
        contract_address, from_address, to_address, {_TRANSFER_AMOUNTS}, 'Transfer' AS event_name,
        transaction_index, {_DIGITS}, {_RUN} FROM transfers WHERE event_type = 'view'""",
    "top_minters": f"""WITH {EV}, {_TOP_MINTED}
        SELECT to_address AS minting_address, {tokens_sql('CAST(total AS HUGEINT)')} AS total_minted,
          lpad({_hex_sql('total')}, 72, '0') AS total_hex, n AS mint_count,
          CAST(0 AS BIGINT) AS overflow_count FROM summed""",
    "top_minters_large": f"""WITH {EV}, {_TOP_MINTED}
        SELECT to_address AS minting_address,
          CASE WHEN zeros > 0 THEN '0.000000000000000000' END AS total_minted,
          lpad({_hex_sql('total')} || repeat('0', 40), 72, '0') AS total_hex, n AS mint_count,
          n - zeros AS overflow_count FROM summed""",
    "metric_query": f"""WITH {EV}, summed AS (
          SELECT contract_address, sum(raw) AS total, max(raw) AS largest, count(*) AS n
          FROM transfers WHERE event_type = 'click' AND raw >= 1000000000000000000
          GROUP BY contract_address)
        SELECT contract_address, 20240301 AS date_key,
          {tokens_sql('CAST(total AS HUGEINT)')} AS total_minted,
          {tokens_sql('largest')} AS largest_mint, n AS mint_count FROM summed""",
}
