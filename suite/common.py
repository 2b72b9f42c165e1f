"""What the registered queries share: derived inputs and exact output text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import APPROVAL_TOPIC, TRANSFER_TOPIC
from logtide.plans.transfers import int_all_transfer
from logtide.session import new_run_dir
from logtide.sources.files import scan_logs, scan_signatures
from suite.event_fixture import UNKNOWN_TOPIC, log_rows, signature_rows

RUN_TS = "2024-03-01 12:00:00"
SECOND_RUN_TS = "2024-03-02 12:00:00"

_WRITTEN: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Write a derived input once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = new_run_dir(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logs of all events, scanned from Parquet."""
    path = once(
        spark, sf_dir, "open_logs",
        lambda p: log_rows(table(spark, sf_dir, "events")).write.parquet(p),
    )
    return scan_logs(spark, path)


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signature catalog, scanned from CSV."""
    path = once(
        spark, sf_dir, "event_signature",
        lambda p: signature_rows(table(spark, sf_dir, "part")).write.csv(p, header=True, escape='"'),
    )
    return scan_signatures(spark, path)


def transfers(spark: SparkSession, sf_dir: str, mode: str = "exact") -> DataFrame:
    return int_all_transfer(logs(spark, sf_dir), signatures(spark, sf_dir), mode=mode)


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals and timestamps as text, so that comparisons see every digit."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in columns:
        c, kind = F.col(name), types[name]
        if isinstance(kind, T.TimestampType):
            text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind.scale:
            # A plain cast writes small numbers with an exponent outside ANSI mode.
            whole = "9" * (kind.precision - kind.scale - 1)
            text = F.trim(F.to_char(c, F.lit(f"{whole}0.{'0' * kind.scale}")))
        else:
            text = c.cast("string")
        df = df.withColumn(name, text)
    return df


# --- SQL: the same answers straight from the given tables ------------------

EV = f"""
ev AS (
  SELECT event_id, user_id, event_type,
    event_id // 10 AS block_number,
    event_id % 10 AS log_index,
    event_id % 4 AS transaction_index,
    event_id % 50 = 7 AS is_removed,
    '0x' || sha256(CAST(event_id // 2 AS VARCHAR)) AS transaction_hash,
    '0x' || sha256(CAST(event_id // 10 AS VARCHAR)) AS block_hash,
    '0x' || lpad(printf('%x', user_id % 3 + 1), 40, '0') AS contract_address,
    CASE event_type WHEN 'signup' THEN '{APPROVAL_TOPIC}' WHEN 'error' THEN '{UNKNOWN_TOPIC}'
      ELSE '{TRANSFER_TOPIC}' END AS topic0,
    '0x' || lpad(CASE WHEN event_type = 'click' THEN '' ELSE printf('%x', user_id + 1) END,
      64, '0') AS topic1,
    '0x' || lpad(CASE WHEN event_type = 'purchase' THEN '' ELSE printf('%x', user_id + 1000) END,
      64, '0') AS topic2,
    '0x' || lpad(CASE WHEN event_type = 'click' THEN '' ELSE printf('%x', user_id + 1) END,
      40, '0') AS from_address,
    '0x' || lpad(CASE WHEN event_type = 'purchase' THEN '' ELSE printf('%x', user_id + 1000) END,
      40, '0') AS to_address,
    CASE WHEN event_id % 97 = 0 THEN '0x' ELSE
      '0x' || lpad(printf('%x', CAST(round(value * 100) AS BIGINT)) || repeat('0', 14), 64, '0')
      END AS event_data,
    CASE WHEN event_id % 97 = 0 THEN CAST(0 AS HUGEINT)
      ELSE CAST(round(value * 100) AS HUGEINT) * 72057594037927936 END AS raw
  FROM events
),
transfers AS (
  SELECT * FROM ev WHERE event_type IN ('click', 'purchase', 'view') AND NOT is_removed
)
"""

_E18 = "1000000000000000000"


def tokens_sql(raw: str) -> str:
    """Text of ``raw / 10^18`` with all 18 digits."""
    return f"(({raw}) // {_E18}) || '.' || lpad(CAST(({raw}) % {_E18} AS VARCHAR), 18, '0')"
