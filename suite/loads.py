"""Reads by block, file bookkeeping, loads, upserts and history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from logtide.constants import ZERO_ADDRESS
from logtide.functions.hexnum import bytes_to_hex
from logtide.operators.dedup import dedup_logs as first_logs
from logtide.operators.scd2 import scd2_replay as replay
from logtide.operators.scd2 import scd2_snapshot as next_history
from logtide.operators.scd2 import start_history
from logtide.plans import daily_run
from logtide.plans.incremental import fact_table, refresh_fact
from logtide.plans.marts import fct_mint
from logtide.schemas import RAW_LOGS
from logtide.session import new_run_dir
from logtide.sources import files
from logtide.sources.loads import load, with_load_lineage
from logtide.streaming.sink import insert_first, sink_table
from suite.common import (
    EV,
    RUN_TS,
    SECOND_RUN_TS,
    as_text,
    logs,
    signatures,
    table,
    tokens_sql,
    transfers,
)
from suite.event_fixture import transfer_events

KEY = ["block_number", "log_index"]
BLOCKS_PER_BUCKET = 500
LOAD_BUCKETS = 8
FAR = 1_000_000
# 2024-03-01 00:00:00 UTC.
FIRST_DAY = 1_709_251_200


def _last_block(spark, sf) -> int:
    return logs(spark, sf).agg(F.max("block_number")).first()[0]


# --- reads by block --------------------------------------------------------


def high_water_mark(spark, sf):
    """Largest stored block of the mint fact, from its last bucket."""
    fact = fact_table(spark, new_run_dir(spark, "hwm"), "fct_mint", BLOCKS_PER_BUCKET)
    fact.append(fct_mint(transfers(spark, sf), RUN_TS))
    return spark.createDataFrame([(fact.high_water("block_number"),)], "max_block long")


def block_extent(spark, sf):
    return files.block_extent(logs(spark, sf))


def block_extent_footers(spark, sf):
    """The extent of three stamped files and an empty one, from their footers."""
    folder, written = _stamped_parts(spark, sf)
    logs(spark, sf).limit(0).write.parquet(f"{folder}/open_logs_240104_0_0.parquet")
    paths = [w["path"] for w in written]
    return files.block_extent_of_files(spark, *paths, f"{folder}/open_logs_240104_0_0.parquet")


def schema_drift(spark, sf):
    """Files of the logs as they should be, and with columns left out, added and changed."""
    folder, raw = new_run_dir(spark, "drift"), logs(spark, sf)
    made = {
        "open_logs_1_1.parquet": raw,
        "open_logs_2_2.parquet": raw.drop("topic2").withColumn("chain", F.lit("x")),
        "open_logs_3_3.parquet": raw.withColumn("log_index", F.col("log_index").cast("string")),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{folder}/{name}")
    return files.schema_drift(spark, [f"{folder}/{name}" for name in made], RAW_LOGS)


def block_range_filter(spark, sf):
    last = _last_block(spark, sf)
    found = files.block_range(logs(spark, sf), last // 4, last // 2)
    return found.select(*KEY, bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash"))


def incremental_poll(spark, sf):
    """What comes after the middle block: 25 rows, and the rest of the third block."""
    events = transfer_events(logs(spark, sf))
    return files.poll_after(events, _last_block(spark, sf) // 2, 25)


def latest_event(spark, sf):
    return files.latest_record(transfer_events(logs(spark, sf)))


# --- stamped files ---------------------------------------------------------


def _stamped_parts(spark, sf):
    """The logs in three dated files, cut at thirds of the block range."""
    folder = new_run_dir(spark, "stamped")
    raw, last = logs(spark, sf), _last_block(spark, sf)
    cuts = [0, last // 3, 2 * last // 3, last + 1]
    written = []
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = files.block_range(raw, low, high - 1)
        day = date(2024, 1, 1 + number)
        written.append(files.range_stamped_write(part, folder, "open_logs", day))
    return folder, written


def range_stamped_write(spark, sf):
    _, written = _stamped_parts(spark, sf)
    rows = [(w["path"].rsplit("/", 1)[1], w["from_block"], w["to_block"], w["row_count"]) for w in written]
    return spark.createDataFrame(rows, "file string, from_block long, to_block long, row_count long")


def file_block_inventory(spark, sf):
    folder, _ = _stamped_parts(spark, sf)
    return files.file_inventory(spark, folder, "open_logs")


def latest_file(spark, sf):
    folder, _ = _stamped_parts(spark, sf)
    return files.latest_file(files.file_inventory(spark, folder, "open_logs"))


# --- loads -----------------------------------------------------------------


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def load_append(spark, sf):
    """All orders, then the open ones once more."""
    root, orders = new_run_dir(spark, "append"), _orders(spark, sf)
    load(orders, root, "append", buckets=LOAD_BUCKETS)
    again = orders.where("o_orderstatus = 'O'")
    return load(again, root, "append", buckets=LOAD_BUCKETS).read()


def load_replace(spark, sf):
    """All orders, replaced by those that are not open."""
    root, orders = new_run_dir(spark, "replace"), _orders(spark, sf)
    load(orders, root, "append", buckets=LOAD_BUCKETS)
    others = orders.where("o_orderstatus <> 'O'")
    return load(others, root, "replace", buckets=LOAD_BUCKETS).read()


def load_merge(spark, sf):
    """The orders without the fulfilled ones, merged with all but the pending
    ones at double price: open orders change, fulfilled ones are new."""
    root, orders = new_run_dir(spark, "merge"), _orders(spark, sf)
    load(orders.where("o_orderstatus <> 'F'"), root, "append", ["o_orderkey"], buckets=LOAD_BUCKETS)
    doubled = orders.where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return load(doubled, root, "merge", ["o_orderkey"], buckets=LOAD_BUCKETS).read()


def load_lineage(spark, sf):
    return with_load_lineage(_orders(spark, sf), "load-1", ["o_orderkey"])


def upsert_delete_insert(spark, sf):
    """The mint fact of one run, then the upper half of the blocks once more."""
    fact = fact_table(spark, new_run_dir(spark, "upsert"), "fct_mint", BLOCKS_PER_BUCKET)
    decoded, middle = transfers(spark, sf), _last_block(spark, sf) // 2
    fact.upsert(fct_mint(decoded, RUN_TS))
    fact.upsert(fct_mint(decoded.where(F.col("block_number") > middle), SECOND_RUN_TS))
    return as_text(fact.read(), "minted_amount", "dbt_loaded_at")


def fct_mint_incremental(spark, sf):
    """The mint fact built up to the middle block, then brought up to date."""
    fact = fact_table(spark, new_run_dir(spark, "incremental"), "fct_mint", BLOCKS_PER_BUCKET)
    decoded, middle = transfers(spark, sf), _last_block(spark, sf) // 2
    refresh_fact(fact, "fct_mint", decoded.where(F.col("block_number") <= middle), RUN_TS)
    refresh_fact(fact, "fct_mint", decoded, SECOND_RUN_TS)
    return as_text(fact.read(), "minted_amount", "dbt_loaded_at")


def fct_mint_moved(spark, sf):
    """The mint fact, then a third of its logs once more, a million blocks further on."""
    fact = fact_table(spark, new_run_dir(spark, "moved"), "fct_mint", BLOCKS_PER_BUCKET)
    decoded = transfers(spark, sf)
    fact.upsert(fct_mint(decoded, RUN_TS))
    moved = decoded.where("log_index % 3 = 1").withColumn("block_number", F.col("block_number") + FAR)
    fact.upsert(fct_mint(moved, SECOND_RUN_TS))
    return as_text(fact.read(), "minted_amount", "dbt_loaded_at")


def insert_if_absent(spark, sf):
    """The mints, then all events twice with other values."""
    sink = sink_table(spark, new_run_dir(spark, "absent"))
    events = transfer_events(logs(spark, sf))
    insert_first(sink, events.where(F.col("from_address") == ZERO_ADDRESS), run_ts=RUN_TS)
    changed = events.withColumn("value", F.concat("value", F.lit("1")))
    again = events.withColumn("value", F.concat("value", F.lit("2")))
    batch = changed.withColumn("offset", F.lit(1)).unionByName(again.withColumn("offset", F.lit(2)))
    insert_first(sink, batch, ("offset",), run_ts=SECOND_RUN_TS)
    return as_text(sink.read(), "created_at")


def dedup_logs(spark, sf):
    """Logs, a removed copy of each, and as many removed copies under one key."""
    raw = logs(spark, sf)
    removed = raw.withColumn("removed", F.lit(True))
    hot_hash = F.unhex(F.sha2(F.lit("0"), 256))
    hot = removed.withColumn("transaction_hash", hot_hash).withColumn("log_index", F.lit(0))
    copies = raw.unionByName(removed).unionByName(hot)
    return first_logs(copies).select(
        *KEY, "removed", bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash"),
        bytes_to_hex(F.col("topic1")).alias("topic1"),
    )


def scd2_snapshot(spark, sf):
    """Customers of one day against the next: the building segment is new, the
    machinery one is gone, households change their balance."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    before = customers.where("c_mktsegment <> 'BUILDING'")
    changed = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_acctbal") * 2)
    after = customers.where("c_mktsegment <> 'MACHINERY'").withColumn(
        "c_acctbal", F.coalesce(changed, F.col("c_acctbal"))
    )
    history = start_history(before, ["c_custkey"], RUN_TS)
    check = ["c_name", "c_mktsegment", "c_acctbal"]
    result = next_history(history, after, ["c_custkey"], check, SECOND_RUN_TS)
    return as_text(result, "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def scd2_replay(spark, sf):
    """Customers on five days: each is missing on one day in four, and its balance
    changes on one day in three."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    key, day = F.col("c_custkey"), F.col("day")
    days = customers.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(4)).cast("array<long>")))
    snapshots = days.where((key + day) % 4 != 0).select(
        "c_custkey", "c_name", (F.col("c_acctbal") + F.floor((key + day) / 3)).alias("c_acctbal"),
        F.timestamp_seconds(F.lit(FIRST_DAY) + day * 86_400).alias("taken_at"),
    )
    result = replay(snapshots, ["c_custkey"], ["c_name", "c_acctbal"])
    return as_text(result, "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _fact_totals(spark, root):
    """Rows and total of every fact and day of the stored facts."""
    amounts = {"fct_mint": "minted_amount", "fct_burn": "burned_amount", "fct_transfer": "amount"}
    reports = []
    for name, amount in amounts.items():
        fact = fact_table(spark, root, name, BLOCKS_PER_BUCKET).read()
        reports.append(
            fact.groupBy("date_key")
            .agg(F.count("*").alias("row_count"), F.sum(amount).cast("string").alias("total"))
            .select(F.lit(name).alias("fact"), "date_key", "row_count", "total")
        )
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


class _Daily:
    """A folder of stamped files and the tables of the daily job beside it."""

    def __init__(self, spark, sf, name):
        base = new_run_dir(spark, name)
        self.spark, self.folder, self.root = spark, f"{base}/files", f"{base}/tables"
        self.raw, self.signatures = logs(spark, sf), signatures(spark, sf)
        self.last = _last_block(spark, sf)

    def put(self, rows, day):
        files.range_stamped_write(rows, self.folder, "open_logs", date(2024, 3, day))

    def run(self, day):
        return daily_run.run(
            self.spark, self.folder, "open_logs", self.signatures, self.root,
            f"2024-03-{day:02d} 12:00:00", BLOCKS_PER_BUCKET,
        )["status"]


def daily_run_facts(spark, sf):
    """Two daily runs over overlapping files, then a third with nothing new."""
    job = _Daily(spark, sf, "daily")
    job.put(files.block_range(job.raw, 0, job.last // 2), 1)
    job.run(1)
    job.put(files.block_range(job.raw, job.last // 2 - 5, job.last), 2)
    job.run(2)
    return _fact_totals(spark, job.root).withColumn("last_status", F.lit(job.run(3)))


def daily_run_resumed(spark, sf):
    """Files loaded by a run that got no further; the next run takes up the rest,
    though there is no new file."""
    job = _Daily(spark, sf, "resumed")
    job.put(job.raw, 1)
    raw = daily_run.raw_table(spark, job.root, BLOCKS_PER_BUCKET)
    daily_run.load_new_files(raw, job.folder, "open_logs", daily_run.JobLog(spark, job.root))
    statuses = [job.run(2), job.run(3)]
    return _fact_totals(spark, job.root).withColumn("statuses", F.lit(",".join(statuses)))


def daily_run_late_file(spark, sf):
    """The upper half of the blocks first, the lower half a day later."""
    job = _Daily(spark, sf, "late")
    job.put(files.block_range(job.raw, job.last // 2 + 1, job.last), 2)
    first = job.run(1)
    job.put(files.block_range(job.raw, 0, job.last // 2), 1)
    statuses = f"{first},{job.run(2)}"
    return _fact_totals(spark, job.root).withColumn("statuses", F.lit(statuses))


def daily_run_reorg(spark, sf):
    """A later file brings logs as removed (log index 3) and in the next block (log
    index 4): both files in one run, in two runs, and in two runs the other way."""
    found = []
    for mode in ("together", "in_order", "late"):
        job = _Daily(spark, sf, f"reorg-{mode}")
        index = F.col("log_index")
        moved = job.raw.where(index.isin(3, 4)).withColumns(
            {"removed": (index == 3) | F.col("removed"), "block_number": F.col("block_number") + (index - 3)}
        )
        puts = [(job.raw, 1), (moved, 2)]
        for number, (rows, day) in enumerate(reversed(puts) if mode == "late" else puts):
            job.put(rows, day)
            if mode != "together" or number:
                job.run(number + 1)
        raw = daily_run.raw_table(spark, job.root, BLOCKS_PER_BUCKET).read()
        hashes = bytes_to_hex(F.col("transaction_hash")).alias("transaction_hash")
        rows = raw.select(F.lit("open_logs").alias("fact"), hashes, "log_index", "block_number")
        for name in ("fct_mint", "fct_burn", "fct_transfer"):
            fact = fact_table(spark, job.root, name, BLOCKS_PER_BUCKET).read()
            rows = rows.unionByName(
                fact.select(F.lit(name).alias("fact"), "transaction_hash", "log_index", "block_number")
            )
        found.append(rows.select(F.lit(mode).alias("mode"), "*"))
    return found[0].unionByName(found[1]).unionByName(found[2])


QUERIES = {
    "high_water_mark": high_water_mark,
    "block_extent": block_extent,
    "block_extent_footers": block_extent_footers,
    "schema_drift": schema_drift,
    "block_range_filter": block_range_filter,
    "incremental_poll": incremental_poll,
    "latest_event": latest_event,
    "range_stamped_write": range_stamped_write,
    "file_block_inventory": file_block_inventory,
    "latest_file": latest_file,
    "load_append": load_append,
    "load_replace": load_replace,
    "load_merge": load_merge,
    "load_lineage": load_lineage,
    "upsert_delete_insert": upsert_delete_insert,
    "fct_mint_incremental": fct_mint_incremental,
    "fct_mint_moved": fct_mint_moved,
    "insert_if_absent": insert_if_absent,
    "dedup_logs": dedup_logs,
    "scd2_snapshot": scd2_snapshot,
    "scd2_replay": scd2_replay,
    "daily_run": daily_run_facts,
    "daily_run_resumed": daily_run_resumed,
    "daily_run_late_file": daily_run_late_file,
    "daily_run_reorg": daily_run_reorg,
}

_LAST = "(SELECT max(event_id // 10) FROM events)"
RECORD = f"""record AS (
  SELECT CAST(event_id AS VARCHAR) AS id, block_number, 't' || event_id AS timestamp,
    contract_address, from_address, to_address, CAST(raw AS VARCHAR) AS value FROM ev)"""
_PARTS = f"""parts AS (
  SELECT 'open_logs_24010' || (p + 1) || '_' || low || '_' || high || '.parquet' AS file,
    '24010' || (p + 1) AS file_date, low AS from_block, high AS to_block, n AS row_count
  FROM (SELECT p, min(b) AS low, max(b) AS high, count(*) AS n FROM (
    SELECT b, CASE WHEN b < m // 3 THEN 0 WHEN b < 2 * m // 3 THEN 1 ELSE 2 END AS p
    FROM (SELECT event_id // 10 AS b, max(event_id // 10) OVER () AS m FROM events))
    GROUP BY p))"""
_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_MINT_RUNS = f"""SELECT transaction_hash, log_index, block_number, contract_address,
    to_address AS minting_address, {tokens_sql('raw')} AS minted_amount,
    ltrim(substr(event_data, 3), '0') AS amount_hex, false AS amount_overflow,
    CASE WHEN block_number > {_LAST} // 2 THEN 20240302 ELSE 20240301 END AS date_key,
    CASE WHEN block_number > {_LAST} // 2 THEN '{SECOND_RUN_TS}' ELSE '{RUN_TS}' END
      AS dbt_loaded_at
  FROM transfers WHERE event_type = 'click'"""



def _runs_sql(second: str) -> str:
    """Rows and total per fact and run, the second one where ``second`` holds."""
    return f"""runs AS (
          SELECT CASE event_type WHEN 'click' THEN 'fct_mint' WHEN 'purchase' THEN 'fct_burn'
              ELSE 'fct_transfer' END AS fact,
            CASE WHEN {second} THEN 20240302 ELSE 20240301 END AS date_key,
            count(*) AS row_count, CAST(sum(raw) AS HUGEINT) AS total
          FROM transfers GROUP BY 1, 2)"""


ORACLES = {
    "high_water_mark": f"""WITH {EV} SELECT max(block_number) AS max_block FROM transfers
        WHERE event_type = 'click'""",
    "block_extent": f"""WITH {EV} SELECT min(block_number) AS min_block,
        max(block_number) AS max_block, count(*) AS row_count FROM ev""",
    "block_extent_footers": f"""WITH {EV} SELECT min(block_number) AS min_block,
        max(block_number) AS max_block, count(*) AS row_count FROM ev""",
    "schema_drift": """SELECT * FROM (VALUES
          ('open_logs_2_2.parquet', 'chain', 'unexpected', NULL, 'string'),
          ('open_logs_2_2.parquet', 'topic2', 'missing', 'binary', NULL),
          ('open_logs_3_3.parquet', 'log_index', 'changed', 'bigint', 'string'))
        AS t(file, column_name, problem, expected_type, found_type)
        WHERE EXISTS (SELECT 1 FROM events)""",
    "block_range_filter": f"""WITH {EV} SELECT block_number, log_index, transaction_hash FROM ev
        WHERE block_number BETWEEN {_LAST} // 4 AND {_LAST} // 2""",
    "incremental_poll": f"""WITH {EV}, {RECORD}, newer AS (
          SELECT * FROM record WHERE block_number > {_LAST} // 2)
        SELECT * FROM newer WHERE block_number <= (SELECT max(block_number) FROM (
          SELECT block_number FROM newer ORDER BY block_number LIMIT 25))""",
    "latest_event": f"""WITH {EV}, {RECORD} SELECT * FROM record
        ORDER BY block_number DESC, id DESC LIMIT 1""",
    "range_stamped_write": f"""WITH {_PARTS} SELECT file, from_block, to_block, row_count
        FROM parts""",
    "file_block_inventory": f"""WITH {_PARTS} SELECT file, file_date, from_block, to_block
        FROM parts""",
    "latest_file": f"""WITH {_PARTS} SELECT file, file_date, from_block, to_block FROM parts
        ORDER BY file_date DESC, to_block DESC LIMIT 1""",
    "load_append": f"""SELECT {_ORDERS} FROM orders
        UNION ALL SELECT {_ORDERS} FROM orders WHERE o_orderstatus = 'O'""",
    "load_replace": f"SELECT {_ORDERS} FROM orders WHERE o_orderstatus <> 'O'",
    "load_merge": """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice
        FROM orders""",
    "load_lineage": f"""SELECT {_ORDERS}, 'load-1' AS _dlt_load_id,
        sha256('load-1:' || length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey) AS _dlt_id
        FROM orders""",
    "upsert_delete_insert": f"WITH {EV} {_MINT_RUNS}",
    "fct_mint_incremental": f"WITH {EV} {_MINT_RUNS}",
    "fct_mint_moved": f"""WITH {EV} SELECT transaction_hash, log_index,
        block_number + CASE WHEN log_index % 3 = 1 THEN {FAR} ELSE 0 END AS block_number, contract_address,
        to_address AS minting_address, {tokens_sql('raw')} AS minted_amount,
        ltrim(substr(event_data, 3), '0') AS amount_hex, false AS amount_overflow,
        CASE WHEN log_index % 3 = 1 THEN 20240302 ELSE 20240301 END AS date_key,
        CASE WHEN log_index % 3 = 1 THEN '{SECOND_RUN_TS}' ELSE '{RUN_TS}' END AS dbt_loaded_at
        FROM transfers WHERE event_type = 'click'""",
    "insert_if_absent": f"""WITH {EV}, {RECORD} SELECT id, block_number, timestamp,
        contract_address, from_address, to_address,
        CASE WHEN from_address = '{ZERO_ADDRESS}' THEN value ELSE value || '1' END AS value,
        CASE WHEN from_address = '{ZERO_ADDRESS}' THEN '{RUN_TS}' ELSE '{SECOND_RUN_TS}' END
          AS created_at FROM record""",
    "dedup_logs": f"""WITH {EV} SELECT block_number, log_index, is_removed AS removed,
        transaction_hash, topic1 FROM ev""",
    "scd2_snapshot": f"""WITH versions AS (
          SELECT c_custkey, c_name, c_mktsegment, c_acctbal, '{RUN_TS}' AS opened,
            CASE WHEN c_mktsegment = 'MACHINERY'
              OR (c_mktsegment = 'HOUSEHOLD' AND c_acctbal * 2 IS DISTINCT FROM c_acctbal)
              THEN '{SECOND_RUN_TS}' END AS closed
          FROM customer WHERE c_mktsegment <> 'BUILDING'
          UNION ALL
          SELECT c_custkey, c_name, c_mktsegment,
            CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal * 2 ELSE c_acctbal END,
            '{SECOND_RUN_TS}', NULL
          FROM customer WHERE c_mktsegment = 'BUILDING'
            OR (c_mktsegment = 'HOUSEHOLD' AND c_acctbal * 2 IS DISTINCT FROM c_acctbal))
        SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
          md5(length(CAST(c_custkey AS VARCHAR)) || '|' || c_custkey || '|' || opened) AS dbt_scd_id,
          opened AS dbt_updated_at, opened AS dbt_valid_from, closed AS dbt_valid_to
        FROM versions""",
    "scd2_replay": """WITH days AS (
          SELECT c_custkey, c_name, c_acctbal + (c_custkey + d) // 3 AS c_acctbal, d
          FROM customer, (SELECT unnest(range(5)) AS d) WHERE (c_custkey + d) % 4 <> 0),
        marked AS (
          SELECT *, CASE WHEN lag(d) OVER w = d - 1 AND lag(c_acctbal) OVER w IS NOT DISTINCT FROM c_acctbal
            THEN 0 ELSE 1 END AS begins FROM days WINDOW w AS (PARTITION BY c_custkey ORDER BY d)),
        numbered AS (
          SELECT *, sum(begins) OVER (PARTITION BY c_custkey ORDER BY d) AS version FROM marked),
        versions AS (
          SELECT c_custkey, c_name, arg_min(c_acctbal, d) AS c_acctbal, min(d) AS first, max(d) AS last
          FROM numbered GROUP BY c_custkey, c_name, version),
        stamped AS (
          SELECT *, strftime(TIMESTAMP '2024-03-01' + first * INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS opened,
            CASE WHEN last < 4 THEN strftime(TIMESTAMP '2024-03-01' + (last + 1) * INTERVAL 1 DAY,
              '%Y-%m-%d %H:%M:%S') END AS closed FROM versions)
        SELECT c_custkey, c_name, c_acctbal,
          md5(length(CAST(c_custkey AS VARCHAR)) || '|' || c_custkey || '|' || opened) AS dbt_scd_id,
          opened AS dbt_updated_at, opened AS dbt_valid_from, closed AS dbt_valid_to FROM stamped""",
    "daily_run": f"""WITH {EV}, {_runs_sql('block_number > ' + _LAST + ' // 2')}
        SELECT fact, date_key, row_count, {tokens_sql('total')} AS total,
          'no_data' AS last_status FROM runs""",
    "daily_run_resumed": f"""WITH {EV}, {_runs_sql('true')}
        SELECT fact, date_key, row_count, {tokens_sql('total')} AS total,
          'success,no_data' AS statuses FROM runs""",
    "daily_run_late_file": f"""WITH {EV}, {_runs_sql('block_number <= ' + _LAST + ' // 2')}
        SELECT fact, date_key, row_count, {tokens_sql('total')} AS total,
          'success,success' AS statuses FROM runs""",
    "daily_run_reorg": f"""WITH {EV}, rows AS (
          SELECT 'open_logs' AS fact, transaction_hash, log_index, block_number FROM ev
          UNION ALL
          SELECT CASE event_type WHEN 'click' THEN 'fct_mint' WHEN 'purchase' THEN 'fct_burn'
              ELSE 'fct_transfer' END, transaction_hash, log_index, block_number
          FROM transfers WHERE log_index <> 3)
        SELECT mode, fact, transaction_hash, log_index,
          block_number + CASE WHEN log_index = 4 THEN 1 ELSE 0 END AS block_number
        FROM rows, (SELECT unnest(['together', 'in_order', 'late']) AS mode)""",
}
