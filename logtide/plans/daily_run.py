"""The daily job: new files -> raw logs -> facts and dimension -> checks.

The job keeps a log of what is done, a Parquet folder that each step appends to when it
ends: the files in the raw table, and the block ranges that facts and checks have taken
up. Every step can be repeated, so a run after a failure goes on with what is
outstanding, whether or not there is a new file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.operators.dedup import LOG_KEY, dedup_logs, newest_first
from logtide.operators.joins import fits_broadcast
from logtide.plans.checks import quality_suite
from logtide.plans.incremental import (
    BLOCKS_PER_BUCKET,
    fact_table,
    replace_blocks,
)
from logtide.plans.marts import DIM_EVENT_SCHEMA, FACTS, dim_event
from logtide.plans.transfers import int_all_transfer
from logtide.schemas import RAW_LOGS, STORED_LOGS
from logtide.session import new_run_dir
from logtide.sources import storage
from logtide.sources.files import file_inventory, scan_logs
from logtide.sources.loads import with_load_lineage
from logtide.sources.storage import layer_path
from logtide.sources.tables import KeyedTable, block_buckets, hash_buckets

Range = tuple[int, int]
JOB_LOG = "what string, extent string, file string, from_block long, to_block long"
STEPS = ("facts", "checks")


class JobLog:
    """What the job has done below ``root``: one row per loaded file, per block range
    that files brought, and per step that took a range up."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/job"

    def read(self) -> DataFrame:
        if not storage.exists(self.spark, self.folder):
            return self.spark.createDataFrame([], JOB_LOG)
        return self.spark.read.schema(JOB_LOG).parquet(self.folder)

    def _add(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, JOB_LOG).coalesce(1).write.mode("append").parquet(self.folder)

    def loaded(self, files: list[str], blocks: Range) -> None:
        """Files are in the raw table; their range is outstanding for every step."""
        extent = uuid.uuid4().hex
        self._add([("file", extent, f, *blocks) for f in files] + [(s, extent, None, *blocks) for s in STEPS])

    def done(self, step: str, extents: Iterable[str]) -> None:
        self._add([(f"{step} done", extent, None, None, None) for extent in extents])

    def new_files(self, found: DataFrame) -> DataFrame:
        """Files of an inventory that are not in the raw table."""
        return found.join(self.read().where("what = 'file'").select("file"), "file", "left_anti")

    def outstanding(self, step: str) -> dict[str, Range]:
        """Ranges that a step has yet to take up, by their extent."""
        log = self.read()
        done = log.where(F.col("what") == f"{step} done").select("extent")
        rows = log.where(F.col("what") == step).join(done, "extent", "left_anti").collect()
        return {r.extent: (r.from_block, r.to_block) for r in rows}


def raw_table(
    spark: SparkSession, root: str, blocks_per_bucket: int = BLOCKS_PER_BUCKET
) -> KeyedTable:
    bucket = block_buckets(blocks_per_bucket)
    return KeyedTable(
        spark,
        layer_path(root, "open_logs", "raw"),
        STORED_LOGS,
        LOG_KEY,
        bucket,
        ["block_number", "log_index"],
    )


def dimension_table(spark: SparkSession, root: str) -> KeyedTable:
    """The event dimension, replaced whole."""
    path = layer_path(root, "dim_event", "mart")
    return KeyedTable(spark, path, DIM_EVENT_SCHEMA, ["topic0_hash"], hash_buckets(["topic0_hash"], 1))


def load_new_files(raw: KeyedTable, folder: str, prefix: str, log: JobLog) -> int:
    """Merge every stamped file that is not in the log; the rows written.

    A log may come in several files, also with another block or flag after a
    reorganisation. The copy of the newest file stays, in whatever order files are
    loaded and however far apart its blocks are.
    """
    found = log.new_files(file_inventory(raw.spark, folder, prefix)).collect()
    new = {r.file: (r.from_block, r.to_block) for r in found}
    written = 0
    for extent in merged_ranges(list(new.values())):
        files = sorted(f for f, (a, b) in new.items() if extent[0] <= a and b <= extent[1])
        written += _load_files(raw, folder, files)
        log.loaded(files, extent)
    return written


def _load_files(raw: KeyedTable, folder: str, files: list[str]) -> int:
    # A stamped name may be a file or a folder of part files; it names the load.
    name = F.regexp_extract("_metadata.file_path", r"/([^/]+_\d+_\d+\.parquet)(?:/|$)", 1)
    logs = scan_logs(raw.spark, *[f"{folder}/{file}" for file in files])
    logs = logs.select(*RAW_LOGS.fieldNames(), name.alias("from_file"))
    batch = with_load_lineage(logs, F.col("from_file"), LOG_KEY).select(*STORED_LOGS.fieldNames())

    def newest(new: DataFrame, old: DataFrame) -> DataFrame:
        return dedup_logs(new.unionByName(old), newest_first())

    return raw.merge(_one_each(batch), newest)


def _one_each(batch: DataFrame) -> DataFrame:
    """The newest copy of every log. Where few keys come again, only their rows are
    dealt out by key; the others stay where the files have them."""
    key = F.xxhash64(*LOG_KEY)
    again = batch.groupBy(key.alias("key_hash")).count().where("count > 1").select("key_hash")
    if not fits_broadcast(again):
        return dedup_logs(batch, newest_first())
    hashed = batch.withColumn("key_hash", key)
    copies = hashed.join(F.broadcast(again), "key_hash", "left_semi").select(*batch.columns)
    single = hashed.join(F.broadcast(again), "key_hash", "left_anti").select(*batch.columns)
    return single.unionByName(dedup_logs(copies, newest_first()))


def merged_ranges(ranges: list[Range], before: int = 0) -> list[Range]:
    """Block ranges joined where they meet, each begun ``before`` blocks earlier."""
    out: list[Range] = []
    for first, last in sorted((a - before, b) for a, b in ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _logs_of(table: KeyedTable, blocks: Range, blocks_per_bucket: int) -> DataFrame:
    found = table.read(
        from_bucket=blocks[0] // blocks_per_bucket, to_bucket=blocks[1] // blocks_per_bucket
    )
    return found.where(F.col("block_number").between(*blocks))


@contextmanager
def decoded_transfers(logs: DataFrame, signatures: DataFrame) -> Iterator[DataFrame]:
    """Transfers of the logs, decoded once for facts and checks.

    They are written to the shared folder, so that a lost executor costs no second
    decode; the copy goes when the block ends.
    """
    path = new_run_dir(logs.sparkSession, "transfers")
    int_all_transfer(logs, signatures).write.parquet(path)
    try:
        yield logs.sparkSession.read.parquet(path)
    finally:
        storage.delete(logs.sparkSession, path)


def refresh_facts(
    spark: SparkSession,
    logs: DataFrame,
    transfers: DataFrame,
    root: str,
    run_ts: datetime | str,
    blocks_per_bucket: int = BLOCKS_PER_BUCKET,
) -> dict[str, int]:
    """Make the facts agree with the raw logs of a block range; rows inserted.

    Only buckets that may hold one of the logs are opened.
    """
    # The facts do not depend on each other; side by side they fill the cluster.
    with ThreadPoolExecutor(len(FACTS)) as pool:
        jobs = {
            name: pool.submit(
                inheritable_thread_target(spark)(replace_blocks),
                fact_table(spark, root, name, blocks_per_bucket), name, transfers, logs, run_ts,
            )
            for name in FACTS
        }
        return {name: job.result() for name, job in jobs.items()}


def check_blocks(
    raw: KeyedTable,
    signatures: DataFrame,
    transfers: DataFrame,
    root: str,
    blocks: Range,
    blocks_per_bucket: int = BLOCKS_PER_BUCKET,
) -> DataFrame:
    """Report of every declared check over a block range."""
    facts = {
        name: _logs_of(fact_table(raw.spark, root, name, blocks_per_bucket), blocks, blocks_per_bucket)
        for name in FACTS
    }
    return quality_suite(_logs_of(raw, blocks, blocks_per_bucket), signatures, facts, transfers)


def check_everything(
    spark: SparkSession, signatures: DataFrame, root: str, blocks_per_bucket: int = BLOCKS_PER_BUCKET
) -> DataFrame:
    """Report of every declared check over whole tables, by request."""
    raw = raw_table(spark, root, blocks_per_bucket).read()
    stored = {name: fact_table(spark, root, name, blocks_per_bucket).read() for name in FACTS}
    return quality_suite(raw, signatures, stored)


def run(
    spark: SparkSession,
    folder: str,
    prefix: str,
    signatures: DataFrame,
    root: str,
    run_ts: datetime | str,
    blocks_per_bucket: int = BLOCKS_PER_BUCKET,
    lookback_blocks: int = 0,
) -> dict:
    """One run of the whole job; any failing step stops it, the next run goes on.

    ``status`` is ``no_data`` when there is no new file and nothing outstanding,
    else ``success``, or ``failed_checks`` when a check found rows in the blocks
    not yet passed; those stay outstanding. Facts and checks cost the blocks of
    the new files; ``lookback_blocks`` takes in that many more before them.
    """
    raw = raw_table(spark, root, blocks_per_bucket)
    log = JobLog(spark, root)
    loaded = load_new_files(raw, folder, prefix, log)
    facts = {name: 0 for name in FACTS}
    pending, unchecked = (log.outstanding(step) for step in STEPS)
    if not unchecked:
        return {"status": "no_data", "loaded": 0, "facts": facts}
    if pending or not dimension_table(spark, root).exists():
        dimension_table(spark, root).replace(dim_event(signatures))
    failed = []
    for blocks in merged_ranges(list(unchecked.values()), lookback_blocks):
        met, met_facts = ([x for x, r in step.items() if _meets(blocks, r)] for step in (unchecked, pending))
        logs = _logs_of(raw, blocks, blocks_per_bucket)
        with decoded_transfers(logs, signatures) as transfers:
            if met_facts:
                inserted = refresh_facts(spark, logs, transfers, root, run_ts, blocks_per_bucket)
                facts = {name: facts[name] + inserted[name] for name in FACTS}
                log.done("facts", met_facts)
            report = check_blocks(raw, signatures, transfers, root, blocks, blocks_per_bucket)
            found = [row.asDict() for row in report.where(F.col("failed_rows") > 0).collect()]
        failed += found
        if not found:
            log.done("checks", met)
    return {
        "status": "failed_checks" if failed else "success",
        "loaded": loaded,
        "facts": facts,
        "failed_checks": failed,
    }


def _meets(a: Range, b: Range) -> bool:
    return a[0] <= b[1] and b[0] <= a[1]
