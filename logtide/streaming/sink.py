"""Write streamed transfers once, with alerts, dead letters and statistics."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtide.constants import ALERT_THRESHOLD_TOKENS, DRAIN_SECONDS
from logtide.functions.columns import run_timestamp
from logtide.operators.dedup import first_by_key
from logtide.schemas import TRANSFER_SINK
from logtide.sources.tables import KeyedTable, block_buckets
from logtide.streaming.messages import (
    ERROR,
    FIELDS,
    dead_letters,
    decode_messages,
    good_messages,
    is_large,
    large_transfers,
)

SINK_BLOCKS_PER_BUCKET = 10_000
COMPACT_EVERY = 200
COUNTED = ("consumed", "attempted", "inserted", "errors", "batches")


def sink_table(spark: SparkSession, root: str) -> KeyedTable:
    bucket = block_buckets(SINK_BLOCKS_PER_BUCKET)
    return KeyedTable(spark, f"{root}/transfers", TRANSFER_SINK, ["id"], bucket, ["block_number"])


class DrainLimit(Exception):
    """A bounded drain has had enough."""


@dataclass
class TransferSink:
    """Handles one micro-batch: the first message of an id wins, for good.

    Replaying a batch changes nothing: known ids are skipped, and alerts and dead
    letters go to a folder named after the batch. Ids are looked up in the places of
    the table's keys, so its rows are read only where an id of the batch may stand. The
    small files of many batches are merged every ``compact_every`` batches.
    """

    spark: SparkSession
    root: str
    threshold: int = ALERT_THRESHOLD_TOKENS
    run_ts: datetime | str | None = None
    order: tuple[str, ...] = ("partition", "offset")
    compact_every: int = COMPACT_EVERY
    totals: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTED, 0))
    enough: Callable[[], bool] | None = None
    stopped: bool = False

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        if self.enough is not None and self.enough():
            # Ends the query before this batch did anything, so that it comes
            # again, whole, in the next run.
            self.stopped = True
            raise DrainLimit(f"limit reached before batch {batch_id}")
        decoded = decode_messages(messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            is_good = F.col(ERROR).isNull()
            consumed, malformed, rejected, large = decoded.agg(
                F.count_if(is_good | (F.col(ERROR) != "malformed_json")),
                F.count_if(F.col(ERROR) == "malformed_json"),
                F.count_if(F.col(ERROR) != "malformed_json"),
                F.count_if(is_good & is_large(F.col("value"), self.threshold)),
            ).first()
            good = good_messages(decoded)
            if malformed + rejected:
                self._write_side(dead_letters(decoded), "dead_letters", batch_id)
            if large:
                alerts = large_transfers(good, self.threshold).select(*FIELDS)
                self._write_side(alerts, "alerts", batch_id)
            table = sink_table(self.spark, self.root)
            inserted = insert_first(table, good, self.order, self.run_ts)
        finally:
            decoded.unpersist()
        attempted, errors = consumed - rejected, malformed + rejected
        for name, count in zip(COUNTED, (consumed, attempted, inserted, errors, 1)):
            self.totals[name] += count
        if (batch_id + 1) % self.compact_every == 0:
            table.compact()

    def _write_side(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")


def insert_first(
    table: KeyedTable,
    transfers: DataFrame,
    order: tuple[str, ...] = (),
    run_ts: datetime | str | None = None,
) -> int:
    """Insert transfers whose id is new, the first of equal ids; the rows inserted."""
    known_order = [c for c in order if c in transfers.columns]
    first = first_by_key(transfers, ["id"], known_order).select(*FIELDS)
    return table.insert_absent(first.withColumn("created_at", run_timestamp(run_ts)))


def start(
    messages: DataFrame, sink: TransferSink, checkpoint: str, interval: str | None = None,
    max_messages: int | None = None,
) -> StreamingQuery:
    """Run the sink continuously, or over what is there when no interval is given.

    After ``max_messages`` the query ends before its next batch.
    """
    if max_messages is not None:
        sink.enough = lambda: sink.totals["consumed"] >= max_messages
    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def drain(
    messages: DataFrame,
    sink: TransferSink,
    checkpoint: str,
    max_messages: int | None = None,
    max_seconds: float | None = DRAIN_SECONDS,
    grace_seconds: float = DRAIN_SECONDS,
) -> dict:
    """Consume what is there, up to a number of messages or a time, and report.

    The source's own batch limit sets the step: the limits are looked at before
    each batch. One that has started may take ``grace_seconds`` over the time;
    then it is stopped, and comes again, whole, in the next run with the same
    checkpoint, like everything that is left. ``max_seconds`` of None is no limit.
    """
    began = time.monotonic()

    def enough() -> bool:
        late = max_seconds is not None and time.monotonic() - began >= max_seconds
        return late or (max_messages is not None and sink.totals["consumed"] >= max_messages)

    sink.totals = dict.fromkeys(COUNTED, 0)
    sink.enough, sink.stopped = enough, False
    failure = None
    try:
        query = start(messages, sink, checkpoint)
        if max_seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(max_seconds + grace_seconds):
            sink.stopped = True
            query.stop()
    except StreamingQueryException as error:
        failure = None if sink.stopped else str(error)
    return drain_stats(sink.totals, time.monotonic() - began, failure)


def drain_stats(totals: dict[str, int], seconds: float = 0.0, failure: str | None = None) -> dict:
    """The report of a drain; ``partial`` when some messages were bad."""
    errors = totals["errors"] + (1 if failure else 0)
    if not errors:
        status = "success"
    else:
        status = "partial" if totals["consumed"] else "error"
    stats = {
        "messages_consumed": totals["consumed"],
        "rows_attempted": totals["attempted"],
        "rows_inserted": totals["inserted"],
        "batches_processed": totals["batches"],
        "duration_seconds": round(seconds, 2),
        "total_errors": errors,
        "status": status,
    }
    if failure:
        stats["failure"] = failure
    return stats
