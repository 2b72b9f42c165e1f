"""Messages, the streaming sink, alerts, dead letters and bounded drains.

The message connector is not available here, so messages are lines of text
files; the code behind the source is the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import APPROVAL_TOPIC
from logtide.schemas import INDEXER_FIELDS
from logtide.session import new_run_dir
from logtide.sources import files
from logtide.sources.block_polls import BlockPolls
from logtide.streaming import messages, producer, sink
from logtide.streaming.copies import drop_recent_copies
from suite.common import EV, RUN_TS, SECOND_RUN_TS, as_text, logs, once
from suite.event_fixture import UNKNOWN_TOPIC, transfer_events
from suite.loads import RECORD

THRESHOLD_TOKENS = 1000
FIELDS = messages.FIELDS
DRAIN_FILES = 6


def _events(spark, sf):
    return transfer_events(logs(spark, sf))


def json_records(spark, sf):
    """Saved responses of the indexer, one record each, back to rows."""
    events = _events(spark, sf)
    renamed = [F.col(column).alias(name) for name, column in INDEXER_FIELDS.items()]
    body = F.struct(F.struct(F.array(F.struct(*renamed)).alias("transfers")).alias("data"))
    responses = events.select(F.to_json(F.struct(body["data"].alias("data"))).alias("value"))
    path = once(spark, sf, "responses", responses.write.text)
    return files.rename_indexer_fields(files.json_records(spark.read.text(path), "transfers"))


def encode_messages(spark, sf):
    """Keys and messages; the message is taken apart again by another parser."""
    encoded = files.encode_messages(_events(spark, sf))
    back = F.from_json("value", T.StructType([T.StructField(n, T.StringType()) for n in FIELDS]))
    return encoded.select("key", back.alias("m")).select("key", "m.*")


def produce_messages(spark, sf):
    """All events sent in polls of a fifth of them, starting from nothing."""
    base, events = new_run_dir(spark, "produced"), _events(spark, sf)

    def send(batch):
        batch.write.mode("append").json(base)

    producer.produce(events, send, limit=-(-events.count() // 5))
    sent = spark.read.schema("key string, value string").json(base)
    return sent.groupBy("key").agg(
        F.count("*").alias("times_sent"), F.md5(F.max("value")).alias("message_md5")
    )


def _sent(spark, sf) -> DataFrame:
    """All logs as messages: unknown events are cut short, approvals lack their
    value, mints of one contract are lists, burns of another have one field too
    many."""
    raw = logs(spark, sf)
    zero, contract = F.lit(bytearray(32)), F.lpad(F.hex("address"), 40, "0")
    kind = (
        F.when(F.col("topic0") == F.unhex(F.lit(UNKNOWN_TOPIC[2:])), "malformed_json")
        .when(F.col("topic0") == F.unhex(F.lit(APPROVAL_TOPIC[2:])), "missing_field")
        .when((F.col("topic1") == zero) & contract.endswith("1"), "not_an_object")
        .when((F.col("topic2") == zero) & contract.endswith("2"), "unexpected_field")
    )
    events = transfer_events(raw, kind.alias("kind"))
    value = F.col("value")
    text = (
        F.when(F.col("kind") == "malformed_json", value.substr(F.lit(1), F.length(value) - 1))
        .when(F.col("kind") == "missing_field", F.regexp_replace(value, ',"value":"[0-9]*"', ""))
        .when(F.col("kind") == "not_an_object", F.concat(F.lit("["), value, F.lit("]")))
        .when(F.col("kind") == "unexpected_field", F.regexp_replace(value, "}$", ',"chain":"x"}'))
        .otherwise(value)
    )
    body = F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})
    return events.select("kind", body.alias("value")).select(text.alias("value"))


def _drained(spark, sf, name):
    """All messages through the stream, in files of about equal size."""
    base = new_run_dir(spark, name)
    path = once(
        spark, sf, "messages", lambda p: _sent(spark, sf).repartition(DRAIN_FILES).write.text(p)
    )
    target = sink.TransferSink(spark, f"{base}/out", THRESHOLD_TOKENS, RUN_TS)
    stats = sink.drain(_stream(spark, path), target, f"{base}/checkpoint")
    return base, stats


def _stream(spark, path, files_per_batch=2):
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def stream_decode(spark, sf):
    """The decode step as a stream, without a sink table."""
    base = new_run_dir(spark, "decode")
    path = once(spark, sf, "decode_messages", lambda p: _sent(spark, sf).write.text(p))
    good = messages.good_messages(messages.decode_messages(_stream(spark, path)))
    query = (
        good.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def stream_dead_letter(spark, sf):
    base, _ = _drained(spark, sf, "dead")
    letters = spark.read.parquet(f"{base}/out/dead_letters")
    return letters.select("decode_error", F.md5("raw").alias("raw_md5"))


def stream_sink(spark, sf):
    """The sink after all messages came, and came again with other values."""
    base, _ = _drained(spark, sf, "sink")
    again = _events(spark, sf).withColumn("value", F.lit("7"))
    path = once(
        spark, sf, "messages_again",
        lambda p: files.encode_messages(again).select("value").repartition(DRAIN_FILES).write.text(p),
    )
    target = sink.TransferSink(spark, f"{base}/out", THRESHOLD_TOKENS, SECOND_RUN_TS)
    sink.drain(_stream(spark, path), target, f"{base}/checkpoint-again")
    return as_text(sink.sink_table(spark, f"{base}/out").read(), "created_at")


def stream_alerts(spark, sf):
    base, _ = _drained(spark, sf, "alerts")
    return spark.read.parquet(f"{base}/out/alerts").select(*FIELDS)


def large_transfers(spark, sf):
    return messages.large_transfers(_events(spark, sf), THRESHOLD_TOKENS)


def _stats_row(spark, stats):
    kept = {k: v for k, v in stats.items() if k not in ("duration_seconds", "failure")}
    schema = T.StructType(
        [
            T.StructField(k, T.StringType() if isinstance(v, str) else T.LongType())
            for k, v in kept.items()
        ]
    )
    return spark.createDataFrame([tuple(kept.values())], schema)


def drain_stats(spark, sf):
    _, stats = _drained(spark, sf, "stats")
    return _stats_row(spark, stats)


def stream_drain(spark, sf):
    """Bounded drains, one after the other, until nothing is left: every run
    stops after a few batches and goes on where the last one stopped."""
    base = new_run_dir(spark, "drain")
    good = files.encode_messages(_events(spark, sf)).select("value")
    good.repartition(DRAIN_FILES).write.text(f"{base}/in")
    limit = -(-good.count() // DRAIN_FILES)
    runs = []
    while not runs or runs[-1]["messages_consumed"]:
        target = sink.TransferSink(spark, f"{base}/out", THRESHOLD_TOKENS, RUN_TS)
        stream = _stream(spark, f"{base}/in", 1)
        runs.append(sink.drain(stream, target, f"{base}/checkpoint", max_messages=limit))
    total = reduce(lambda a, b: {k: a[k] + b[k] if k != "status" else b[k] for k in a}, runs)
    stored = sink.sink_table(spark, f"{base}/out").read()
    return stored.agg(
        F.count("*").alias("rows_stored"),
        F.count_distinct("id").alias("ids_stored"),
        F.lit(total["messages_consumed"]).cast("long").alias("messages_consumed"),
        F.lit(total["status"]).alias("status"),
        F.lit(len(runs) > 2).alias("took_several_runs"),
    )


class _FailsOnce(sink.TransferSink):
    """Dies in the second batch, after its alerts and dead letters were written."""

    def _write_side(self, rows, name, batch_id):
        super()._write_side(rows, name, batch_id)
        if batch_id == 1 and name == "dead_letters":
            raise RuntimeError("lost in the middle of a batch")


def stream_restart(spark, sf):
    """A drain that dies within a batch, and one that goes on from its checkpoint: all
    stored ids, alerts and dead letters."""
    base = new_run_dir(spark, "restart")
    path = once(
        spark, sf, "messages", lambda p: _sent(spark, sf).repartition(DRAIN_FILES).write.text(p)
    )
    statuses = []
    for target in (_FailsOnce, sink.TransferSink):
        stats = sink.drain(
            _stream(spark, path), target(spark, f"{base}/out", THRESHOLD_TOKENS, RUN_TS), f"{base}/checkpoint"
        )
        statuses.append("died" if "failure" in stats else "ended")
    stored = sink.sink_table(spark, f"{base}/out").read()
    alerts = spark.read.parquet(f"{base}/out/alerts")
    letters = spark.read.parquet(f"{base}/out/dead_letters")
    found = (
        stored.select(F.lit("stored").alias("what"), F.md5("id").alias("told"))
        .unionByName(alerts.select(F.lit("alert").alias("what"), F.md5("id").alias("told")))
        .unionByName(letters.select(F.lit("dead letter").alias("what"), F.md5("raw").alias("told")))
    )
    return found.withColumn("runs", F.lit(",".join(statuses)))


def _send(rows: DataFrame, folder: str) -> None:
    """Messages into files beside those sent before, compressed."""
    rows.repartition(DRAIN_FILES).write.mode("append").option("compression", "gzip").text(folder)


def stream_dedup_state(spark, sf):
    """All messages, all of them again, and again with other values after a restart:
    what is stored, and how many messages got past the state to the table. No drain
    ends before its messages do; one that fails is no result."""
    base = new_run_dir(spark, "copies")
    for sent in (_sent(spark, sf), _sent(spark, sf)):
        _send(sent, f"{base}/in")
    passed = 0
    for ts, values in ((RUN_TS, None), (SECOND_RUN_TS, "7")):
        if values:
            other = _events(spark, sf).withColumn("value", F.lit(values))
            changed = files.encode_messages(other).select("value")
            _send(changed.unionByName(_sent(spark, sf)), f"{base}/in")
        target = sink.TransferSink(spark, f"{base}/out", THRESHOLD_TOKENS, ts)
        told = drop_recent_copies(_stream(spark, f"{base}/in", 6))
        stats = sink.drain(told, target, f"{base}/checkpoint", max_seconds=None)
        if "failure" in stats:
            raise RuntimeError(stats["failure"])
        passed += stats["rows_attempted"] + stats["total_errors"]
    stored = sink.sink_table(spark, f"{base}/out").read()
    letters = spark.read.parquet(f"{base}/out/dead_letters")
    return stored.groupBy("created_at").agg(
        F.count("*").alias("rows_stored"), F.count_distinct("id").alias("ids_stored"),
        F.sum(F.col("value").cast("decimal(38,0)")).cast("string").alias("total"),
    ).select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "rows_stored",
        "ids_stored", "total", F.lit(passed).cast("long").alias("messages_passed"),
        F.lit(letters.count()).cast("long").alias("dead_letters"),
    )


def stream_poll(spark, sf):
    """Events polled from overlapping stamped files, by a stream that is restarted
    when more files have come; ``poll`` is the run that brought an event."""
    spark.dataSource.register(BlockPolls)
    base, events = new_run_dir(spark, "polls"), _events(spark, sf)
    last = events.agg(F.max("block_number")).first()[0]
    # Each part starts before the one before it ended, the third within the second.
    parts = [(0, last // 2), (last // 3, 2 * last // 3), (last // 2, 3 * last // 5), (3 * last // 5, last)]
    for run, cuts in enumerate((parts[:3], parts[3:])):
        for low, high in cuts:
            files.range_stamped_write(files.block_range(events, low, high), f"{base}/files", "transfers")
        polled = (
            spark.readStream.format("block_polls").schema(events.schema)
            .option("prefix", "transfers").option("from_block", last // 10).load(f"{base}/files")
        )

        def keep(rows, batch_id, run=run):
            rows.withColumn("poll", F.lit(run)).write.mode("overwrite").parquet(f"{base}/out/batch_{batch_id}")

        query = polled.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint")
        query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out/batch_*")


QUERIES = {
    "json_records": json_records,
    "encode_messages": encode_messages,
    "produce_messages": produce_messages,
    "stream_decode": stream_decode,
    "stream_dead_letter": stream_dead_letter,
    "stream_sink": stream_sink,
    "stream_alerts": stream_alerts,
    "large_transfers": large_transfers,
    "drain_stats": drain_stats,
    "stream_drain": stream_drain,
    "stream_restart": stream_restart,
    "stream_dedup_state": stream_dedup_state,
    "stream_poll": stream_poll,
}

_LIMIT = f"{THRESHOLD_TOKENS}000000000000000000"
_COLUMNS = "id, block_number, timestamp, contract_address, from_address, to_address, value"
_SENT = f"""{EV}, {RECORD}, sent AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'malformed_json'
      WHEN event_type = 'signup' THEN 'missing_field'
      WHEN event_type = 'click' AND user_id % 3 = 0 THEN 'not_an_object'
      WHEN event_type = 'purchase' AND user_id % 3 = 1 THEN 'unexpected_field' END AS problem
  FROM (SELECT event_id, event_type, user_id, raw FROM ev) e JOIN record ON id = CAST(event_id AS VARCHAR))"""
_JSON = """'{"id":"' || id || '","block_number":' || block_number || ',"timestamp":"' || timestamp
  || '","contract_address":"' || contract_address || '","from_address":"' || from_address
  || '","to_address":"' || to_address || '"'"""

_LETTERS = f"""texts AS (
  SELECT problem, {_JSON} AS head, ',"value":"' || value || '"' AS tail
  FROM sent WHERE problem IS NOT NULL),
letters AS (
  SELECT problem AS decode_error, md5(CASE problem
    WHEN 'malformed_json' THEN head || tail
    WHEN 'missing_field' THEN head || '}}'
    WHEN 'not_an_object' THEN '[' || head || tail || '}}]'
    ELSE head || tail || ',"chain":"x"}}' END) AS raw_md5 FROM texts)"""

ORACLES = {
    "json_records": f"WITH {EV}, {RECORD} SELECT * FROM record",
    "encode_messages": f"""WITH {EV}, {RECORD} SELECT id AS key, id,
        CAST(block_number AS VARCHAR) AS block_number, timestamp, contract_address, from_address,
        to_address, value FROM record""",
    "produce_messages": f"""WITH {_SENT} SELECT id AS key, CAST(1 AS BIGINT) AS times_sent,
        md5({_JSON} || ',"value":"' || value || '"}}') AS message_md5 FROM sent""",
    "stream_decode": f"WITH {_SENT} SELECT {_COLUMNS} FROM sent WHERE problem IS NULL",
    "stream_dead_letter": f"WITH {_SENT}, {_LETTERS} SELECT decode_error, raw_md5 FROM letters",
    "stream_restart": f"""WITH {_SENT}, {_LETTERS}, told AS (
          SELECT 'stored' AS what, md5(id) AS told FROM sent WHERE problem IS NULL
          UNION ALL SELECT 'alert', md5(id) FROM sent WHERE problem IS NULL AND raw >= {_LIMIT}
          UNION ALL SELECT 'dead letter', raw_md5 FROM letters)
        SELECT what, told, 'died,ended' AS runs FROM told""",
    "stream_dedup_state": f"""WITH {_SENT}, {_LETTERS}, held AS (
          SELECT id, CASE WHEN problem IS NULL THEN '{RUN_TS}' ELSE '{SECOND_RUN_TS}' END AS created_at,
            CASE WHEN problem IS NULL THEN raw ELSE 7 END AS amount FROM sent)
        SELECT created_at, count(*) AS rows_stored, count(DISTINCT id) AS ids_stored,
          CAST(CAST(sum(amount) AS HUGEINT) AS VARCHAR) AS total,
          (SELECT count(*) FROM sent) * 2 AS messages_passed,
          (SELECT count(*) FROM letters) AS dead_letters
        FROM held GROUP BY created_at""",
    "stream_poll": f"""WITH {EV}, {RECORD}, top AS (SELECT max(block_number) AS m FROM record)
        SELECT record.*, CAST(block_number > 2 * m // 3 AS INTEGER) AS poll
        FROM record, top WHERE block_number >= m // 10""",
    "stream_sink": f"""WITH {_SENT} SELECT id, block_number, timestamp, contract_address,
        from_address, to_address, CASE WHEN problem IS NULL THEN value ELSE '7' END AS value,
        CASE WHEN problem IS NULL THEN '{RUN_TS}' ELSE '{SECOND_RUN_TS}' END AS created_at
        FROM sent""",
    "stream_alerts": f"""WITH {_SENT} SELECT {_COLUMNS} FROM sent
        WHERE problem IS NULL AND raw >= {_LIMIT}""",
    "large_transfers": f"""WITH {EV}, {RECORD} SELECT {_COLUMNS} FROM record
        WHERE CAST(value AS HUGEINT) >= {_LIMIT}""",
    "drain_stats": f"""WITH {_SENT} SELECT
          count(*) FILTER (problem IS NULL OR problem <> 'malformed_json') AS messages_consumed,
          count(*) FILTER (problem IS NULL) AS rows_attempted,
          count(*) FILTER (problem IS NULL) AS rows_inserted,
          CAST({DRAIN_FILES // 2} AS BIGINT) AS batches_processed,
          count(*) FILTER (problem IS NOT NULL) AS total_errors,
          'partial' AS status FROM sent""",
    "stream_drain": """SELECT count(*) AS rows_stored, count(*) AS ids_stored,
          count(*) AS messages_consumed, 'success' AS status, true AS took_several_runs
        FROM events""",
}
