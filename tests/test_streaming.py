import datetime
import itertools
import json
import time
import types
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logtide.operators import joins
from logtide.plans import daily_run
from logtide.plans.transfers import int_all_transfer
from logtide.plans.incremental import fact_table, replace_blocks
from logtide.session import build_session, new_run_dir, shared_dir
from logtide.sources import files
from logtide.streaming import messages, producer, sink
from suite import streams
from tests.helpers import ZERO, log, logs, signatures, tuples

RUN = "2024-03-01 12:00:00"


def event(number=1, **changes):
    fields = {
        "id": f"e{number}", "block_number": number, "timestamp": "t", "contract_address": "c",
        "from_address": "f", "to_address": "g", "value": "5",
    }
    fields.update(changes)
    return fields


def text(number=1, **changes):
    return json.dumps({k: v for k, v in event(number, **changes).items() if v != "drop"})


BAD = {
    text() + " x": "malformed_json",
    text() + text(2): "malformed_json",
    text() + "," + text(2): "malformed_json",
    text()[:-1]: "malformed_json",
    text().replace('"', "'"): "malformed_json",
    "": "malformed_json",
    "[1]": "not_an_object",
    "null": "not_an_object",
    "12": "not_an_object",
    text(value="drop"): "missing_field",
    text(extra=1): "unexpected_field",
    text()[:-1] + ',"value":"6"}': "unexpected_field",
    text(value=None): "null_value",
    text(block_number="abc"): "bad_block_number",
}


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode_reasons(spark):
    decoded = messages.decode_messages(frame(spark, list(BAD)))
    assert {r.raw: r.decode_error for r in decoded.collect()} == BAD
    assert messages.good_messages(decoded).count() == 0
    assert messages.dead_letters(decoded).count() == len(BAD)


def test_decode_good_messages(spark):
    decoded = messages.decode_messages(frame(spark, [text(3), " " + text(4, value="007") + "\n"]))
    good = messages.good_messages(decoded)
    assert tuples(good.select("id", "block_number", "value")) == [("e3", 3, "5"), ("e4", 4, "007")]


def test_large_values(spark):
    e18 = 10**18
    values = [str(100 * e18), str(100 * e18 - 1), "9" * 60, "0" * 50 + "5", "x", "-5", "", "1e30", None]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    assert {r.value for r in messages.large_transfers(rows, 100).collect()} == {str(100 * e18), "9" * 60}


def test_first_message_of_an_id_wins(spark, run_dir):
    table = sink.sink_table(spark, run_dir)
    rows = [("a", 5, "late"), ("a", 2, "first"), ("b", 9, "only")]
    batch = spark.createDataFrame(
        [(i, 1, "t", "c", "f", "g", v, 0, o) for i, o, v in rows],
        "id string, block_number long, timestamp string, contract_address string, "
        "from_address string, to_address string, value string, partition int, offset long",
    )
    assert sink.insert_first(table, batch, ("partition", "offset"), RUN) == 2
    assert sink.insert_first(table, batch.where("value = 'late'"), ("partition", "offset"), RUN) == 0
    assert tuples(table.read().select("id", "value")) == [("a", "first"), ("b", "only")]


@pytest.fixture
def stream(spark, run_dir):
    def write(*texts):
        frame(spark, texts).coalesce(1).write.mode("append").text(f"{run_dir}/in")

    def drain(**limits):
        target = sink.TransferSink(spark, f"{run_dir}/out", 100, RUN)
        source = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{run_dir}/in")
        return sink.drain(source, target, f"{run_dir}/checkpoint", **limits)

    def stored():
        return sink.sink_table(spark, f"{run_dir}/out").read()

    return write, drain, stored, f"{run_dir}/out"


def test_stream_with_bad_messages_alerts_and_restart(spark, stream):
    write, drain, stored, out = stream
    write(text(1), text(2, value=str(10**21)), *BAD)
    stats = drain()
    malformed = sum(reason == "malformed_json" for reason in BAD.values())
    assert stats["messages_consumed"] == 2 + len(BAD) - malformed
    assert stats["rows_attempted"] == stats["rows_inserted"] == 2
    assert stats["total_errors"] == len(BAD) and stats["status"] == "partial"
    assert spark.read.parquet(f"{out}/dead_letters").count() == len(BAD)
    assert [r.id for r in spark.read.parquet(f"{out}/alerts").collect()] == ["e2"]

    assert drain()["messages_consumed"] == 0
    write(text(1, value="999"), text(3))
    stats = drain()
    assert (stats["rows_attempted"], stats["rows_inserted"], stats["status"]) == (2, 1, "success")
    assert tuples(stored().select("id", "value")) == [("e1", "5"), ("e2", str(10**21)), ("e3", "5")]


def test_replayed_batch_changes_nothing(spark, run_dir):
    target = sink.TransferSink(spark, run_dir, 100, RUN)
    batch = frame(spark, [text(1), text(2, value=str(10**21)), "{"])
    target(batch, 0)
    assert target.totals["inserted"] == 2
    target(batch, 0)
    assert target.totals["inserted"] == 2 and target.totals["attempted"] == 4
    assert sink.sink_table(spark, run_dir).read().count() == 2
    assert spark.read.parquet(f"{run_dir}/alerts").count() == 1
    assert spark.read.parquet(f"{run_dir}/dead_letters").count() == 1


def test_small_files_are_merged_along_the_way(spark, run_dir):
    target = sink.TransferSink(spark, run_dir, 100, RUN, compact_every=3)
    for number in range(3):
        target(frame(spark, [text(number), text(0, value="9")]), number)
    table = sink.sink_table(spark, run_dir)
    assert [sum(n.endswith(".parquet") for n in table._files(b)) for b in table.buckets()] == [1]
    assert tuples(table.read().select("id", "value")) == [("e0", "5"), ("e1", "5"), ("e2", "5")]


def test_bounded_drain_goes_on_later(spark, stream):
    write, drain, stored, _ = stream
    for part in range(3):
        write(*[text(10 * part + i) for i in range(4)])
    first = drain(max_messages=5)
    assert (first["messages_consumed"], first["batches_processed"]) == (8, 2)
    assert drain(max_seconds=0)["messages_consumed"] == 0
    assert drain(max_messages=5)["messages_consumed"] == 4
    assert stored().count() == 12


def test_a_batch_that_overruns_is_stopped_and_comes_again(spark, stream, monkeypatch):
    write, drain, stored, _ = stream
    write(text(1), text(2))
    plain = sink.insert_first

    def wait(batches):
        time.sleep(40)
        yield from batches

    def slow(*args):
        spark.range(1).mapInPandas(wait, "id long").count()
        return plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(sink, "insert_first", slow)
        began = time.monotonic()
        stats = drain(max_seconds=2, grace_seconds=2)
        assert time.monotonic() - began < 30
    assert stats["rows_inserted"] == 0 and stored().count() == 0
    assert drain()["rows_inserted"] == 2 and stored().count() == 2


def test_only_bad_messages_is_an_error(stream):
    write, drain, _, _ = stream
    write("{", "}")
    assert drain()["status"] == "error"


def test_failures_are_reported(spark, stream, monkeypatch):
    write, drain, _, _ = stream
    write(text(1))
    monkeypatch.setattr(sink, "insert_first", lambda *a: 1 / 0)
    stats = drain()
    assert stats["status"] == "error" and "ZeroDivisionError" in stats["failure"]


def event_rows(spark, run_dir, number=40):
    kinds = ["click", "purchase", "view", "signup", "error"]
    rows = [(i, kinds[i % 5], i % 7, i + 0.5) for i in range(number)]
    found = spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double")
    found.write.parquet(f"{run_dir}/events.parquet")


def test_a_failed_drain_is_no_result_of_the_dedup_query(spark, run_dir, monkeypatch):
    event_rows(spark, run_dir)
    plain = sink.insert_first

    def insert(table, transfers, order, run_ts):
        return 1 / 0 if run_ts == streams.SECOND_RUN_TS else plain(table, transfers, order, run_ts)

    monkeypatch.setattr(sink, "insert_first", insert)
    with pytest.raises(RuntimeError, match="ZeroDivisionError"):
        streams.stream_dedup_state(spark, run_dir)


def test_the_dedup_query_drains_all_however_long_it_takes(spark, run_dir, monkeypatch):
    event_rows(spark, run_dir)
    hours = itertools.count(step=3600)
    monkeypatch.setattr(sink, "time", types.SimpleNamespace(monotonic=lambda: next(hours)))
    found = streams.stream_dedup_state(spark, run_dir).collect()
    assert sum(r.rows_stored for r in found) == 40 and len(found) == 2
    assert {r.messages_passed for r in found} == {80}


def test_producer_goes_on_where_it_stopped(spark):
    rows = [(f"e{b}{i}", b) for b in (1, 2, 5) for i in range(3)]
    events = spark.createDataFrame(rows, "id string, block_number long")
    sent = []

    def send(batch):
        sent.append([r.key for r in batch.collect()])

    assert producer.produce(events, send, limit=2, polls=1) == 1
    assert producer.produce(events, send, last_block=1, limit=4) == 5
    assert [len(s) for s in sent] == [3, 6]
    assert producer.produce(events, send, last_block=5) == 5 and len(sent) == 2


def test_daily_run(spark, run_dir):
    folder, root = f"{run_dir}/files", f"{run_dir}/tables"

    def run(day):
        return daily_run.run(
            spark, folder, "open_logs", signatures(spark), root, f"2024-03-0{day} 00:00:00", 10
        )

    assert run(1)["status"] == "no_data"
    first = [log(0, block=b, sender=ZERO) for b in range(1, 15)] + [log(1, block=3, receiver=ZERO)]
    files.range_stamped_write(logs(spark, first), folder, "open_logs")
    assert run(2) == {
        "status": "success", "loaded": 15, "failed_checks": [],
        "facts": {"fct_mint": 14, "fct_burn": 1, "fct_transfer": 0},
    }
    assert run(3)["status"] == "no_data"
    overlap = [log(0, block=b, sender=ZERO) for b in range(12, 20)] + [log(1, block=16)]
    files.range_stamped_write(logs(spark, overlap + overlap[:2]), folder, "open_logs")
    last = run(4)
    assert last["loaded"] == 9
    assert last["facts"] == {"fct_mint": 5, "fct_burn": 0, "fct_transfer": 1}
    assert daily_run.raw_table(spark, root, 10).read().count() == 15 + 6


def daily(spark, run_dir, day=1, **options):
    folder, root = f"{run_dir}/files", f"{run_dir}/tables"
    run_ts = f"2024-03-{day:02d} 00:00:00"
    return daily_run.run(spark, folder, "open_logs", signatures(spark), root, run_ts, 10, **options)


def put(spark, run_dir, rows, day=None):
    stamp = None if day is None else datetime.date(2024, 3, day)
    files.range_stamped_write(logs(spark, rows), f"{run_dir}/files", "open_logs", stamp)


def blocks_of(spark, run_dir, name="fct_mint"):
    fact = fact_table(spark, f"{run_dir}/tables", name, 10).read()
    return sorted((r.block_number, r.date_key) for r in fact.collect())


def test_a_failed_run_is_finished_by_the_next(spark, run_dir, monkeypatch):
    put(spark, run_dir, [log(0, block=b, sender=ZERO) for b in (1, 2)])

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "replace_blocks", broken)
        with pytest.raises(RuntimeError):
            daily(spark, run_dir)
    assert blocks_of(spark, run_dir) == []
    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "check_blocks", broken)
        with pytest.raises(RuntimeError):
            daily(spark, run_dir, 2)
    again = daily(spark, run_dir, 3)
    assert again["status"] == "success" and again["loaded"] == 0
    assert blocks_of(spark, run_dir) == [(1, 20240302), (2, 20240302)]
    assert daily(spark, run_dir, 4)["status"] == "no_data"


def test_late_files_and_lookback(spark, run_dir):
    put(spark, run_dir, [log(0, block=25, sender=ZERO)], 2)
    daily(spark, run_dir, 1)
    put(spark, run_dir, [log(0, block=b, sender=ZERO) for b in (3, 4)], 1)
    assert daily(spark, run_dir, 2)["facts"]["fct_mint"] == 2
    assert blocks_of(spark, run_dir) == [(3, 20240302), (4, 20240302), (25, 20240301)]
    # A row that went missing from a fact comes back with the blocks around it.
    fact = fact_table(spark, f"{run_dir}/tables", "fct_mint", 10)
    fact.replace(fact.read().where("block_number <> 4"))
    put(spark, run_dir, [log(0, block=6, sender=ZERO)], 3)
    daily(spark, run_dir, 3, lookback_blocks=5)
    assert [b for b, _ in blocks_of(spark, run_dir)] == [3, 4, 6, 25]


@pytest.mark.parametrize("together", [True, False])
@pytest.mark.parametrize("late", [True, False])
def test_newest_file_wins_however_files_are_loaded(spark, run_dir, together, late):
    first = [log(0, block=9, tx=1, sender=ZERO), log(0, block=8, tx=2, sender=ZERO), log(0, block=5, tx=3, sender=ZERO)]
    second = [log(0, block=10, tx=1, sender=ZERO), log(0, block=8, tx=2, sender=ZERO, removed=True)]
    puts = [(first, 1), (second, 2)]
    for number, (rows, day) in enumerate(reversed(puts) if late else puts):
        put(spark, run_dir, rows, day)
        if number or not together:
            assert daily(spark, run_dir, number + 1)["status"] == "success"
    raw = daily_run.raw_table(spark, f"{run_dir}/tables", 10).read().collect()
    assert sorted((r.block_number, r.removed) for r in raw) == [(5, False), (8, True), (10, False)]
    assert [b for b, _ in blocks_of(spark, run_dir)] == [5, 10]
    assert len({r._dlt_id for r in raw}) == 3 and all(r._dlt_load_id.endswith(".parquet") for r in raw)


@pytest.mark.parametrize("rows_held", [None, 0])
def test_one_of_each_log_with_copies_here_and_there(spark, monkeypatch, rows_held):
    if rows_held is not None:
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", rows_held)
    found = [log(0, block=b, tx=b // 2, sender=ZERO) for b in range(8)] + [log(0, block=40, tx=40, sender=ZERO)]
    batch = logs(spark, found).withColumn("_dlt_load_id", F.concat(F.lit("x_"), "block_number", F.lit("_9.parquet")))
    no_key = batch.withColumn("transaction_hash", F.lit(None).cast("binary"))
    batch = batch.unionByName(no_key)
    kept = daily_run._one_each(batch).collect()
    wanted = daily_run.dedup_logs(batch, daily_run.newest_first()).collect()
    assert sorted(map(str, kept)) == sorted(map(str, wanted)) and len(kept) == 5 + 9


def test_messages_are_sent_in_few_bytes(spark, run_dir):
    rows = spark.range(3000).select(F.concat(F.lit('{"id":"'), "id", F.lit('","to":"0x' + "0" * 40 + '"}')).alias("value"))
    for _ in range(2):
        streams._send(rows, run_dir)
    found = spark.read.text(run_dir)
    assert sorted(map(tuple, found.collect())) == sorted([tuple(r) for r in rows.collect()] * 2)
    size = sum(p.stat().st_size for p in Path(run_dir).glob("part-*"))
    assert len(list(Path(run_dir).glob("part-*"))) == 2 * streams.DRAIN_FILES and size < 6000 * 20


def test_a_run_reads_only_buckets_with_its_logs(spark, run_dir):
    put(spark, run_dir, [log(0, block=b, sender=ZERO) for b in range(0, 5000, 500)], 1)
    daily(spark, run_dir, 1)
    far = [daily_run.raw_table(spark, f"{run_dir}/tables", 10), fact_table(spark, f"{run_dir}/tables", "fct_mint", 10)]
    for table in far:
        for name in table._files(0):
            with open(f"{table._folder(0).removeprefix('file:')}/{name}", "w") as file:
                file.write("broken")
    put(spark, run_dir, [log(1, block=4990, sender=ZERO)], 2)
    assert daily(spark, run_dir, 2)["status"] == "success"


def test_a_log_moved_far_away_leaves_its_old_place(spark, run_dir):
    put(spark, run_dir, [log(0, block=9, tx=1, sender=ZERO), log(0, block=8, tx=2, sender=ZERO)], 1)
    daily(spark, run_dir, 1)
    put(spark, run_dir, [log(0, block=1_000_009, tx=1, sender=ZERO)], 2)
    assert daily(spark, run_dir, 2)["status"] == "success"
    assert [b for b, _ in blocks_of(spark, run_dir)] == [8, 1_000_009]


def test_a_refresh_deletes_by_stored_keys_not_by_all_of_the_logs(spark, run_dir, monkeypatch):
    fact = fact_table(spark, f"{run_dir}/tables", "fct_mint", 10)
    rows = [log(0, block=b, tx=b, sender=ZERO) for b in (1, 2, 3)] + [log(1, block=b, tx=b) for b in range(40)]
    first = logs(spark, rows)
    decoded = int_all_transfer(first, signatures(spark))
    assert replace_blocks(fact, "fct_mint", decoded, first, RUN) == 3
    wanted, upsert = [], fact.upsert

    def seen(batch, also_delete):
        wanted.append(also_delete.count())
        return upsert(batch, also_delete)

    monkeypatch.setattr(fact, "upsert", seen)
    second = logs(spark, [log(0, block=1, tx=1, sender=ZERO, removed=True), log(0, block=4, tx=2, sender=ZERO), *rows[2:]])
    assert replace_blocks(fact, "fct_mint", int_all_transfer(second, signatures(spark)), second, RUN) == 1
    assert wanted == [1]
    assert sorted(r.block_number for r in fact.read().collect()) == [3, 4]


def test_job_log_is_appended(spark, run_dir):
    log_ = daily_run.JobLog(spark, run_dir)
    log_.loaded(["a", "b"], (1, 5))
    log_.loaded(["c"], (7, 9))
    files_ = spark.createDataFrame([("a",), ("c",), ("d",)], "file string")
    assert [r.file for r in daily_run.JobLog(spark, run_dir).new_files(files_).collect()] == ["d"]
    first = next(x for x, r in log_.outstanding("facts").items() if r == (1, 5))
    log_.done("facts", [first])
    again = daily_run.JobLog(spark, run_dir)
    assert list(again.outstanding("facts").values()) == [(7, 9)]
    assert sorted(again.outstanding("checks").values()) == [(1, 5), (7, 9)]


def test_ranges_are_merged():
    assert daily_run.merged_ranges([(5, 9), (1, 4), (20, 21), (8, 12)]) == [(1, 12), (20, 21)]
    assert daily_run.merged_ranges([(5, 9), (20, 21)], 15) == [(-10, 21)]


def test_failed_checks_are_reported(spark, run_dir):
    folder = f"{run_dir}/files"
    same_key = [log(0, block=b, tx=1, sender=ZERO) for b in (1, 2)] + [log(5, block=2 * 10**9, sender=ZERO)]
    files.range_stamped_write(logs(spark, same_key), folder, "open_logs")
    result = daily_run.run(spark, folder, "open_logs", signatures(spark), f"{run_dir}/t", RUN, 10)
    assert result["status"] == "failed_checks"
    assert {c["check_name"] for c in result["failed_checks"]} == {"block_range:block_number"}
    again = daily_run.run(spark, folder, "open_logs", signatures(spark), f"{run_dir}/t", RUN, 10)
    assert again["status"] == "failed_checks" and again["loaded"] == 0


def test_work_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_run_dir(spark, "x").startswith(shared_dir(spark))
    assert build_session().version == spark.version
