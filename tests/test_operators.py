"""Quality checks, metrics, history and the event catalog."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logtide.operators import event_catalog as event_catalog_module
from logtide.operators import joins
from logtide.operators import quality
from logtide.operators.event_catalog import event_catalog
from logtide.operators.metrics import MINT_MODEL, SemanticModel, metric_query, top_minters
from logtide.operators.scd2 import scd2_replay, scd2_snapshot, start_history
from logtide.constants import TRANSFER_TOPIC
from logtide.plans.checks import quality_suite, source_report
from logtide.plans.marts import fct_transfer
from logtide.plans.transfers import int_all_transfer
from tests.helpers import log, logs, plan, signatures, tuples

T1, T2, T3 = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
ADDRESS = "0x" + "ab" * 20


def test_row_checks_count_in_one_pass(spark):
    df = spark.createDataFrame(
        [(ADDRESS, 1, "a"), (None, -5, "b"), ("ab" * 21, 10**9, None), (ADDRESS[:-1], 0, "c")],
        "address string, block long, kind string",
    )
    checks = quality.not_null_checks(["address", "kind"])
    checks["address"] = quality.invalid_address("address")
    checks["block"] = quality.implausible_block("block")
    checks["kind"] = quality.not_accepted("kind", ["a", "b"])
    report = quality.combine_reports([quality.row_check_report(df, "t", checks)])
    assert plan(report).count("Scan ExistingRDD") == 1
    assert {r.check_name: (r.failed_rows, r.status) for r in report.collect()} == {
        "not_null:address": (1, "fail"), "not_null:kind": (1, "fail"), "address": (3, "fail"),
        "block": (2, "fail"), "kind": (1, "fail"),
    }


def test_declared_checks_find_broken_rows(spark):
    raw = logs(spark, [log(0), log(1, sender=None), log(2, block=2 * 10**9)])
    raw = raw.withColumn("_dlt_id", F.lit("same"))
    sigs = signatures(spark, [(TRANSFER_TOPIC, "Transfer", "t"), (None, "Paused", "p()")])
    decoded = int_all_transfer(raw, sigs)
    facts = {"fct_transfer": fct_transfer(decoded, T1).withColumn("contract_address", F.lit("0x1"))}
    report = quality_suite(raw, sigs, facts)
    failed = {(r.table_name, r.check_name): r.failed_rows for r in report.where("failed_rows > 0").collect()}
    assert failed == {
        ("open_logs", "unique:_dlt_id"): 1,
        ("event_signature", "not_null:topic0"): 1,
        ("stg_event_signature", "not_null:topic0_hash"): 1,
        ("int_event", "not_null:topic0_hash"): 1,
        ("dim_event", "not_null:topic0_hash"): 1,
        ("int_all_transfer", "not_null:from_address"): 1,
        ("int_all_transfer", "block_range:block_number"): 1,
        ("fct_transfer", "valid_address:contract_address"): 2,
    }


def test_source_checks_read_only_their_columns(spark, run_dir):
    logs(spark, [log()]).write.parquet(run_dir)
    report = source_report(spark.read.parquet(run_dir), signatures(spark))[0]
    schema = plan(report).split("ReadSchema: ")[1].split(">")[0]
    assert "topic1" not in schema and "data" not in schema and "transaction_hash" in schema


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], "a string")
    report = quality.combine_reports(
        [
            quality.row_check_report(empty, "t", quality.not_null_checks(["a"])),
            quality.unique_report(empty, "t", ["a"]),
        ]
    )
    assert [r.status for r in report.collect()] == ["pass", "pass"]


def test_duplicate_keys_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "b")], "k int, v string")
    assert tuples(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert quality.unique_report(df, "t", ["k", "v"]).first().failed_rows == 1


def test_unexpected_values_and_addresses(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "kind string")
    assert tuples(quality.unexpected_values(df, "kind", ["a"])) == [("x", 2)]
    found = quality.invalid_addresses(df.withColumnRenamed("kind", "contract_address"))
    assert found.agg(F.sum("invalid_count")).first()[0] == 4


def mint(spark):
    rows = [("0xa", 20240101, "0x1", "5.5"), ("0xa", 20240101, "0x2", "1"), ("0xb", 20240102, "0x1", "2.25"),
            ("0xb", 20240102, "0x3", "7.75"), ("0xb", 20240102, "0x4", None)]
    df = spark.createDataFrame(rows, "contract_address string, date_key int, minting_address string, m string")
    raw = (F.col("m").cast("decimal(38,2)") * 100).cast("long")
    return df.withColumns(
        {
            "minted_amount": F.col("m").cast("decimal(38,18)"),
            "amount_hex": F.when(raw.isNull(), "f" * 64).otherwise(F.lower(F.hex(raw))),
            "amount_overflow": F.col("m").isNull(),
        }
    ).drop("m")


def test_top_minters_break_ties_by_address(spark):
    found = [(r.minting_address, r.total_minted) for r in top_minters(mint(spark), 3).collect()]
    assert found == [("0x4", None), ("0x1", Decimal("7.75")), ("0x3", Decimal("7.75"))]


def test_totals_are_exact_past_every_decimal(spark):
    rng = random.Random(3)
    numbers = [rng.randrange(2**256) for _ in range(50)] + [2**256 - 1] * 3 + [9 * 10**37] * 2 + [0, 1]
    rows = [(f"0x{i % 4}", f"{n:x}" if n else "") for i, n in enumerate(numbers)]
    df = spark.createDataFrame(rows, "minting_address string, amount_hex string").withColumns(
        {"minted_amount": F.lit(None).cast("decimal(38,18)"), "amount_overflow": F.lit(True)}
    )
    totals = {}
    for (who, _), n in zip(rows, numbers, strict=True):
        totals[who] = totals.get(who, 0) + n
    found = top_minters(df, 4).collect()
    assert [(r.minting_address, int(r.total_hex, 16)) for r in found] == sorted(
        totals.items(), key=lambda x: -x[1]
    )
    assert all(len(r.total_hex) == 72 and r.overflow_count == r.mint_count for r in found)
    assert top_minters(df.where("false")).count() == 0


def test_metric_query(spark):
    result = metric_query(
        mint(spark), MINT_MODEL, ["contract_address"],
        {"total": ("sum", "minted_amount"), "n": ("count", "*"), "amounts": ("count", "minted_amount")},
        where="date_key = 20240102",
    )
    assert tuples(result) == [("0xb", Decimal("10"), 3, 2)]
    for dimensions, measures in ((["nope"], {}), ([], {"x": ("sum", "nope")}), ([], {"x": ("mode", "*")})):
        with pytest.raises(ValueError):
            metric_query(mint(spark), MINT_MODEL, dimensions, measures or {"n": ("count", "*")})


def test_semantic_model_from_a_file_entry(spark):
    spec = {
        "name": "FCT_MINT",
        "dimensions": [{"name": "MINTING_ADDRESS", "expr": "MINTING_ADDRESS"}, {"name": "DATE_KEY"}],
        "facts": [{"name": "MINTED_AMOUNT", "expr": "MINTED_AMOUNT"}],
    }
    model = SemanticModel.from_spec(spec)
    measures = {"total": ("sum", "minted_amount")}
    result = metric_query(mint(spark), model, ["date_key"], measures, order_by=["total"], limit=1)
    assert result.first().total == Decimal("10")


def test_metric_overflow_is_null(spark):
    big = mint(spark).withColumn("minted_amount", F.lit("9" * 20).cast("decimal(38,18)"))
    total = metric_query(big, MINT_MODEL, [], {"t": ("sum", "minted_amount")}).first().t
    assert total is None


TOKENS = "address string, chain string, symbol string, decimals int"


def test_history_of_tokens(spark):
    keys, check = ["address", "chain"], ["symbol", "decimals"]
    first = spark.createDataFrame(
        [("a", "x", "A", 6), ("b", "x", "B", None), ("c", "x", "C", 8)], TOKENS
    )
    history = start_history(first, keys, T1)
    second = spark.createDataFrame(
        [("a", "x", "A", 6), ("b", "x", "B", 18), ("d", "y", "D", 1)], TOKENS
    )
    history = scd2_snapshot(history, second, keys, check, T2)
    assert scd2_snapshot(history, second, keys, check, T3).count() == history.count()
    again = scd2_snapshot(history, first, keys, check, T3)

    def span(row):
        return (row.address, row.decimals, str(row.dbt_valid_from), str(row.dbt_valid_to))

    assert sorted(map(span, again.collect()), key=str) == sorted(
        [
            ("a", 6, T1, "None"), ("b", None, T1, T2), ("b", 18, T2, T3), ("b", None, T3, "None"),
            ("c", 8, T1, T2), ("c", 8, T3, "None"), ("d", 1, T2, T3),
        ],
        key=str,
    )
    open_keys = again.where("dbt_valid_to is null").groupBy(*keys).count().where("count > 1")
    assert open_keys.count() == 0
    kept = scd2_snapshot(history, first, keys, check, T3, close_deleted=False)
    assert kept.where("address = 'd' and dbt_valid_to is null").count() == 1


def abi(*items):
    return json.dumps(list(items))


def test_keys_are_counted_by_their_hashes(spark):
    rows = [("a" * 66, 1), ("a" * 66, 1), ("a" * 66, 2), ("b", 1), (None, 1), (None, 1), ("c", None), ("c", None), ("b", 1)]
    report = quality.unique_report(spark.createDataFrame(rows, "tx string, at long"), "t", ["tx", "at"])
    assert [tuple(r) for r in report.collect()] == [("unique:tx,at", "t", 2)]
    assert "hashpartitioning(key_hash" in plan(report) and "hashpartitioning(tx" not in plan(report)


def event(name, *inputs):
    return {"type": "event", "name": name, "inputs": list(inputs)}


def test_event_catalog(spark):
    pair = {"name": "p", "type": "tuple[]", "components": [
        {"name": "a", "type": "address"},
        {"name": "b", "type": "tuple", "components": [{"name": "c", "type": "uint256[2]"}]},
    ]}
    transfer = event("Transfer", {"name": "f", "type": "address", "indexed": True},
                     {"name": "t", "type": "address"}, {"name": "v", "type": "uint256"})
    abis = spark.createDataFrame(
        [
            (abi(transfer, {"type": "function", "name": "pause", "inputs": []}, event("Empty")), abi(transfer)),
            (abi(event("Nested", pair)), None),
            (None, "not json"),
        ],
        "abi string, implementation_abi string",
    )
    topics = spark.createDataFrame([("0xdd", "Transfer(address,address,uint256)")], "topic0 string, signature string")
    rows = {r.signature: r for r in event_catalog(abis, topics).collect()}
    assert sorted(rows) == ["Empty()", "Nested((address,(uint256[2]))[])", "Transfer(address,address,uint256)"]
    assert rows["Transfer(address,address,uint256)"].topic0 == "0xdd"
    assert rows["Empty()"].topic0 is None


def nested(depth, kind="tuple"):
    inner = {"name": "x{", "type": "uint256"}
    for _ in range(depth):
        inner = {"components": [inner, {"name": 'a"}{', "type": "bool"}], "name": "t\\\\", "type": kind}
    return inner


def spelled(parameter):
    """The canonical type, by recursion."""
    if not parameter["type"].startswith("tuple"):
        return parameter["type"]
    return "(" + ",".join(map(spelled, parameter["components"])) + ")" + parameter["type"][5:]


def test_tuples_of_any_depth(spark):
    inputs = [[nested(n), nested(n // 2, "tuple[2][]"), {"name": "z", "type": "int8"}] for n in (0, 1, 2, 5, 9, 30, 100)]
    abis = spark.createDataFrame([(abi(event(f"E{n}", *x)),) for n, x in enumerate(inputs)], "abi string")
    found = {r.event_name: r.signature for r in event_catalog_module.abi_events(abis).collect()}
    assert found == {f"E{n}": f"E{n}({','.join(map(spelled, x))})" for n, x in enumerate(inputs)}


def test_the_plan_of_the_catalog_does_not_grow_with_depth(spark):
    abis = spark.createDataFrame([(abi(event("E", nested(3))),)], "abi string")
    assert len(event_catalog_module.abi_events(abis)._jdf.queryExecution().analyzed().toString()) < 20_000


def test_braces_in_strings_stand_for_nothing(spark):
    odd = {"name": "}{", "type": "tuple", "components": [{"name": "{", "type": 'odd{"}\\'}, {"type": "bool"}]}
    abis = spark.createDataFrame([(abi(event("B", odd, {"type": "{}"})),)], "abi string")
    assert [r.signature for r in event_catalog_module.abi_events(abis).collect()] == ['B((odd{"}\\,bool),{})']


def test_abis_of_one_file_are_spelled_in_many_tasks(spark, run_dir, monkeypatch):
    monkeypatch.setattr(event_catalog_module, "TASK_BYTES", 20_000)
    rows = [(abi(event(f"E{n}", nested(30)), event("Same", nested(2))), None) for n in range(50)]
    spark.createDataFrame(rows, "abi string, implementation_abi string").coalesce(1).write.parquet(run_dir)
    found = event_catalog_module.abi_events(spark.read.parquet(run_dir))
    per_task = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) > 3 and max(r["count"] for r in per_task) < 60
    assert sum(r["count"] for r in per_task) == 100


def test_an_abi_that_all_contracts_share_fills_no_task(spark, run_dir, monkeypatch):
    monkeypatch.setattr(event_catalog_module, "TASK_BYTES", 1_000)
    one = abi(event("Same", {"name": "a", "type": "address"}))
    spark.createDataFrame([(one,)] * 400, "implementation_abi string").coalesce(1).write.parquet(run_dir)
    found = event_catalog_module.abi_events(spark.read.parquet(run_dir))
    per_task = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in per_task) == 400 and max(r["count"] for r in per_task) < 60


@pytest.mark.parametrize("rows_held", [None, 0])
def test_signatures_are_dealt_by_their_text_not_by_shuffled_bytes(spark, run_dir, monkeypatch, rows_held):
    monkeypatch.setattr(event_catalog_module, "TASK_BYTES", 20_000)
    if rows_held is not None:
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", rows_held)
    long_ = [{"name": "a", "type": "uint256"}] * 40
    rows = [(abi(event(f"E{n}", *long_), event("Same", *long_)),) for n in range(200)]
    spark.createDataFrame(rows, "abi string").coalesce(1).write.parquet(run_dir)
    known = [(f"0x{n}{i}", f"E{n}({','.join(['uint256'] * 40)})") for n in range(150) for i in (1, 0)]
    topics = spark.createDataFrame([*known, ("0xff", None)], "topic0 string, signature string")
    found = event_catalog(spark.read.parquet(run_dir), topics).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in found}) > 20
    assert sorted(r.event_name for r in found) == sorted([f"E{n}" for n in range(200)] + ["Same"])
    assert {r.topic0 for r in found} == {f"0x{n}0" for n in range(150)} | {None}


def test_events_without_a_signature_are_set_aside(spark):
    untyped = {"name": "x", "type": "tuple", "components": [{"name": "y"}]}
    long_suffix = {"name": "s", "type": "tuple" + "[3]" * 60, "components": [{"name": "a", "type": "address"}]}
    abis = spark.createDataFrame(
        [(abi(event("Deep", untyped), event("Fine", {"name": "a", "type": "bool"}), event("None", {"type": "tuple"})),),
         (abi(event("Long", long_suffix), event("Untyped", {"name": "a"})),),
         ('[{"type": "event", "inputs": []}, {"type": "event", "name": "Odd", "inputs": {"type": "bool"}}]',)],
        "abi string",
    )
    topics = spark.createDataFrame([], "topic0 string, signature string")
    found = {r.signature for r in event_catalog(abis, topics).collect()}
    assert found == {"Fine(bool)", "Long((address)" + "[3]" * 60 + ")", "None(())", "Odd(bool)"}
    refused = {r.event_name: r.reason for r in event_catalog_module.refused_events(abis).collect()}
    assert set(refused) == {"Deep", "Untyped", None} and "without a type" in refused["Deep"]


@pytest.mark.parametrize("close_deleted", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_replay_is_snapshots_in_turn(spark, seed, close_deleted):
    rng = random.Random(seed)
    days = [f"2024-03-{d:02d} 12:00:00" for d in range(1, 8)]
    rows = [
        (day, k, rng.choice(["a", "b", None]), rng.randint(0, 9))
        for day in days for k in range(12) if rng.random() < 0.7
    ]
    schema = "taken_at string, k long, v string, note long"
    found = spark.createDataFrame(rows, schema).withColumn("taken_at", F.to_timestamp("taken_at"))
    replayed = scd2_replay(found, ["k"], ["v"], close_deleted=close_deleted)
    history = None
    for day in days:
        one = found.where(F.col("taken_at") == F.to_timestamp(F.lit(day))).drop("taken_at")
        history = start_history(one, ["k"], day) if history is None else scd2_snapshot(
            history, one, ["k"], ["v"], day, close_deleted
        )
        history = spark.createDataFrame(history.collect(), history.schema)
    assert replayed.columns == history.columns
    assert tuples(replayed) == tuples(history)


def test_replay_of_a_day_without_rows(spark):
    found = spark.createDataFrame([(1, 5, "a"), (3, 5, "a")], "d int, k long, v string")
    found = found.select(F.timestamp_seconds("d").alias("taken_at"), "k", "v")
    times = spark.range(1, 5).select(F.timestamp_seconds("id").alias("t"))
    rows = scd2_replay(found, ["k"], ["v"], times=times).collect()
    ends = sorted((r.dbt_valid_from.second, r.dbt_valid_to and r.dbt_valid_to.second) for r in rows)
    assert ends == [(1, 2), (3, 4)]
    assert scd2_replay(found.limit(0), ["k"], ["v"]).count() == 0
