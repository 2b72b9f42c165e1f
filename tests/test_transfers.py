from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logtide.constants import APPROVAL_TOPIC, TRANSFER_TOPIC
from logtide.plans import marts, staging, transfers
from logtide.schemas import RAW_LOGS, SchemaDrift, check_schema
from tests.helpers import ALICE, BOB, ZERO, address, log, logs, plan, signatures, tuples

RUN = "2024-03-01 12:00:00"


def decode(spark, rows, **options):
    return transfers.int_all_transfer(logs(spark, rows), signatures(spark), **options)


def test_decodes_one_transfer(spark):
    row = decode(spark, [log(value=5 * 10**17)]).first()
    assert (row.from_address, row.to_address) == (address(ALICE), address(BOB))
    assert row.amount_raw == 5 * 10**17 and row.amount == Decimal("0.5")
    assert row.event_name == "Transfer" and not row.amount_overflow


def test_only_live_transfers(spark):
    rows = [log(0), log(1, removed=True), log(2, topic0=APPROVAL_TOPIC), log(3, topic0="0x" + "99" * 32)]
    assert [r.log_index for r in decode(spark, rows).collect()] == [0]


def test_overflow_keeps_its_digits(spark):
    row = decode(spark, [log(value=2**256 - 1)]).first()
    assert row.amount_raw is None and row.amount is None
    assert row.amount_overflow and row.amount_hex == "f" * 64


def test_zero_to_zero_is_minted_and_burned(spark):
    decoded = decode(spark, [log(sender=ZERO, receiver=ZERO), log(1, sender=None), log(2)])
    assert marts.fct_mint(decoded, RUN).count() == 1
    assert marts.fct_burn(decoded, RUN).count() == 1
    assert [r.log_index for r in marts.fct_transfer(decoded, RUN).collect()] == [2]


def test_no_logs(spark):
    decoded = decode(spark, [])
    assert decoded.count() == 0 and marts.fct_mint(decoded, RUN).count() == 0


def test_two_signature_rows_give_two_rows(spark):
    twice = [(TRANSFER_TOPIC, "Transfer", "a"), (TRANSFER_TOPIC, "Transfer", "b")]
    assert transfers.int_all_transfer(logs(spark, [log()]), signatures(spark, twice)).count() == 2


def test_upper_case_signature_topic_matches_nothing(spark):
    upper = [("0x" + TRANSFER_TOPIC[2:].upper(), "Transfer", "a"), ("0xzz", "Transfer", "b")]
    assert transfers.int_all_transfer(logs(spark, [log()]), signatures(spark, upper)).count() == 0


def test_many_topics_fall_back_to_a_join(spark, monkeypatch):
    monkeypatch.setattr(transfers, "MAX_LITERAL_TOPICS", 1)
    rows = [(TRANSFER_TOPIC, "Transfer", "a"), ("0x" + "12" * 32, "Transfer", "b")]
    decoded = transfers.int_all_transfer(logs(spark, [log()]), signatures(spark, rows))
    assert decoded.count() == 1


def test_base64_data(spark):
    encoded = logs(spark, [log(value=42)]).withColumn("data", F.base64("data"))
    bad = logs(spark, [log(1)]).withColumn("data", F.lit("***"))
    decoded = transfers.int_all_transfer(
        encoded.unionByName(bad), signatures(spark), data_encoding="base64"
    )
    assert tuples(decoded.select("log_index", "amount_raw")) == [(0, 42), (1, 0)]


def test_lineage_columns_go_along(spark):
    raw = logs(spark, [log()]).withColumn("_dlt_load_id", F.lit("l")).withColumn("_dlt_id", F.lit("i"))
    assert staging.stg_open_logs(raw).columns[-2:] == ["_dlt_load_id", "_dlt_id"]
    assert transfers.int_all_transfer(raw, signatures(spark)).first()["_dlt_id"] == "i"


def test_token_decimals(spark):
    tokens = spark.createDataFrame([(address(7), 6)], "contract_address string, decimals int")
    decoded = decode(spark, [log(value=1_500_000)])
    assert transfers.with_token_amount(decoded, tokens).first().token_amount == Decimal("1.5")
    none = tokens.where("decimals = 0")
    assert transfers.with_token_amount(decoded, none).first().token_amount == Decimal("0E-8")


def test_tokens_of_several_chains(spark):
    tokens = spark.createDataFrame(
        [(address(7), "a", 6), (address(7), "b", 3)], "contract_address string, chain string, decimals int"
    )
    decoded = decode(spark, [log(i, value=1_500_000) for i in range(5)])
    on_a = transfers.with_token_amount(decoded, tokens, chain="a")
    assert [r.token_amount for r in on_a.collect()] == [Decimal("1.5")] * 5
    both = decoded.withColumn("chain", F.when(F.col("log_index") == 0, "b").otherwise("c"))
    found = {r.log_index: r.token_amount for r in transfers.with_token_amount(both, tokens).collect()}
    assert found[0] == 1500 and found[1] == Decimal("0E-8")
    with pytest.raises(ValueError, match="chain"):
        transfers.with_token_amount(decoded, tokens)
    with pytest.raises(ValueError, match="repeats"):
        transfers.with_token_amount(decoded, tokens.drop("chain"))


def test_amounts_that_do_not_fit_are_marked(spark):
    raw = 9 * 10**37
    row = decode(spark, [log(value=raw)], decimals=6).first()
    assert (row.amount, row.amount_overflow, int(row.amount_hex, 16), int(row.amount_raw)) == (None, True, raw, raw)
    tokens = spark.createDataFrame([(address(7), 6)], "contract_address string, decimals int")
    converted = transfers.with_token_amount(decode(spark, [log(value=raw), log(1, value=5)]), tokens)
    assert {r.log_index: r.token_amount_overflow for r in converted.collect()} == {0: True, 1: False}
    fact = marts.fct_mint(decode(spark, [log(sender=ZERO, value=10**40)]), RUN).first()
    assert fact.minted_amount is None and fact.amount_overflow and int(fact.amount_hex, 16) == 10**40


def test_fact_schemas_and_run_time(spark):
    decoded = decode(spark, [log(sender=ZERO), log(1, receiver=ZERO), log(2)])
    for build, schema in marts.FACTS.values():
        fact = build(decoded, RUN)
        check_schema(fact, schema)
        assert fact.first().date_key == 20240301
    with pytest.raises(SchemaDrift):
        check_schema(decoded, marts.FCT_MINT_SCHEMA)


def test_dim_event_categories(spark):
    names = {
        "Transfer": "token_transfer", "Approval": "token_approval", "RoleRevoked": "access_control",
        "Initialized": "contract_upgrade", "AuctionEnded": "auction",
        "RebalanceX": "rebalancing", "Paused": "other",
    }
    sig = signatures(spark, [(f"0x{n}", n, f"{n}(uint256,bool)") for n in names])
    rows = {r.event_name: r for r in marts.dim_event(sig).collect()}
    assert {n: r.event_category for n, r in rows.items()} == names
    assert rows["Paused"].event_base_name == "Paused"
    assert rows["Paused"].event_parameters == "uint256,bool"
    odd = marts.dim_event(signatures(spark, [("0x", "x", "NoBrackets")])).first()
    assert (odd.event_base_name, odd.event_parameters) == ("NoBrackets", "")


def test_plan_filters_at_the_scan_and_does_not_shuffle(spark, run_dir):
    logs(spark, [log(i) for i in range(10)]).write.parquet(run_dir)
    raw = spark.read.schema(RAW_LOGS).parquet(run_dir)
    decoded = transfers.int_all_transfer(raw, signatures(spark)).where("block_number > 5")
    text = plan(decoded)
    pushed = text[text.index("PushedFilters"):].split("]")[0]
    for part in ("EqualTo(topic0", "Not(EqualTo(removed,true))", "GreaterThan(block_number,5)"):
        assert part in pushed
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    keys = plan(decoded.select("log_index"))
    assert "topic1" not in keys and "transaction_hash" not in keys
