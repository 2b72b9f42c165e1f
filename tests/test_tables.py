import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators import joins
from logtide.operators.dedup import dedup_logs, first_by_key
from logtide.plans import incremental, marts, transfers
from logtide.schemas import SchemaDrift
from logtide.sources import loads
from logtide.sources.tables import KeyedTable
from tests.helpers import ZERO, log, logs, signatures, tuples

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


@pytest.fixture
def table(spark, run_dir):
    return KeyedTable(spark, run_dir, SCHEMA, ["k"], F.floor(F.col("k") / 10), ["k"])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_empty_table(table):
    assert table.read().count() == 0 and table.high_water("k") == 0 and not table.exists()


def test_upsert_replaces_keys_and_keeps_copies_in_the_batch(spark, table):
    table.upsert(rows(spark, (1, "a"), (2, "b"), (15, "c"), (None, "n")))
    assert table.upsert(rows(spark, (2, "B"), (2, "BB"), (25, "d"), (None, "m"))) == 4
    assert tuples(table.read()) == [
        (1, "a"), (15, "c"), (2, "B"), (2, "BB"), (25, "d"), (None, "m"), (None, "n")
    ]
    assert table.high_water("k") == 25


def test_upsert_twice_is_the_same(spark, table):
    table.append(rows(spark, *[(i, "old") for i in range(40)]))
    batch = rows(spark, *[(i, "new") for i in range(15, 55)])
    table.upsert(batch)
    once = tuples(table.read())
    table.upsert(batch)
    assert tuples(table.read()) == once and len(once) == 55


def files_of(spark, table):
    return {b: table._files(b) for b in table.buckets()}


def test_upsert_rewrites_only_touched_buckets(spark, table):
    table.append(rows(spark, *[(i, "a") for i in range(50)]))
    before = files_of(spark, table)
    table.upsert(rows(spark, (12, "b")))
    after = files_of(spark, table)
    assert [b for b in before if before[b] != after[b]] == [1]


def test_new_keys_only_add_files(spark, table):
    table.append(rows(spark, (1, "a"), (15, "b")))
    before = files_of(spark, table)
    table.upsert(rows(spark, (2, "c"), (25, "d")))
    after = files_of(spark, table)
    assert set(before[0]) < set(after[0]) and before[1] == after[1] and set(after) == {0, 1, 2}


def test_many_touched_buckets_are_listed_at_once(spark, table, monkeypatch):
    table.append(rows(spark, *[(i, "a") for i in range(0, 500, 10)], (None, "n")))
    wanted = {b: [n for n in table._files(b) if n.endswith(".parquet")] for b in table.buckets()}
    assert len(wanted) == 51 and table._files_of([*wanted, 900]) == {**wanted, 900: []}
    # The rows move into one bucket; the others go, and no folder is listed by itself.
    monkeypatch.setattr(table, "_files", None)
    table.bucket = F.lit(0)
    table.upsert(rows(spark, *[(i, "b") for i in range(0, 500, 10)]))
    assert table.buckets() == [0, None] and table.read().count() == 51


def test_listing_puts_the_setting_back(spark, table):
    from logtide.sources import tables

    before = spark.conf.get(tables._LISTING_TASKS)
    table.append(rows(spark, *[(i, "a") for i in range(0, 900, 10)]))
    assert table.read().count() == 90 and spark.conf.get(tables._LISTING_TASKS) == before


def test_a_new_table_is_written_without_a_copy(spark, table, monkeypatch):
    monkeypatch.setattr(table, "_staged", None)
    assert table.append(rows(spark, (1, "a"), (1, "b"), (25, "c"), (None, "n"))) == 4
    monkeypatch.undo()
    assert table.holding(rows(spark, (1, "x"), (25, "x"), (7, "x"))) == [0, 2]
    assert table.upsert(rows(spark, (1, "z"))) == 1
    assert tuples(table.read()) == [(1, "z"), (25, "c"), (None, "n")]


def test_neighbouring_buckets_are_told_by_their_ends(spark):
    from logtide.sources.tables import _in_buckets

    numbers = [*range(-3, 30), *range(50, 60), None]
    found = spark.createDataFrame([(n,) for n in [*range(-5, 70), None]], "bucket long")
    kept = [r.bucket for r in found.where(_in_buckets(numbers)).collect()]
    assert kept == numbers and "IN (" not in str(_in_buckets(numbers))


BLOCKS = T.StructType(SCHEMA.fields + [T.StructField("block", T.LongType())])


@pytest.fixture
def moved(spark, run_dir):
    return KeyedTable(spark, run_dir, BLOCKS, ["k"], F.floor(F.col("block") / 100))


def test_upsert_finds_keys_however_far_away(spark, moved):
    moved.append(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 5_000)], BLOCKS))
    moved.upsert(spark.createDataFrame([(1, "A", 1_000_001)], BLOCKS))
    assert tuples(moved.read()) == [(1, "A", 1_000_001), (2, "b", 1), (3, "c", 5_000)]
    # The bucket whose last row went has no folder left.
    moved.upsert(spark.createDataFrame([(3, "C", 7)], BLOCKS))
    assert tuples(moved.read()) == [(1, "A", 1_000_001), (2, "b", 1), (3, "C", 7)]
    assert moved.buckets() == [0, 10_000]
    assert moved.insert_absent(spark.createDataFrame([(1, "z", 3), (4, "d", 3)], BLOCKS)) == 1


def test_only_buckets_that_may_hold_a_key_are_opened(spark, moved):
    moved.append(spark.createDataFrame([(n, "a", 100 * n) for n in range(20)], BLOCKS))
    for n in range(20):
        if n not in (3, 7):
            for name in moved._files(n):
                with open(f"{moved._folder(n).removeprefix('file:')}/{name}", "w") as file:
                    file.write("broken")
    batch = spark.createDataFrame([(3, "new", 700), (99, "new", 700)], BLOCKS)
    assert moved.holding(batch) == [3]
    assert tuples(moved.matching(batch)) == [(3, "a", 300)]
    moved.upsert(batch)
    assert tuples(moved.read(7, 7)) == [(3, "new", 700), (7, "a", 700), (99, "new", 700)]
    assert moved.insert_absent(spark.createDataFrame([(3, "x", 0), (50, "x", 2_500)], BLOCKS)) == 1


def test_a_write_that_dies_leaves_the_old_rows(spark, table):
    table.append(rows(spark, *[(i, "old") for i in range(40)]))
    before = tuples(table.read())
    batch = rows(spark, *[(i, "new") for i in range(5, 60)])

    def dies(new, old):
        broken = F.when(F.col("k") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
        return new.withColumn("v", broken.cast("string"))

    with pytest.raises(Exception, match="lost"):
        table.merge(batch, dies)
    assert tuples(table.read()) == before
    table.upsert(batch)
    once = tuples(table.read())
    assert once == sorted([(i, "old") for i in range(5)] + [(i, "new") for i in range(5, 60)], key=str)
    table.upsert(batch)
    assert tuples(table.read()) == once


def test_merge_sees_old_rows_wherever_they_stand(spark, moved):
    moved.append(spark.createDataFrame([(1, "b", 900), (2, "x", 100), (3, "y", 100)], BLOCKS))

    def larger(new, old):
        return new.unionByName(old).groupBy("k").agg(F.max_by(F.struct(*new.columns), "v").alias("r")).select("r.*")

    moved.merge(spark.createDataFrame([(1, "a", 50), (2, "z", 50)], BLOCKS), larger)
    assert tuples(moved.read()) == [(1, "b", 900), (2, "z", 50), (3, "y", 100)]


def test_only_keys_that_are_stored_are_combined(spark, table):
    table.append(rows(spark, (1, "old"), (31, "far")))

    def newer(new, old):
        strange = F.when(F.col("k") != 1, F.raise_error(F.lit("not stored"))).otherwise(F.col("v"))
        return new.withColumn("v", strange.cast("string"))

    assert table.merge(rows(spark, (1, "new"), (5, "a"), (5, "b"), (None, "n"), (32, "c")), newer) == 5
    assert tuples(table.read()) == [(1, "new"), (31, "far"), (32, "c"), (5, "a"), (5, "b"), (None, "n")]


def test_places_follow_the_key(spark, run_dir):
    """Writes under one key, another and none; each finds all rows."""
    by = {name: KeyedTable(spark, run_dir, SCHEMA, [name] if name else [], F.col("k")) for name in ("k", "v", "")}
    by["k"].append(rows(spark, (1, "a"), (2, "b")))
    by["v"].upsert(rows(spark, (9, "b"), (3, "c")))
    assert tuples(by["k"].read()) == [(1, "a"), (3, "c"), (9, "b")]
    by[""].append(rows(spark, (5, "e")))
    by["k"].upsert(rows(spark, (9, "B"), (5, "E")))
    assert tuples(by["k"].read()) == [(1, "a"), (3, "c"), (5, "E"), (9, "B")]
    by["v"].replace(rows(spark, (7, "g")))
    assert by["k"].insert_absent(rows(spark, (7, "x"), (1, "y"))) == 1


def test_there_are_no_files_but_rows_and_places(spark, table):
    from logtide.sources import storage

    table.append(rows(spark, (1, "a")))
    table.upsert(rows(spark, (1, "b"), (None, "c")))
    assert storage.list_names(spark, table.root) == ["places", "rows"]
    names = [n for b in table.buckets() for n in table._files(b)]
    assert names and all(n.endswith(".parquet") or n.endswith(".crc") for n in names)


def test_insert_absent(spark, table):
    assert table.insert_absent(rows(spark, (1, "a"), (2, "b"))) == 2
    assert table.insert_absent(rows(spark, (2, "x"), (3, "c"))) == 1
    assert table.insert_absent(rows(spark, (2, "y"))) == 0
    assert tuples(table.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_insert_absent_when_the_batch_is_too_large_to_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    table.insert_absent(rows(spark, (1, "a"), (2, "b")))
    assert table.insert_absent(rows(spark, (2, "x"), (3, "c"))) == 1


@pytest.mark.parametrize("seed", range(3))
def test_random_writes_match_a_plain_list(spark, table, seed):
    rng, model = random.Random(seed), []
    for step in range(8):
        keys = [rng.choice([None, *range(30)]) for _ in range(rng.randint(0, 12))]
        batch = [(k, f"{step}.{i}") for i, k in enumerate(keys)]
        action = rng.choice(["append", "upsert", "upsert", "insert_absent", "compact", "replace"])
        if action == "compact":
            table.compact()
            continue
        if action == "insert_absent":
            batch = list({k: (k, v) for k, v in batch if k is not None}.values())
        getattr(table, action)(rows(spark, *batch))
        gone = {k for k, _ in batch if k is not None}
        if action == "upsert":
            model = [r for r in model if r[0] not in gone] + batch
        elif action == "insert_absent":
            held = {k for k, _ in model}
            model += [r for r in batch if r[0] not in held]
        else:
            model = (model if action == "append" else []) + batch
        assert tuples(table.read()) == sorted(model, key=str)


def test_compact_changes_no_rows(spark, table):
    for i in range(3):
        table.append(rows(spark, (i, "a"), (i + 100, "b")))
    before = tuples(table.read())
    assert table.compact() == 2
    assert tuples(table.read()) == before
    assert all(sum(n.endswith(".parquet") for n in names) == 1 for names in files_of(spark, table).values())
    table.upsert(rows(spark, (1, "z")))
    assert table.read().where("k = 1").first().v == "z"


def test_schema_drift_is_refused(spark, table):
    with pytest.raises(SchemaDrift):
        table.append(rows(spark, (1, "a")).withColumn("more", F.lit(1)))
    with pytest.raises(SchemaDrift):
        table.append(rows(spark, (1, "a")).withColumn("k", F.lit("1")))


def test_load_dispositions(spark, run_dir):
    first = rows(spark, (1, "a"), (2, "b"))
    loads.load(first, run_dir, "append")
    assert loads.load(first, run_dir, "append").read().count() == 4
    assert loads.load(first, run_dir, "replace").read().count() == 2
    merged = loads.load(rows(spark, (2, "c"), (3, "d")), run_dir, "merge", ["k"])
    assert tuples(merged.read()) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError):
        loads.load(first, run_dir, "merge")
    with pytest.raises(ValueError):
        loads.load(first, run_dir, "other")


def test_lineage_ids_tell_keys_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c")], "x string, y string")
    ids = {r["_dlt_id"] for r in loads.with_load_lineage(df, "l", ["x", "y"]).collect()}
    assert len(ids) == 3


def test_first_by_key_takes_one_row_per_key(spark):
    df = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (2, 5, "z"), (1, 1, "A")], "id int, offset int, v string"
    )
    assert tuples(first_by_key(df, ["id"], ["offset"])) == [(1, 1, "A"), (2, 5, "z")]


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (3, 1, "b"), (3, 2, "c")], "id int, offset int, v string")
    assert tuples(first_by_key(df, ["id"], ["offset"])) == [(3, 1, "b"), (None, 1, "a"), (None, 1, "a")]


def test_dedup_reduces_before_the_shuffle(spark):
    raw = logs(spark, [log(1, tx=5, block=9)] * 500 + [log(1, tx=5, block=8, removed=True), log(2)])
    deduped = dedup_logs(raw)
    assert tuples(deduped.select("block_number", "removed", "log_index")) == [(1, False, 2), (9, False, 1)]
    text = deduped._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and "Window" not in text


def refresh(spark, root, rows, run):
    table = incremental.fact_table(spark, root, "fct_mint", 10)
    decoded = transfers.int_all_transfer(logs(spark, rows), signatures(spark))
    return table, incremental.refresh_fact(table, "fct_mint", decoded, run)


def test_incremental_fact(spark, run_dir):
    mints = [log(0, block=b, sender=ZERO) for b in (0, 5, 30)]
    table, inserted = refresh(spark, run_dir, mints, "2024-01-01 00:00:00")
    assert inserted == 3 and table.high_water("block_number") == 30
    late = [log(1, block=30, sender=ZERO), log(0, block=31, sender=ZERO)]
    table, inserted = refresh(spark, run_dir, mints + late, "2024-01-02 00:00:00")
    assert inserted == 1
    assert sorted(r.block_number for r in table.read().collect()) == [0, 5, 30, 31]
    assert {r.date_key for r in table.read().collect()} == {20240101, 20240102}


def test_lookback_picks_up_late_rows(spark, run_dir):
    table, _ = refresh(spark, run_dir, [log(0, block=30, sender=ZERO)], "2024-01-01 00:00:00")
    rows = [log(i, block=30, sender=ZERO) for i in range(2)]
    decoded = transfers.int_all_transfer(logs(spark, rows), signatures(spark))
    incremental.refresh_fact(table, "fct_mint", decoded, "2024-01-02 00:00:00", lookback_blocks=1)
    assert table.read().count() == 2


def test_new_blocks_are_filtered_at_the_scan(spark, run_dir):
    logs(spark, [log(0, block=b, sender=ZERO) for b in range(20)]).write.parquet(run_dir)
    raw = spark.read.parquet(run_dir)
    decoded = transfers.int_all_transfer(raw, signatures(spark))
    text = marts.fct_mint(incremental.newer_than(decoded, 7), "2024-01-01 00:00:00")
    assert "GreaterThan(block_number,7)" in text._jdf.queryExecution().executedPlan().toString()


def test_a_null_is_a_value_of_its_own_in_hashes(spark):
    from logtide.plans.incremental import _HASHES, _hashed

    pairs = [("a", None), (None, "a"), (None, None), ("a", "a"), ("a", None)]
    found = _hashed(spark.createDataFrame(pairs, "x string, y string"), ["x", "y"]).collect()
    assert [len({tuple(r[h] for h in hashes) for r in found}) for hashes in (_HASHES, _HASHES[:1])] == [4, 4]
