"""The stream of range-stamped files, and copies left out by state."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st

from logtide.sources.block_polls import BlockPollReader, BlockPolls, claims
from logtide.streaming.copies import drop_recent_copies

RANGES = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 12)), max_size=8)


@given(RANGES, st.lists(st.integers(0, 45), min_size=1, max_size=4))
def test_each_block_is_claimed_once(ranges, ends):
    stamped = [(low, low + more, f"f{n}") for n, (low, more) in enumerate(ranges)]
    start, seen = -1, []
    for end in sorted(ends):
        for first, last, name in claims(stamped, start, end):
            low, high = next((f, t) for f, t, n in stamped if n == name)
            assert low <= first <= last <= high <= end
            seen += range(first, last + 1)
        start = max(start, end)
    assert len(seen) == len(set(seen))
    if len(set(ends)) == 1:
        wanted = {b for f, t, _ in stamped if t <= ends[0] for b in range(f, t + 1)}
        assert set(seen) == wanted


@given(RANGES)
def test_polls_of_a_growing_folder_miss_no_newer_block(ranges):
    stamped, position, seen = [], -1, []
    for n, (low, more) in enumerate(sorted(ranges)):
        stamped.append((low, low + more, f"f{n}"))
        end = max(position, max(t for _, t, _ in stamped))
        seen += [b for f, t, _ in claims(stamped, position, end) for b in range(f, t + 1)]
        position = end
    wanted = {b for f, t, _ in stamped for b in range(f, t + 1)}
    assert sorted(seen) == sorted(set(seen))
    # Files come in block order here, so nothing is older than the position.
    assert set(seen) <= wanted and {b for b in wanted if b not in seen} == set()


def _file(folder, low, high, groups=3):
    rows = [b for b in range(low, high + 1) for _ in range(2)]
    table = pa.table({"block_number": rows, "note": [f"{low}:{b}" for b in rows], "more": [1] * len(rows)})
    pq.write_table(table, f"{folder}/x_{low}_{high}.parquet", row_group_size=groups)


def _polled(spark, folder, base, **options):
    spark.dataSource.register(BlockPolls)
    found = spark.readStream.format("block_polls").schema("note string, block_number long")
    stream = found.options(prefix="x", **options).load(f"file://{folder}")
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start(f"{base}/out")
    )
    query.awaitTermination()
    return sorted((r.block_number, r.note) for r in spark.read.schema(stream.schema).parquet(f"{base}/out").collect())


def test_restart_overlap_and_late_file(spark, run_dir, tmp_path):
    _file(tmp_path, 0, 4)
    _file(tmp_path, 3, 6)
    (tmp_path / "other_7_9.parquet").write_text("no file of this prefix")
    first = _polled(spark, tmp_path, run_dir, from_block=1, slice_mb=1)
    assert first == [(b, f"{0 if b < 5 else 3}:{b}") for b in range(1, 7) for _ in range(2)]
    assert _polled(spark, tmp_path, run_dir, from_block=1) == first
    _file(tmp_path, 2, 2)
    _file(tmp_path, 6, 9)
    second = _polled(spark, tmp_path, run_dir, from_block=1)
    assert second == first + [(b, f"6:{b}") for b in range(7, 10) for _ in range(2)]


def test_no_files(spark, run_dir, tmp_path):
    assert _polled(spark, tmp_path, run_dir) == []
    assert _polled(spark, tmp_path / "absent", run_dir + "b") == []


def test_slices_cover_a_file(spark, tmp_path):
    _file(tmp_path, 0, 40)
    schema = spark.createDataFrame([], "block_number long").schema
    reader = BlockPollReader(schema, {"path": str(tmp_path), "Prefix": "x"})
    reader.slice_bytes = 300
    slices = reader.partitions({"block": 9}, {"block": 40})
    assert len(slices) > 2
    rows = [b for part in slices for batch in reader.read(part) for b in batch.column(0).to_pylist()]
    assert sorted(rows) == [b for b in range(10, 41) for _ in range(2)]


def test_schema_is_asked_for(spark, tmp_path):
    spark.dataSource.register(BlockPolls)
    with pytest.raises(Exception, match="needs a schema"):
        spark.readStream.format("block_polls").option("prefix", "x").load(str(tmp_path))


def test_copies_over_batches_and_restarts(spark, run_dir, tmp_path):
    def put(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    def drained():
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path))
        query = (
            drop_recent_copies(stream).writeStream.format("parquet")
            .option("checkpointLocation", f"{run_dir}/checkpoint").trigger(availableNow=True)
            .start(f"{run_dir}/out")
        )
        query.awaitTermination()
        return sorted(r.value for r in spark.read.parquet(f"{run_dir}/out").collect())

    put("a", ["x", "x", "y", ""])
    put("b", ["y", "z", "", "x "])
    assert drained() == ["", "x", "x ", "y", "z"]
    put("c", ["x", "new", "z", "new"])
    assert drained() == ["", "new", "x", "x ", "y", "z"]
