"""Hard negatives, Feistel shards and fill-in-the-middle against brute force."""

import hashlib
import math
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logtide.llm import feistel_shards, fill_middle, hard_negatives
from tests.helpers import plan
from tests.llm.data import frame, odd_rows, prose

LINE = re.compile("[^\n]*\n|[^\n]+")
VECTORS = "vec_id long, embedding array<float>, label int"


# --- fill-in-the-middle ---------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\U0001f642\n", max_size=200), st.sampled_from([1, 2, 3, 7, 64]))
def test_block_counts_find_every_boundary(text, block):
    for unit, pieces in (("line", LINE.findall(text)), ("char", list(text))):
        counts = fill_middle.BlockCounts(text.encode(), unit, block)
        assert counts.n_units == len(pieces)
        for k in range(len(pieces) + 1):
            head = "".join(pieces[:k])
            assert counts.after(k) == (len(head.encode()), len(head))
        with pytest.raises(ValueError, match="units"):
            counts.after(len(pieces) + 1)


def brute_fim(doc_id, text, percent=100):
    text = text or ""
    lines = LINE.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(lines)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def fim_rows():
    lines = ["\n".join(prose(n + k, 9) for k in range(n)) for n in range(40)]
    return odd_rows() + [(100 + n, x + "\n" * (n % 3)) for n, x in enumerate(lines)] + [
        (200, "has <P> in it\nand more"), (201, "<M>"), (202, "\n\n\n"), (203, "\r\nä\r\n" * 400),
        (204, "ends with <\nP> <S\nS>M>\n"), (205, "<\n>\n<"), (206, ("ü" * 700 + "\n") * 900),
    ]


@pytest.mark.parametrize("percent", [100, 40])
def test_fill_middle_matches_brute_force_and_comes_back(spark, percent):
    rows = fim_rows()
    made = fill_middle.fill_middle(frame(spark, rows), fim_percent=percent)
    found = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    told = sorted(
        ((r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=str
    )
    assert told == sorted(((i, *brute_fim(i, t, percent)) for i, t in rows), key=str)
    assert sorted(r.back for r in found) == sorted(t or "" for _, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_fill_middle_by_characters_and_other_sentinels(spark):
    rows = [(n, "aé\U0001f642 [SUF]"[: n % 5] * 50) for n in range(60)]
    marks = {"prefix": "[PRE]", "suffix": "[SUF]", "middle": "[MID]"}
    made = fill_middle.fill_middle(frame(spark, rows), unit="char", **marks)
    found = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), **marks)).collect()
    assert {r.doc_id: r.back for r in found} == dict(rows)
    assert all(r.n_units == len(dict(rows)[r.doc_id]) for r in found)
    for bad in ({"prefix": "<S>"}, {"prefix": "><"}, {"prefix": ""}, {"prefix": "aa>a"}, {"unit": "page"}):
        with pytest.raises(ValueError, match="sentinel|begin|unit"):
            fill_middle.fill_middle(frame(spark, rows), **bad)


def test_fill_middle_of_nothing(spark):
    assert fill_middle.fill_middle(frame(spark, [])).count() == 0


# --- Feistel shards -------------------------------------------------------------


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 97, 1000, 1023])
def test_permutation_takes_every_place_once_and_turns_back(spark, total):
    numbers = spark.range(total).select("id", feistel_shards.permuted(F.col("id"), total).alias("at"))
    shard, slot = F.pmod("at", F.lit(7)), F.floor(F.col("at") / 7)
    rows = numbers.select("id", "at", feistel_shards.row_at(shard, slot, total, 7).alias("back")).collect()
    assert sorted(r["at"] for r in rows) == list(range(total))
    assert all(r.id == r.back for r in rows)


def test_permutation_follows_the_seed_and_moves_rows(spark):
    total = 5_000
    orders = {}
    for seed in (1, 2):
        rows = spark.range(total).select("id", feistel_shards.permuted(F.col("id"), total, seed).alias("at"))
        orders[seed] = [r["at"] for r in sorted(rows.collect())]
    assert orders[1] != orders[2]
    steps = [b - a for a, b in zip(orders[1], orders[1][1:], strict=False)]
    assert sum(abs(s) < 50 for s in steps) < 200
    # Neighbours spread over shards as by chance: 40 shards, 125 rows each.
    first = [at % 40 for at in orders[1][:2_000]]
    spread = [first.count(s) for s in range(40)]
    assert sum((n - 50) ** 2 / 50 for n in spread) < 75
    with pytest.raises(ValueError, match="even"):
        feistel_shards.permuted(F.col("id"), total, rounds=3)


def xx(seed, key, value):
    import struct

    import xxhash

    def signed(n):
        return n - (1 << 64) if n >> 63 else n

    one = xxhash.xxh64_intdigest(struct.pack("<q", seed), 42)
    # A four-byte key is hashed as such.
    two = xxhash.xxh64_intdigest(struct.pack("<i", key), one)
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", value), two))


def brute_place(number, total, seed=feistel_shards.SEED, rounds=feistel_shards.ROUNDS):
    height = math.ceil(math.sqrt(total))
    width = -(-total // height)
    while True:
        x, y = divmod(number, width)
        for k in range(rounds):
            x, y = y, (x + xx(seed, k, y)) % (width if k % 2 else height)
        number = x * width + y
        if number < total:
            return number


def test_shards_match_brute_force(spark, work):
    rows = odd_rows() + [(1000 + n, prose(n, n % 30)) for n in range(300)] + [(7, prose(6, 90))] * 40
    found = feistel_shards.shard_documents(frame(spark, rows).repartition(5), work, shards=7).collect()
    assert len(found) == len(rows)
    in_order = sorted(found, key=lambda r: r.row_no)
    assert [r.row_no for r in in_order] == list(range(len(rows)))
    keys = [(r.doc_id is not None, r.doc_id or 0, r.row_fp) for r in in_order]
    assert keys == sorted(keys)
    for r in found:
        assert (r.slot, r.shard) == divmod(brute_place(r.row_no, len(rows)), 7)
    for shard in range(7):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 7, len(rows) // 7 + 1)
    told = sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=str)
    assert told == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str
    )


def test_shards_do_not_follow_the_files(spark, run_dir):
    from logtide.llm.workspace import Workspace

    rows = [(n // 2, prose(n, 5)) for n in range(200)]
    places = []
    for n, parts in enumerate((1, 6)):
        docs = frame(spark, rows[:: -1 if n else 1]).repartition(parts)
        found = feistel_shards.shard_documents(docs, Workspace(spark, "files"))
        places.append(sorted((r.doc_id, r.row_fp, r.shard, r.slot) for r in found.collect()))
    assert places[0] == places[1]


def test_rows_of_small_ranges_and_whole_rows_in_shards(spark, work, run_dir):
    docs = frame(spark, [(n % 50, prose(n, 4)) for n in range(400)] + [(5, "same")] * 200)
    found, total = feistel_shards.numbered(docs, ["doc_id", "text"], work, rows_per_part=37)
    rows = found.select("row_no", "doc_id", "text").collect()
    assert total == 600 and sorted(r.row_no for r in rows) == list(range(600))
    in_order = [(r.doc_id, r.text) for r in sorted(rows)]
    assert in_order == sorted(in_order)
    placed = feistel_shards.assigned(docs, ["doc_id", "text"], type(work)(spark, "whole"), shards=4)
    feistel_shards.write_shards(placed, f"{run_dir}/shards", 8)
    back = spark.read.parquet(f"{run_dir}/shards")
    assert set(docs.columns) <= set(back.columns)
    assert back.groupBy("shard").count().select("count").distinct().first()[0] == 150
    with pytest.raises(ValueError, match="row_no"):
        feistel_shards.numbered(docs.withColumn("row_no", F.lit(1)), ["doc_id"], work)


def test_shards_of_nothing_and_native_plan(spark, work):
    empty = feistel_shards.shard_documents(frame(spark, []), work)
    assert empty.count() == 0
    text = plan(empty)
    assert not any(word in text for word in ("Python", "InArrow", "InPandas", "CartesianProduct"))


# --- hard negatives -------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=10, low=30, high=90, every=100):
    usable = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {(i, tuple(v), label) for i, v, label in usable if i % every == 0}
    out = []
    for anchor, vector, label in anchors:
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v, strict=False)), i, other) for i, v, other in usable
        )
        near = [(-s, i) for s, i, other in scored if other == label and i != anchor][:positives]
        for ps, p in near:
            hits = [(-s, i) for s, i, other in scored if other != label and low * ps <= -100 * s <= high * ps]
            out += [(anchor, p, n + 1, i, ps, s) for n, (s, i) in enumerate(hits[:negatives])]
    return sorted(out)


def mined(spark, work, rows, schema=VECTORS, **options):
    df = spark.createDataFrame(rows, schema).withColumn("anchor_id", F.lit("x")).withColumn("grp", F.lit("y"))
    df = df.withColumn("vector", F.lit(1)).withColumn("key", F.lit(2))
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, work, **options)
    return sorted(tuple(r) for r in found.collect())


def vectors(seed, n, size=6, labels=4, step=7, quantum=8):
    rng = random.Random(seed)
    return [
        (k * step, [rng.randint(-3, 5) / quantum for _ in range(size)], rng.randrange(labels))
        for k in range(n)
    ]


@pytest.mark.parametrize("group_rows", [5, 40, 10_000])
def test_hard_negatives_match_brute_force(spark, work, group_rows):
    rows = vectors(1, 500)
    found = mined(spark, work, rows, group_rows=group_rows)
    assert found == brute_negatives(rows) and len(found) > 50


def test_hard_negatives_with_ties_and_one_hot_vector(spark, work):
    same = [(n, [0.5, 0.25], 1 if n % 3 else 2) for n in range(1, 300)]
    zero = [(400, [0.0, 0.0], 1), (500, [-1.0, -1.0], 1), (600, [0.5, 0.25], 1), (700, [0.5, 0.25], 9)]
    mixed = [(1000 + n, [0.5 - n / 64, 0.1], n % 4) for n in range(40)]
    rows = same + zero + mixed
    found = mined(spark, work, rows, group_rows=16)
    assert found == brute_negatives(rows)
    # Scores of zero: the window of a positive with 0 holds negatives with 0.
    assert any(r[0] == 400 and r[4:] == (0, 0) for r in found)


def test_hard_negatives_bear_odd_rows(spark, work):
    nan, inf = float("nan"), float("inf")
    odd = [
        (None, [1.0, 1.0], 1), (100, None, 1), (1, [1.0, None], 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1),
        (4, [1.0, 1.0], None), (5, [], 1), (6, [1.0], 2), (7, [1.0, 1.0, 1.0], 2),
    ]
    base = [(200, [1.0, 0.5], 1), (200, [1.0, 0.5], 1), (200, [0.25, 0.5], 2)]
    more = [(10 + n, [1.0 - n / 40, 0.25], n % 3) for n in range(30)] + [(11, [0.5, 0.25], 1)] * 3
    rows = odd + base + more
    assert mined(spark, work, rows, group_rows=7) == brute_negatives(rows)


def test_hard_negatives_of_large_numbers(spark, work):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(100 * (n % 2) + n, [2.0**24 + n, 2.0**24 - 3 * n], n % 2) for n in range(60)]
    assert mined(spark, work, rows, schema) == brute_negatives(rows)
    huge = [(100, [1e300], 1), (1, [1e300], 1), (2, [1e300], 2), (3, [0.5e-290], 2)]
    found = mined(spark, type(work)(spark, "huge"), huge, schema)
    assert found == []


def test_hard_negatives_of_nothing(spark, work):
    assert mined(spark, work, []) == []
    assert mined(spark, type(work)(spark, "no-anchor"), vectors(3, 10, step=0)[1:2] + [(1, [1.0], 0)]) == []


def test_hard_negatives_send_few_pairs(spark, work):
    """The sort gets a bounded number of keys per anchor and group, not all pairs."""
    rows = vectors(5, 2_000, step=5)
    mined(spark, work, rows, group_rows=500)
    sent = spark.read.parquet(work.path("positives"))
    assert sent.groupBy("anchor_id", "anchor_fp").count().agg(F.max("count")).first()[0] == 5


def test_keys_sort_like_their_numbers():
    import numpy as np

    numbers = [-(1 << 62), -5, 0, 3, 1 << 62]
    keys = [
        (hard_negatives.packed(a, f, np.array([s]), k, np.array([i]))[0], (a, f, -s, k, i))
        for a in numbers for f in numbers for s in numbers for k in (0, 1) for i in numbers
    ]
    assert [x for _, x in sorted(keys)] == sorted(x for _, x in keys)
    told = hard_negatives.unpacked([k for k, _ in keys])
    assert [(a, f, -s, k, i) for a, f, s, k, i in zip(*told.values(), strict=True)] == [x for _, x in keys]
