"""Near-duplicates, repeated windows and benchmark passages against brute force."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logtide.llm import bayes_minhash, cover_dedup, fm_decontaminate
from logtide.llm import words as words_module
from logtide.llm.components import components
from logtide.llm.queries import ORACLES, QUERIES
from logtide.llm.words import BASE_1, WindowHashes, word_hashes
from logtide.llm.workspace import Workspace
from tests.llm.data import WORDS, frame, odd_rows, prose


def words_of(text):
    return (text or "").encode().split()


# --- components ---------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, work, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(64)] + [(2000, 2000 + i) for i in range(1, 80)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long"), work, "c").collect()
    assert {r.node: r.label for r in found} == {x: find(x) for x in list(parent)}
    assert len(found) == len(parent)


def test_no_edges(spark, work):
    assert components(spark.createDataFrame([], "a long, b long"), work, "c").count() == 0


# --- near-duplicates ------------------------------------------------------------


def shingles(text, width):
    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def near_by_hand(rows, width, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        component = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def edited(rng, base, n):
    words = list(base)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def near_rows(seed):
    rng = random.Random(seed)
    rows, n = [], 100
    for _ in range(6):
        base = prose(rng.random(), rng.choice([30, 80, 150])).split()
        for _ in range(8):
            rows.append((n, edited(rng, base, rng.randrange(0, 5))))
            n += 1
    # A drifting chain: neighbours are near, the ends are far apart.
    words = prose(99, 200).split()
    for k in range(12):
        words[k * 12] = f"new{k}"
        rows.append((n, " ".join(words)))
        n += 1
    rows += [(n, rows[0][1]), (n + 1, rows[0][1].upper()), (n + 2, " ".join(words[:40]))]
    return rows


def as_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,width", [(1, 4), (2, 5), (3, 4)])
def test_near_duplicates_match_brute_force(spark, work, seed, width):
    rows = near_rows(seed)
    found = bayes_minhash.near_duplicates(frame(spark, rows), work, shingle_words=width)
    assert as_rows(found) == sorted(near_by_hand(rows, width), key=str)


def test_near_duplicates_in_blocks(spark, work):
    rows = near_rows(4)
    found = bayes_minhash.near_duplicates(frame(spark, rows), work, shingle_words=4, block_rows=3)
    assert as_rows(found) == sorted(near_by_hand(rows, 4), key=str)


def test_near_duplicates_of_odd_rows(spark, work):
    rows = odd_rows()
    found = bayes_minhash.near_duplicates(frame(spark, rows), work, shingle_words=5)
    wanted = [
        (i, n, c, k if i is not None else c is None) for i, n, c, k in near_by_hand(rows, 5)
    ]
    assert as_rows(found) == sorted(wanted, key=str)


def test_near_duplicates_of_nothing(spark, work):
    assert bayes_minhash.near_duplicates(frame(spark, []), work).count() == 0


def test_miss_probability_of_the_sequential_test():
    """Pairs right at the threshold are hardly ever given up."""
    rng = np.random.default_rng(0)
    bounds = bayes_minhash.least_matches(100, 20, 0.8, 1e-6)
    assert bounds == sorted(bounds)
    draws = rng.random((50_000, 100)) < 0.8
    lost = np.zeros(len(draws), bool)
    for k, bound in enumerate(bounds):
        lost |= draws[:, : 20 * (k + 1)].sum(axis=1) < bound
    assert lost.mean() < 1e-3
    far = (rng.random((2000, 100)) < 0.3)
    assert (far[:, :60].sum(axis=1) < bounds[2]).mean() > 0.95


# --- repeated windows -------------------------------------------------------------


def test_small_groups_give_memory_back_together(monkeypatch):
    calls = []
    monkeypatch.setattr(words_module, "release_memory", lambda: calls.append(1))
    monkeypatch.setattr(words_module, "RELEASE_BYTES", 8_000)
    same = words_module.released(lambda table: table)
    tables = [pa.table({"x": pa.array(range(n, n + 100), pa.int64())}) for n in range(25)]
    assert [same(t).equals(t) for t in tables] == [True] * 25
    assert len(calls) == 2
    same(pa.table({"x": pa.array(range(1000), pa.int64())}))
    assert len(calls) == 3


def test_every_shift_meets_an_anchor():
    cover = set(cover_dedup.COVER)
    for i in range(cover_dedup.PERIOD):
        for j in range(cover_dedup.PERIOD):
            assert any(
                (i + d) % cover_dedup.PERIOD in cover and (j + d) % cover_dedup.PERIOD in cover
                for d in range(cover_dedup.PERIOD)
            )


def test_window_hashes_depend_on_the_window_alone():
    hashes = WindowHashes(BASE_1)
    words = word_hashes(prose(1, 300).encode().split())
    again = np.r_[word_hashes(b"a b c".split()), words]
    at = np.arange(250)
    assert np.array_equal(hashes.at(words, 50, at), hashes.at(again, 50, at + 3))
    assert len(np.unique(hashes.at(words, 50, at))) == 250


def repeats_by_hand(rows, window):
    first = {}
    for doc_id, text in rows:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, float("inf")), float("inf") if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + window))
        out.append((doc_id, [x for i, x in enumerate(w) if i not in gone]))
    return out


def repeats_found(spark, work, rows, window):
    found = {}
    for r in cover_dedup.repeated_spans(frame(spark, rows), work, window=window).collect():
        found[r.doc_id, r.text] = [s.asDict() for s in r.spans]
    return [
        (i, cover_dedup.kept_words(words_of(t), found.get((i, t), []))) for i, t in rows
    ], found


def window_rows(seed):
    rng = random.Random(seed)
    passages = [prose(rng.random(), n) for n in (33, 50, 51, 80, 140)]
    rows = []
    for i in range(60):
        parts = [prose(rng.random(), rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(rng.random(), rng.randrange(0, 40))]
        rows.append((i, "\n".join(parts)))
    return rows + [(60, rows[5][1]), (61, passages[4] + " " + passages[4]), (62, passages[4])]


@pytest.mark.parametrize("seed,window", [(1, 50), (2, 31), (3, 50)])
def test_repeated_windows_match_brute_force(spark, work, seed, window, monkeypatch):
    monkeypatch.setattr(cover_dedup, "FLUSH_KEYS", 700)
    monkeypatch.setattr(cover_dedup, "BUCKET_KEYS", 100)
    rows = window_rows(seed)
    found, _ = repeats_found(spark, work, rows, window)
    assert found == repeats_by_hand(rows, window)


def test_repeated_windows_of_odd_rows(spark, work):
    rows = odd_rows()
    found, spans = repeats_found(spark, work, rows, 50)
    assert found == repeats_by_hand(rows, 50)
    assert spans[9, rows[9][1]] == [{"first": 0, "last": 30_000}]
    assert repeats_found(spark, work.__class__(spark, "empty"), [], 50) == ([], {})


def test_words_go_with_what_stands_between_them():
    text = "é one\n two  three four ".encode()
    assert cover_dedup.without_spans(text, [{"first": 1, "last": 3}]) == "é   three four ".encode()
    assert cover_dedup.without_spans(text, [{"first": 0, "last": 5}]) == b" "


# --- benchmark passages ------------------------------------------------------------


BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def hits_by_hand(rows, items, window=10):
    out = []
    for doc_id, text in rows:
        w, hit, named = bench_words(text), set(), set()
        for item_id, item in items:
            p = bench_words(item)
            n = min(window, len(p))
            if item_id is None or not p:
                continue
            phrases = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in phrases:
                    hit.update(range(i, i + n))
                    named.add(item_id)
        out.append((doc_id, len(w), len(hit), sorted(named)))
    return sorted(out, key=str)


ITEMS = [
    (1, prose(50, 30)), (2, prose(51, 10)), (3, "Only THREE words"), (4, None), (5, ""), (6, "..."), (None, prose(52, 12)),
    (7, prose(50, 30)), (8, "w1"), (9, prose(53, 25)), (9, prose(54, 15)),
]


def bench_rows(seed):
    rng = random.Random(seed)
    texts = [t for _, t in ITEMS if t and len(t) > 20]
    rows = []
    for i in range(80):
        words = prose(rng.random(), rng.randrange(0, 200), [f"w{k}" for k in range(30)]).split()
        for _ in range(rng.randrange(3)):
            p = rng.choice(texts).split()
            a = rng.randrange(len(p))
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[a : a + rng.randrange(5, 30)]
        rows.append((i, rng.choice([" ", "-", "\n", ", "]).join(words).title()))
    return rows + [(80, "only three WORDS"), (81, "only"), (82, "Only THREE words. é only three words")]


def numbers(items):
    return sorted((None if i is None else int(i) for i in items), key=lambda i: (i is None, i or 0))


def found_hits(spark, rows, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("label", F.lit(1))
    found = fm_decontaminate.find_contamination(frame(spark, rows), bench, **options).collect()
    return sorted(
        [
            (r.doc_id, r.bench_n_words, sum(s.last - s.first for s in r.bench_spans), numbers(r.bench_items))
            for r in found
        ],
        key=str,
    )


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"shard_words": 500}), (3, {"pass_words": 150})])
def test_passages_match_brute_force(spark, seed, options):
    rows = bench_rows(seed)
    assert found_hits(spark, rows, ITEMS, **options) == hits_by_hand(rows, ITEMS)


def test_passages_of_long_items_only(spark):
    items = [x for x in ITEMS if x[0] in (1, 9)]
    rows = bench_rows(5)
    assert found_hits(spark, rows, items) == hits_by_hand(rows, items)


def test_items_with_names(spark):
    """Ids of any kind, in order as strings; found over several passes too."""
    first, second = prose(71, 12), prose(72, 14)
    bench = spark.createDataFrame([("b-10", first), ("a", second), ("b-9", first)], "item_id string, text string")
    for options in ({}, {"pass_words": 10}):
        found = fm_decontaminate.find_contamination(frame(spark, [(1, f"{first} {second}"), (2, "x")]), bench, **options)
        assert {r.doc_id: list(r.bench_items) for r in found.collect()} == {1: ["a", "b-10", "b-9"], 2: []}


def test_passages_in_odd_rows(spark):
    rows = odd_rows()
    assert found_hits(spark, rows, ITEMS) == hits_by_hand(rows, ITEMS)
    assert found_hits(spark, [], ITEMS) == []
    assert found_hits(spark, rows, []) == hits_by_hand(rows, [])


@pytest.mark.parametrize("options", [{}, {"pass_words": 150}])
def test_passages_of_items_without_id(spark, options):
    rows = bench_rows(1)
    numbered = [(99 if i is None else i, t) for i, t in ITEMS]
    wanted = [
        (d, n, hit, [None if i == 99 else i for i in items]) for d, n, hit, items in hits_by_hand(rows, numbered)
    ]
    assert any(None in items for _, _, _, items in wanted)
    assert found_hits(spark, rows, ITEMS, null_ids=True, **options) == sorted(wanted, key=str)


def test_query_and_pipeline_search_items_without_id(spark, run_dir):
    passage, other, lead = prose(52, 12), prose(53, 12), prose(70, 20)
    rows = [(1, f"{lead} {passage}"), (2, f"{lead} {passage} {other}"), (3, lead)]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{run_dir}/documents.parquet")
    bench = spark.createDataFrame([(None, passage), (None, passage), (7, other)], "item_id long, text string")
    bench.write.parquet(f"{run_dir}/benchmark.parquet")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = QUERIES["op5_fm_decontaminate"](spark, run_dir).select(columns).collect()
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{run_dir.removeprefix('file:')}/{name}.parquet/*.parquet'")
    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op5_fm_decontaminate']})").fetchall()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert [(r.n_hit, r.n_items) for r in sorted(found)] == [(12, 1), (24, 2), (0, 0)]
    texts = {r.doc_id: r.text.strip() for r in corpus_pipeline.decontaminate(spark, docs, run_dir).collect()}
    assert texts == {1: lead, 2: lead, 3: lead}


def test_clashing_result_columns_are_refused(spark):
    docs = frame(spark, [(1, "a")]).withColumn("bench_items", F.lit(1))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    with pytest.raises(ValueError, match="prefix"):
        fm_decontaminate.find_contamination(docs, bench)
    assert fm_decontaminate.find_contamination(docs, bench, prefix="_b_").count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_places(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, [3, 6, 40, 2][seed], 500)
    text[rng.integers(0, 500, 20)] = 0
    text[-1] = 0
    index = fm_decontaminate.FMIndex(text, int(text.max()) + 1, sample=7)
    for n in (1, 2, 5):
        starts = [i for i in range(500 - n) if (text[i : i + n] > 0).all()]
        phrases = np.unique(np.array([text[i : i + n] for i in starts]), axis=0)
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high, strict=True):
            wanted = [i for i in range(500 - n + 1) if np.array_equal(text[i : i + n], p)]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


def test_spans_are_cut_from_texts():
    text = "É one, TWO-three\nfour. five".encode()
    assert fm_decontaminate.without_spans(text, [{"first": 1, "last": 4}]) == "É \nfour. five".encode()


@pytest.mark.parametrize("limits", [{"block_rows": 4}, {"block_bytes": 700}, {"block_rows": 1}])
def test_large_clusters_meet_representatives_first(spark, work, limits):
    """One group of many near copies, a chain through it, and unlike texts that share
    most words with it."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for n in range(30):
        words = list(base)
        words[n] = f"x{n}"
        rows.append((n, " ".join(words)))
    for n in range(4):
        rows.append((40 + n, " ".join(base[: 60 - 3 * n] + [f"y{n}{i}" for i in range(3 * n)])))
    rows += [(50, " ".join(base[30:] + base[:30])), (51, None), (52, "")]
    found = bayes_minhash.near_duplicates(frame(spark, rows), work, shingle_words=4, **limits)
    once = bayes_minhash.near_duplicates(
        frame(spark, rows), Workspace(spark, "whole"), shingle_words=4
    )
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    answer = sorted(map(tuple, once.select(columns).collect()), key=str)
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == answer
    assert len({r[2] for r in answer}) < len(rows) - 20
