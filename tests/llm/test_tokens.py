"""Token ids, length sums, packing and frame files against brute force."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from logtide.llm import frame_store, length_histogram, queries, tokens, two_fit_packing
from logtide.llm.tokens import Encoder, tokenizer_path
from logtide.llm.workspace import Workspace
from tests.helpers import plan
from tests.llm.data import frame, odd_rows, prose


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "alphabet",
    [
        " \n\t\r  \x1c\x85\xa0 　ab'Z9!.ñ日한🙂​\x00\x0b<|endoftext|>",
        " \n\t  \x85\xa0ab'Zst9!._ñéß²Ⅷ^`", " 'sStT’re ll", "  \n\n x",
    ],
)
def test_units_give_the_ids_of_whole_texts(tokenizer, alphabet):
    rng, encoder = random.Random(2), Encoder(tokenizer_path())
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(tokenizer, text), ascii(text)


def test_memos_that_are_full_give_the_same_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    monkeypatch.setattr(tokens, "MEMO_UNITS", 3)
    rng, encoder = random.Random(5), Encoder(tokenizer_path())
    words = ["then", "then,", "then.", "Größe,", "it's", "it's.", "a.\nThe", ",", ",,", "x²,", "日.", "_a,", "9."]
    for _ in range(500):
        text = " ".join(rng.choices(words, k=rng.randint(1, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(tokenizer, text), text


SPECIAL = "a <|endoftext|> b<|endoftext|>"


def test_special_strings_as_the_library_has_them(spark, tokenizer):
    assert np.frombuffer(Encoder(tokenizer_path()).encode(SPECIAL), "<u4").tolist() == whole(tokenizer, SPECIAL)
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    found = np.frombuffer(Encoder(tokenizer_path(), special_as_text=True).encode(SPECIAL), "<u4").tolist()
    assert found == whole(plain, SPECIAL) != whole(tokenizer, SPECIAL)
    docs = frame(spark, [(1, SPECIAL), (2, "x")])
    assert {r.n_tokens for r in length_histogram.token_lengths(docs).collect()} == {
        len(whole(tokenizer, t)) for t in (SPECIAL, "x")
    }
    pieces = two_fit_packing.token_pieces(docs, with_ids=True).where("doc_id = 1").first()
    assert list(pieces.ids) == [*whole(tokenizer, SPECIAL), 0]


def test_special_strings_in_files(spark, tokenizer, run_dir):
    manifest = frame_store.write_token_files(frame(spark, [(1, SPECIAL), (2, "x")]), f"{run_dir}/files")
    ids = {r.doc_id: list(r.ids) for r in frame_store.read_tokens(manifest).collect()}
    assert ids == {1: [*whole(tokenizer, SPECIAL), 2], 2: [*whole(tokenizer, "x"), 2]}


def test_length_sums(spark, work):
    lengths = [0, 0, 3, 5, 5, 1500, 1500, 9000]
    df = spark.createDataFrame([(x,) for x in [*lengths, None]], "n_tokens long")
    histogram = length_histogram.length_histogram(df, work)
    rows = {r.length: r for r in histogram.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for length, row in rows.items():
        assert row.n_docs == lengths.count(length)
        assert row.docs_at_least == sum(x >= length for x in lengths)
        assert row.tokens_at_least == sum(x for x in lengths if x >= length)
        assert row.docs_up_to == sum(x <= length for x in lengths)
        assert row.tokens_up_to == sum(x for x in lengths if x <= length)
        assert row.truncated_tokens == sum(min(x, length) for x in lengths)
    limits = [0, 1, 4, 5, 1500, 1501, 9000, 10_000]
    found = length_histogram.at_limits(histogram, limits)
    assert found.columns == histogram.columns
    asked = {r.length: r for r in found.collect()}
    assert sorted(asked) == limits
    for limit, row in asked.items():
        assert (row.n_docs, row.n_tokens) == (lengths.count(limit), limit * lengths.count(limit))
        assert row.docs_at_least == sum(x >= limit for x in lengths)
        assert row.tokens_at_least == sum(x for x in lengths if x >= limit)
        assert row.docs_up_to == sum(x <= limit for x in lengths)
        assert row.tokens_up_to == sum(x for x in lengths if x <= limit)
        assert row.truncated_tokens == sum(min(x, limit) for x in lengths)
    found = {r.quantile: r.length for r in length_histogram.at_quantiles(histogram, [0.0, 0.5, 1.0]).collect()}
    assert found == {0.0: 0, 0.5: 5, 1.0: 9000}
    alone = spark.createDataFrame(histogram.collect(), histogram.schema)
    assert "Join" not in plan(length_histogram.at_limits(alone, limits))


def test_answers_of_no_documents(spark, work):
    histogram = length_histogram.length_histogram(spark.createDataFrame([], "n_tokens long"), work)
    assert [tuple(r) for r in length_histogram.at_limits(histogram, [5]).collect()] == [(5, 0, 0, 0, 0, 0, 0, 0)]
    assert length_histogram.at_quantiles(histogram, [0.5]).count() == 0


def test_length_query_answers_limits_and_quantiles(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    lengths = sorted(len(whole(tokenizer, t)) for t in texts)
    rows = queries.q_length_histogram(spark, sf_dir).collect()
    assert {r.length: r.n_docs for r in rows if r.asked is None} == {n: lengths.count(n) for n in lengths}
    for r in rows:
        if r.asked == "limit":
            assert r.truncated_tokens == sum(min(n, r.length) for n in lengths)
            assert r.docs_up_to == sum(n <= r.length for n in lengths)
        elif r.asked:
            share = float(r.asked.split()[1])
            assert r.length == next(n for n in lengths if sum(x <= n for x in lengths) >= share * len(lengths))
    assert sum(r.asked is not None for r in rows) == len(queries.CONTEXT_LIMITS) + len(queries.QUANTILES)


def test_histogram_of_odd_documents(spark, tokenizer, work):
    rows = odd_rows()
    found = length_histogram.length_histogram(length_histogram.token_lengths(frame(spark, rows)), work)
    wanted = [len(whole(tokenizer, t)) for _, t in rows]
    assert {r.length: r.n_docs for r in found.collect()} == {n: wanted.count(n) for n in wanted}
    none = length_histogram.token_lengths(frame(spark, []))
    assert length_histogram.length_histogram(none, Workspace(spark, "none")).count() == 0


def check_bins(rows, size):
    for _, pieces in rows.items():
        pieces.sort()
        at = 0
        for offset, length in pieces:
            assert offset == at
            at += length
        assert at <= size


def test_packing_of_odd_documents(spark, tokenizer):
    rows = odd_rows()
    pieces = two_fit_packing.token_pieces(frame(spark, rows), with_ids=True)
    bins = {}
    for r in two_fit_packing.pack(pieces.drop("ids")).collect():
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    check_bins(bins, 2048)
    wanted = sorted(sum(([*whole(tokenizer, t), 0] for _, t in rows), []))
    found = pieces.collect()
    assert sorted(x for r in found for x in r.ids) == wanted
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    total = sum(length for b in bins.values() for _, length in b)
    assert total == len(wanted) and len(bins) <= -(-total // 2048) + 1
    assert two_fit_packing.pack(two_fit_packing.token_pieces(frame(spark, []))).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bins_are_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [2048, 100, 1025, 700, 2048, 3][seed] + 1, 3000)
    bins, offsets = two_fit_packing.assign_bins(lengths, 2048)
    by_bin = {}
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths.tolist(), strict=True):
        by_bin.setdefault(b, []).append((o, n))
    check_bins(by_bin, 2048)
    greedy = []
    for n in sorted(lengths.tolist(), reverse=True):
        fit = [i for i, gap in enumerate(greedy) if gap >= n]
        if fit:
            best = min(fit, key=lambda i: greedy[i])
            greedy[best] -= n
        else:
            greedy.append(2048 - n)
    assert len(by_bin) <= len(greedy) + 2


def test_smallest_gives_way_to_a_tighter_pair():
    # 10 - 6 - 3 leaves 1; 3 gives way to 2 + 2.
    assert list(two_fit_packing.plan_bins(np.array([6, 3, 2, 2]), 10))[0] == [6, 2, 2]


def test_groups_of_bounded_size(spark):
    rows = [(i, "a " * (i % 7 + 1)) for i in range(200)]
    pieces = two_fit_packing.token_pieces(frame(spark, rows))
    placed = two_fit_packing.pack(pieces, size=16, group_pieces=20).collect()
    assert len(placed) == 200 and len({r.sequence_id >> 32 for r in placed}) > 5


def test_frames_round_trip_and_partial_reads():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 60000, n) for n in (5, 0, 250, 3, 100, 99, 1, 700)]
    sink = pa.BufferOutputStream()
    writer = frame_store.FrameWriter(sink, 2, 100)
    for i, ids in enumerate(docs):
        writer.add(None if i == 3 else i, ids)
    writer.close()
    data = sink.getvalue().to_pybytes()
    reader = frame_store.FrameReader(pa.BufferReader(data))
    assert reader.doc_ids == [0, 1, 2, None, 4, 5, 6, 7]
    assert all(np.array_equal(reader.document(i), d) for i, d in enumerate(docs))
    # Any zstandard reader skips the directory and the seek table.
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == np.concatenate(docs).astype("<u2").tobytes()
    # Damage in a frame that is not asked for goes unread; in one that is, it shows.
    broken = bytearray(data)
    broken[reader._starts[5] + 20] ^= 0xFF
    reader = frame_store.FrameReader(pa.BufferReader(bytes(broken)))
    assert np.array_equal(reader.document(0), docs[0])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.document(7)


def test_files_of_odd_documents(spark, tokenizer, run_dir):
    rows = odd_rows()
    manifest = frame_store.write_token_files(frame(spark, rows), run_dir, file_ids=5000)
    assert manifest.count() >= 3
    found = sorted(frame_store.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id or -1, r.ids) for r in found) == sorted(
        (i or -1, [*whole(tokenizer, t), 2]) for i, t in rows
    )
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    ids = [r.doc_id for r in found if r.doc_id is not None]
    assert ids == sorted(ids) and [r.doc_id for r in found][:2] == [None, None]
    some = frame_store.read_tokens(manifest, [8, 11]).collect()
    assert sorted(r.doc_id for r in some) == [8, 11]


def test_files_of_nothing(spark, run_dir):
    manifest = frame_store.write_token_files(frame(spark, []), run_dir)
    assert manifest.count() == 0 and frame_store.read_tokens(manifest).count() == 0


def test_width_follows_the_ids(spark, run_dir):
    docs = frame(spark, [(1, prose(1, 20))])
    manifest = frame_store.write_token_files(docs, run_dir, end_id=70000)
    assert frame_store.read_tokens(manifest).first().ids[-1] == 70000
    with pytest.raises(ValueError, match="65536 does not fit 2 bytes"):
        frame_store.FrameWriter(io.BytesIO()).add(1, np.array([3, 1 << 16], "<u4"))
    frame_store.FrameWriter(io.BytesIO()).add(1, np.array([3, (1 << 16) - 1], "<u4"))


def test_wide_ids(spark, run_dir):
    manifest = frame_store.write_token_files(frame(spark, [(1, prose(1, 20))]), run_dir, end_id=70000, width=4)
    assert frame_store.read_tokens(manifest).first().ids[-1] == 70000
