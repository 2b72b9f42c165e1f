"""Removal of repeated word windows, found through difference-cover anchors.

A difference cover of a period holds, for every two positions, an offset that takes
both of them to cover positions. So if two documents share ``WINDOW`` words, at
whatever places, there is an anchor, a shorter window at a cover position of both,
inside the match. Only anchors at cover positions are hashed and compared, six in
31 words. Around anchors that another document has too, the match is extended:
the full windows there are compared, and all words of a window that also starts in
a document with a smaller id are removed.

Hashes are compared in buckets. A task compares its own documents first and sends
each hash once or, if it met the hash in one document only, with its places; so a
passage that many documents share costs a bucket one entry per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import (
    BASE_1,
    BASE_2,
    WindowHashes,
    arrow_map,
    keyed,
    mixed,
    released,
    utf8,
    word_hashes,
)
from logtide.llm.workspace import Workspace

WINDOW = 50
# A perfect difference set modulo 31.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
FLUSH_KEYS = 500_000
BUCKET_KEYS = 500_000
NO_ID = (1 << 63) - 1
_BLOCK = (
    "bucket int, key1 binary, key2 binary, doc binary, place binary,"
    " known_doc binary, known_place binary, doc_ids binary, row_fps binary"
)
_REPLY = "block int, doc_ids binary, row_fps binary, counts binary, places binary"
_PLACES = "doc_id long, row_fp long, places binary"


def _small(values: np.ndarray) -> bytes:
    """Numbers of 0 and more in as few bytes each as hold them; the first byte says how many."""
    size = next(n for n in (1, 2, 4) if not len(values) or int(values.max()) < 1 << 8 * n)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _group_starts(order: np.ndarray, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
    a, b = key1[order], key2[order]
    return np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


def _decide(key1, key2, ids, later: bool):
    """Sorted order, group number of each sorted row, its group's smallest and
    largest id, and the verdict: in another document too, or in an earlier one."""
    order = np.lexsort((key2, key1)) if len(key2) else np.argsort(key1, kind="stable")
    starts = _group_starts(order, key1, key2 if len(key2) else key1)
    sorted_ids = ids[order]
    low, high = np.minimum.reduceat(sorted_ids, starts), np.maximum.reduceat(sorted_ids, starts)
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
    verdict = sorted_ids > low[group] if later else (low != high)[group]
    return order, group, starts, low, high, verdict


class _Sender:
    """Collects hashes of a task's documents and cuts them into bucket rows."""

    def __init__(self, buckets: int, later: bool):
        self._buckets, self._later = buckets, later
        self._clear()

    def _clear(self) -> None:
        self._docs: list[tuple[int, int]] = []
        self._parts: list[tuple] = []
        self.held = 0

    def add(self, doc_id, row_fp, key1, key2, places) -> None:
        number = len(self._docs)
        self._docs.append((NO_ID if doc_id is None else doc_id, row_fp))
        # 96 bits of a window's hashes go out.
        key2 = key2.astype(np.uint32)
        self._parts.append((key1, key2, np.full(len(key1), number, np.uint32), places.astype(np.int32)))
        self.held += len(key1)

    def rows(self) -> Iterator[dict]:
        if not self.held:
            self._clear()
            return
        key1, key2, doc, place = (np.concatenate(x) for x in zip(*self._parts, strict=True))
        doc_ids = np.array([d for d, _ in self._docs], np.int64)
        row_fps = np.array([f for _, f in self._docs], np.int64)
        order, group, starts, low, high, known = _decide(key1, key2, doc_ids[doc], self._later)
        # Groups with a verdict already: one entry each for their two extreme ids.
        marked = np.unique(group[known])
        number_of = {}
        for n, d in enumerate(doc_ids.tolist()):
            number_of.setdefault(d, n)
        marks = np.array(
            [number_of[d] for ends in (low, high) for d in ends[marked].tolist()], np.uint32
        )
        at = order[starts[np.r_[marked, marked]]]
        sent = order[~known]
        key1_out, key2_out = np.r_[key1[sent], key1[at]], (np.r_[key2[sent], key2[at]] if len(key2) else key2)
        doc_out = np.r_[doc[sent], marks]
        place_out = np.r_[place[sent], np.full(len(marks), -1, np.int32)]
        bucket = (key1_out % np.uint64(self._buckets)).astype(np.int64)
        pairs = np.unique(
            (doc[order[known]].astype(np.int64) << 32) | place[order[known]].astype(np.int64)
        )
        known_doc, known_place = (pairs >> 32).astype(np.uint32), (pairs & 0xFFFFFFFF).astype(np.int32)
        known_bucket = (
            (doc_ids[known_doc].astype(np.uint64) * np.uint64(BASE_1)) >> np.uint64(20)
        ) % np.uint64(self._buckets)
        known_bucket = known_bucket.astype(np.int64)
        by, by_known = np.argsort(bucket, kind="stable"), np.argsort(known_bucket, kind="stable")
        filled = np.unique(np.r_[bucket, known_bucket])
        cut, cut_known = (
            np.searchsorted(x, np.r_[filled, self._buckets]) for x in (bucket[by], known_bucket[by_known])
        )
        for n, b in enumerate(filled.tolist()):
            mine, theirs = by[cut[n] : cut[n + 1]], by_known[cut_known[n] : cut_known[n + 1]]
            used = np.unique(np.r_[doc_out[mine], known_doc[theirs]])
            yield {
                "bucket": [b],
                "key1": [key1_out[mine].tobytes()],
                "key2": [key2_out[mine].tobytes() if len(key2) else b""],
                "doc": [_small(np.searchsorted(used, doc_out[mine]))],
                "place": [_small(place_out[mine] + 1)],
                "known_doc": [_small(np.searchsorted(used, known_doc[theirs]))],
                "known_place": [_small(known_place[theirs])],
                "doc_ids": [doc_ids[used].tobytes()],
                "row_fps": [row_fps[used].tobytes()],
            }
        self._clear()


def _runs(ids: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Where each document begins in sorted columns, and the end."""
    if not len(ids):
        return np.zeros(1, np.int64)
    fresh = (ids[1:] != ids[:-1]) | (fps[1:] != fps[:-1])
    return np.flatnonzero(np.r_[True, fresh, True])


def _compare(blocks: DataFrame, buckets: int, later: bool) -> DataFrame:
    """Places with the verdict, one row per document that has some.

    Buckets answer in blocks of documents, so that what goes back is as compact as
    what came.
    """

    def bucket(table: pa.Table) -> pa.Table:
        columns = {name: table[name].to_pylist() for name in table.column_names if name != "bucket"}

        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(columns[name]), kind)

        doc_ids, row_fps = joined("doc_ids", np.int64), joined("row_fps", np.int64)
        base = np.cumsum([0] + [len(x) // 8 for x in columns["doc_ids"]])[:-1]

        def numbers(name: str, first=base) -> np.ndarray:
            return np.concatenate([_large(x) + b for x, b in zip(columns[name], first, strict=True)])

        doc, place = numbers("doc"), numbers("place", [-1] * len(base)).astype(np.int32)
        known_doc = numbers("known_doc")
        known_place = numbers("known_place", [0] * len(base)).astype(np.int32)
        if len(doc):
            key1, key2 = joined("key1", np.uint64), joined("key2", np.uint32)
            order, *_, verdict = _decide(key1, key2, doc_ids[doc], later)
            hit = order[verdict]
            hit = hit[place[hit] >= 0]
            known_doc, known_place = np.r_[known_doc, doc[hit]], np.r_[known_place, place[hit]]
        ids, fps = doc_ids[known_doc], row_fps[known_doc]
        number = (mixed(ids.astype(np.uint64) ^ mixed(fps.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((known_place, fps, ids, number))
        number, ids, fps, places = number[order], ids[order], fps[order], known_place[order]
        out: dict[str, list] = {name.split()[0]: [] for name in _REPLY.split(", ")}
        edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True]) if len(number) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            runs = _runs(ids[a:b], fps[a:b])
            values = (
                int(number[a]), ids[a:b][runs[:-1]].tobytes(), fps[a:b][runs[:-1]].tobytes(),
                np.diff(runs).astype(np.uint32).tobytes(), places[a:b].tobytes(),
            )
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.table(
            {n: pa.array(v, pa.int32() if n == "block" else pa.binary()) for n, v in out.items()}
        )

    def block(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        counts = joined("counts", np.uint32).astype(np.int64)
        ids, fps = (np.repeat(joined(n, np.int64), counts) for n in ("doc_ids", "row_fps"))
        places = joined("places", np.int32)
        order = np.lexsort((places, fps, ids))
        ids, fps, places = ids[order], fps[order], places[order]
        runs = _runs(ids, fps)
        return pa.table(
            {
                "doc_id": pa.array(ids[runs[:-1]], pa.int64()),
                "row_fp": pa.array(fps[runs[:-1]], pa.int64()),
                "places": pa.array(
                    [np.unique(x).tobytes() for x in np.split(places, runs[1:-1])], pa.binary()
                ),
            }
        )

    answers = blocks.groupBy("bucket").applyInArrow(released(bucket), _REPLY)
    return answers.groupBy("block").applyInArrow(released(block), _PLACES)


def _anchors(docs: DataFrame, buckets: int, window: int) -> DataFrame:
    width = window - PERIOD + 1

    def send(batches) -> Iterator[dict]:
        hashes, sender = WindowHashes(BASE_1), _Sender(buckets, later=False)
        none = np.empty(0, np.uint64)
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        for batch in batches:
            ids, fps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, row_fp, text in zip(ids, fps, utf8(batch.column(2)), strict=True):
                words = text.split() if text else []
                if len(words) < window:
                    continue
                at = np.arange(len(words) - width + 1)
                at = at[cover[at % PERIOD]]
                sender.add(doc_id, row_fp, hashes.at(word_hashes(words), width, at), none, at)
                if sender.held >= FLUSH_KEYS:
                    yield from sender.rows()
        yield from sender.rows()

    return arrow_map(docs, send, _BLOCK)


def _packed(docs: DataFrame) -> DataFrame:
    """Texts packed one by one for the shuffles; they take less than half the room."""

    def pack(batches) -> Iterator[dict]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield {
                "doc_id": batch.column(0), "row_fp": batch.column(1),
                "packed": [packer.compress(text) for text in utf8(batch.column(2))],
            }

    return arrow_map(docs, pack, "doc_id long, row_fp long, packed binary")


def _extended(candidates: DataFrame, buckets: int, window: int) -> DataFrame:
    width = window - PERIOD + 1

    def send(batches) -> Iterator[dict]:
        sender = _Sender(buckets, later=True)
        first, second = WindowHashes(BASE_1), WindowHashes(BASE_2)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_id, row_fp, packed, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_hashes(unpacker.decompress(packed).split())
                anchors = np.frombuffer(places, np.int32)
                # A window holds an anchor that starts up to window - width after it.
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, np.maximum(anchors - (window - width), 0), 1)
                np.add.at(change, anchors + 1, -1)
                starts = np.flatnonzero(np.cumsum(change[: len(words) - window + 1]) > 0)
                if len(starts):
                    sender.add(
                        doc_id, row_fp, first.at(words, window, starts),
                        second.at(words, window, starts), starts,
                    )
                if sender.held >= FLUSH_KEYS:
                    yield from sender.rows()
        yield from sender.rows()

    return arrow_map(candidates, send, _BLOCK)


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Packed documents that have places; rows without an id go under ``NO_ID``."""
    known = places.select(
        F.col("doc_id").alias("place_id"), F.col("row_fp").alias("place_fp"), "places"
    )
    same = (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("place_id")) & (
        F.col("row_fp") == F.col("place_fp")
    )
    rows = docs.select("doc_id", "row_fp", "packed")
    return rows.join(known, same).select("doc_id", "row_fp", "packed", "places")


def covered_spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Merged word ranges, end exclusive, of windows at sorted starts."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(starts[1:] > starts[:-1] + window) + 1
    firsts, lasts = starts[np.r_[0, breaks]], starts[np.r_[breaks - 1, len(starts) - 1]]
    return list(zip(firsts.tolist(), (lasts + window).tolist(), strict=True))


def repeated_spans(
    docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Documents with repeated windows: id, row hash, text and word spans to remove.

    Spans are merged ranges of word numbers, end exclusive, of all windows whose
    words also start in a document with a smaller id. Words are runs of characters
    other than white space (0x20, 0x09-0x0D), compared as they are. Null and empty
    texts, and texts shorter than a window, have none. A row without an id counts
    as the last document. Rows that repeat an id never remove each other's words;
    a repeated row is here as often as it is there. The smallest id keeps its words, so no passage is
    lost from the corpus. Windows are judged on the input.
    """
    if window < PERIOD:
        raise ValueError(f"windows of at least {PERIOD} words")
    rows = keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size * len(COVER) // (6 * PERIOD * BUCKET_KEYS)))
    shared = _compare(_anchors(rows, buckets, window), buckets, later=False)
    # A window of words takes two bytes a word but for the last.
    long_enough = rows.where(F.octet_length("text") >= 2 * window - 1)
    candidates = work.saved(_with_places(_packed(long_enough), shared), "candidates")
    starts = _compare(_extended(candidates, buckets, window), buckets, later=True)

    def spans(batches) -> Iterator[dict]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            yield {
                "doc_id": batch.column(0), "row_fp": batch.column(1),
                "text": [unpacker.decompress(packed).decode() for packed in batch.column(2).to_pylist()],
                "spans": [
                    [
                        {"first": a, "last": b}
                        for a, b in covered_spans(
                            np.frombuffer(places, np.int32).astype(np.int64), window
                        )
                    ]
                    for places in batch.column(3).to_pylist()
                ],
            }

    return arrow_map(
        _with_places(candidates, starts), spans,
        "doc_id long, row_fp long, text string, spans array<struct<first:int,last:int>>",
    )


def kept_words(words: list, spans: list[dict]) -> list:
    kept, at = [], 0
    for span in spans:
        kept += words[at : span["first"]]
        at = span["last"]
    return kept + words[at:]


_WORD = re.compile(rb"[^ \t-\r]+")


def without_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["first"]][0]])
        at = places[span["last"] - 1][1]
    return b"".join([*kept, text[at:]])
