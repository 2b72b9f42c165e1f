"""Benchmark decontamination with an FM-index per shard of training documents.

A task gathers documents into shards of words. Words that no test phrase has can be
in no occurrence, so a shard is the runs of the other words, each ended by a
terminator of its own. Its FM-index has the Burrows-Wheeler transform in a wavelet
matrix with rank sums and the suffix positions at every few text places. Test
phrases are found by backward search, all of a shard at once; occurrences are
located by walking to a sampled position, and the spans of a document are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import arrow_map, utf8, word_hashes
from logtide.llm.workspace import Workspace

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE = 16
# Benchmark words that one broadcast holds at most, at about 24 bytes each.
PASS_WORDS = 2_000_000
# Fixed rule: words are runs of 0-9, a-z and everything from 0x80 on, A-Z lowered.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_SPANS = "array<struct<first:int,last:int>>"


def bench_words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes, by doubling the compared length."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        sorted_key = key[order]
        fresh = np.zeros(n, np.int64)
        fresh[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
        rank[order] = fresh
        if fresh[-1] == n - 1 or width >= n:
            return order
        width *= 2


class WaveletMatrix:
    """Rank of any symbol at any position, one bit level at a time."""

    def __init__(self, values: np.ndarray, symbols: int):
        self._levels = max(1, int(symbols - 1).bit_length())
        self._ones, self._zeros = [], []
        for level in reversed(range(self._levels)):
            bits = (values >> level) & 1
            self._ones.append(np.concatenate([[0], np.cumsum(bits)]).astype(np.int32))
            self._zeros.append(len(values) - int(self._ones[-1][-1]))
            values = np.concatenate([values[bits == 0], values[bits == 1]])
        counts = np.bincount(values, minlength=symbols)
        # Where the run of a symbol begins after the last level.
        self._begin = np.zeros(symbols, np.int64)
        at = 0
        order = sorted(range(symbols), key=lambda s: int(f"{s:0{self._levels}b}"[::-1], 2))
        for s in order:
            self._begin[s] = at
            at += counts[s]

    def rank(self, symbols: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        at = positions.astype(np.int64)
        for k, level in enumerate(reversed(range(self._levels))):
            ones = self._ones[k][at]
            at = np.where((symbols >> level) & 1, self._zeros[k] + ones, at - ones)
        return at - self._begin[symbols]


class FMIndex:
    """Index of a sequence of symbols from 1 on, with 0 as terminator."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        n = len(text)
        ends = text == 0
        terminators = int(ends.sum())
        distinct = text.astype(np.int64) + terminators
        distinct[ends] = np.arange(terminators)
        order = suffix_array(distinct)
        self._bwt = text[order - 1]
        self._wavelet = WaveletMatrix(self._bwt, symbols)
        self._before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        begins = np.zeros(n, bool)
        begins[0] = True
        begins[1:] = ends[:-1]
        sampled = (order % sample == 0) | begins[order]
        self._sampled = sampled
        self._place = np.concatenate([[0], np.cumsum(sampled)])
        self._positions = order[sampled]

    def _back(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self._before[symbols] + self._wavelet.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that start with each phrase (equal lengths)."""
        last = phrases[:, -1]
        low, high = self._before[last], self._before[last + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            low, high = self._back(phrases[:, k], low), self._back(phrases[:, k], high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        found = np.empty(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            here = rows[waiting]
            known = self._sampled[here]
            found[waiting[known]] = self._positions[self._place[here[known]]] + steps
            waiting = waiting[~known]
            if len(waiting):
                here = here[~known]
                rows = rows.copy()
                rows[waiting] = self._back(self._bwt[here], here)
            steps += 1
        return found


def phrases_of(items: list[tuple[str | None, bytes | None]], window: int) -> SimpleNamespace:
    """The words of the items one after the other, and the windows in them.

    ``starts`` and ``items`` have, per window length, where each window begins and
    the place in ``ids`` of whose it is, so the size does not depend on the window.
    """
    parts, starts, owners, at = [], {}, {}, 0
    for number, (_, text) in enumerate(items):
        words = word_hashes(bench_words(text))
        if len(words):
            width = min(window, len(words))
            found = np.arange(at, at + len(words) - width + 1)
            starts.setdefault(width, []).append(found)
            owners.setdefault(width, []).append(np.full(len(found), number, np.int64))
            parts.append(words)
            at += len(words)
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    vocabulary, numbers = np.unique(words, return_inverse=True)
    return SimpleNamespace(
        lengths=sorted(starts),
        numbers=numbers.astype(np.int32),
        starts={n: np.concatenate(x) for n, x in starts.items()},
        items={n: np.concatenate(x) for n, x in owners.items()},
        ids=[item_id for item_id, _ in items],
        vocabulary=vocabulary,
    )


def _runs(known: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` true values."""
    edge = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_enough = ends - starts >= least
    return starts[long_enough], ends[long_enough]


def shard_hits(docs: list[np.ndarray], phrases: SimpleNamespace) -> Iterator[tuple[int, int, int, int]]:
    """Occurrences in a shard: document number, first word, length, place of the item."""
    if not phrases.lengths or not docs:
        return
    vocabulary = phrases.vocabulary
    sizes = np.array([len(d) for d in docs])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = np.concatenate(docs)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = vocabulary[at] == words
    # No occurrence goes over the end of a document: it is followed by an unknown word.
    gap = offsets[:-1] + np.arange(len(docs))
    place = np.arange(len(words)) + np.repeat(np.arange(len(docs)), sizes)
    spread = np.zeros(len(words) + len(docs), bool)
    spread[place] = known
    symbol = np.zeros(len(spread), np.int64)
    symbol[place] = at + 1
    starts, ends = _runs(spread, phrases.lengths[0])
    if not len(starts):
        return
    lengths = ends - starts + 1
    text_starts = np.cumsum(lengths) - lengths
    source = np.repeat(starts - text_starts, lengths) + np.arange(lengths.sum())
    text = symbol[np.minimum(source, len(symbol) - 1)]
    text[text_starts + lengths - 1] = 0
    # Symbols that occur, in dense numbers.
    occurring = np.unique(text)
    text = np.searchsorted(occurring, text)
    index = FMIndex(text, len(occurring))
    # Dense numbers of the benchmark's words, and how many before each are not here.
    wanted = phrases.numbers + 1
    dense = np.minimum(np.searchsorted(occurring, wanted), len(occurring) - 1)
    absent = np.concatenate([[0], np.cumsum(occurring[dense] != wanted)])
    for n in phrases.lengths:
        starts, items = phrases.starts[n], phrases.items[n]
        present = absent[starts + n] == absent[starts]
        starts, items = starts[present], items[present]
        if not len(starts):
            continue
        low, high = index.search(dense[starts[:, None] + np.arange(n)])
        counts = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        located = source[index.locate(rows)]
        number = np.searchsorted(gap, located, "right") - 1
        first = located - gap[number]
        hit = np.repeat(items, counts)
        for d, f, item in zip(number.tolist(), first.tolist(), hit.tolist(), strict=True):
            yield d, f, n, item


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"]:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def _passes(
    benchmark: DataFrame, item_col: str, text_col: str, window: int, pass_words: int, null_ids: bool
):
    """The benchmark in blocks whose phrases fit a broadcast, and whether more follow."""
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("string").alias("item_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).where("text IS NOT NULL" if null_ids else "item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word takes two bytes of text at least.
    blocks = max(1, -(-size // (2 * pass_words)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.where(part == block).collect() if blocks > 1 else items.collect()
        yield phrases_of([(r.item_id, r.text.encode()) for r in rows], window), block + 1 < blocks


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pass_words: int = PASS_WORDS,
    shard_words: int = SHARD_WORDS,
    prefix: str = "bench_",
    cut_col: str | None = None,
    null_ids: bool = False,
    work: Workspace | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, merged hit ``spans`` and the sorted ``items`` that hit.

    The new columns carry ``prefix``. A window is ``window`` consecutive words of an
    item, or all words of a shorter one; items without words are left out. Those without
    an id are searched only with ``null_ids``; together they are one null, the last of
    ``items``, which are strings. Spans are word numbers, end exclusive. Null and empty texts have no words. Repeated
    rows and ids are independent. Nothing is shuffled. Test phrases go out in blocks
    of bounded size, one at a time: with more than one, what a block found is written
    to ``work`` and its phrases are dropped before the next goes out. ``cut_col`` names one more column: the text without the
    spans where there are some, else null.
    """
    spark = docs.sparkSession
    names = [f"{prefix}n_words", f"{prefix}spans", f"{prefix}items"]
    clash = {c.lower() for c in docs.columns} & {*names, cut_col}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already; choose another prefix")
    text_at = docs.columns.index(text_col)
    cut = [F.lit(None).cast("string").alias(cut_col)] if cut_col else []
    found = docs.select(
        "*", *cut, F.lit(0).cast("long").alias(names[0]),
        F.array().cast(_SPANS).alias(names[1]), F.array().cast("array<string>").alias(names[2]),
    )
    passes = _passes(benchmark, item_col, item_text_col, window, pass_words, null_ids)
    for number, (phrases, more) in enumerate(passes):
        shared = spark.sparkContext.broadcast(phrases)

        def search(batches, shared=shared) -> Iterator[dict]:
            phrases = shared.value
            held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
            size = 0

            def flush() -> Iterator[dict]:
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                for d, first, n, item in shard_hits([w for _, ws in held for w in ws], phrases):
                    spans.setdefault(d, []).append((first, first + n))
                    items.setdefault(d, set()).add(phrases.ids[item])
                base = 0
                for batch, words in held:
                    old_spans, old_items = batch.column(-2).to_pylist(), batch.column(-1).to_pylist()
                    numbers = range(base, base + len(words))
                    out = dict(zip(batch.schema.names, batch.columns, strict=True))
                    out[names[0]] = [len(w) for w in words]
                    out[names[1]] = [
                        merged([(s["first"], s["last"]) for s in old] + spans.get(d, []))
                        for d, old in zip(numbers, old_spans, strict=True)
                    ]
                    out[names[2]] = [
                        sorted(items.get(d, set()).union(old), key=lambda i: (i is None, i or ""))
                        for d, old in zip(numbers, old_items, strict=True)
                    ]
                    if cut_col:
                        out[cut_col] = [
                            without_spans(t, s).decode() if s else None
                            for t, s in zip(utf8(batch.column(text_at)), out[names[1]], strict=True)
                        ]
                    base += len(words)
                    yield out

            for batch in batches:
                for lo in range(0, batch.num_rows, 1000):
                    part = batch.slice(lo, 1000)
                    words = [word_hashes(bench_words(t)) for t in utf8(part.column(text_at))]
                    held.append((part, words))
                    size += sum(map(len, words))
                    if size >= shard_words:
                        yield from flush()
                        held, size = [], 0
            yield from flush()

        found = arrow_map(found, search, found.schema)
        if more:
            work = work or Workspace(spark, "decontaminate")
            found = work.saved(found, f"pass-{number}")
            shared.unpersist()
            if number:
                work.drop(f"pass-{number - 1}")
    return found


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def without_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.lower())]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["first"]][0]])
        at = places[span["last"] - 1][1]
    return b"".join([*kept, text[at:]])
