"""Best-two-fit packing of token sequences.

A bin is filled greedily with the longest piece that fits, again and again. Then
its smallest piece may give way to two unpacked pieces that fill the widened gap
more tightly. Pieces of the full length are bins of their own. The others are
dealt by a hash into groups of bounded size, and each group is packed from the
counts of its lengths, so all choices depend on lengths alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.tokens import Encoder, tokenizer_path
from logtide.llm.words import arrow_map, keyed, released

SEQUENCE_TOKENS = 2048
GROUP_PIECES = 100_000
_PIECES = (
    "doc_id long, row_fp long, row_no long, piece int, start long, length long, ids_crc32 long"
)
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    size: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``size`` ids; only longer documents are cut.

    A document is its ids and then ``end_id``; a null or empty text has the end id
    alone. The first piece of a longer one takes what is left over, the others are
    full. ``with_ids`` adds the ids themselves.
    """
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches):
        encoder = Encoder(path)
        row_no = 0
        for batch in batches:
            rows: dict[str, list] = {name.split()[0]: [] for name in schema.split(", ")}
            for doc_id, row_fp, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                begin, stop, piece = 0, (n - 1) % size + 1, 0
                row_no += 1
                while begin < n:
                    part = ids[4 * begin : 4 * stop]
                    values = (doc_id, row_fp, row_no, piece, begin, stop - begin, zlib.crc32(part))
                    for name, value in zip(rows, values, strict=False):
                        rows[name].append(value)
                    if with_ids:
                        rows["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
                    begin, stop, piece = stop, stop + size, piece + 1
            yield rows

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return arrow_map(keyed(docs, id_col, text_col), pieces, schema)


class _Lengths:
    """How many pieces of each length are unpacked, with fast search downwards."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.tolist()
        self.mask = sum(1 << i for i, n in enumerate(self.counts) if n)

    def longest(self, limit: int) -> int:
        """The longest unpacked length up to ``limit``, or 0."""
        within = self.mask & ((2 << limit) - 1) if limit > 0 else 0
        return within.bit_length() - 1 if within else 0

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            self.mask &= ~(1 << length)

    def put(self, length: int) -> None:
        self.counts[length] += 1
        self.mask |= 1 << length

    def tightest_pair(self, gap: int, above: int) -> tuple[int, int] | None:
        """Two unpacked lengths with the largest sum over ``above`` and up to ``gap``."""
        best, found = above, None
        first = self.longest(gap - 1)
        while first > 0 and 2 * first > best:
            again = self.counts[first] > 1
            second = self.longest(min(gap - first, first if again else first - 1))
            if second > 0 and first + second > best:
                best, found = first + second, (first, second)
                if best == gap:
                    break
            first = self.longest(first - 1)
        return found


def plan_bins(lengths: np.ndarray, size: int) -> Iterator[list[int]]:
    """Lengths of each bin, in the order of filling. Lengths are 1 to ``size``."""
    free = _Lengths(np.bincount(lengths, minlength=size + 1))
    while free.mask:
        bin_, gap = [], size
        while length := free.longest(gap):
            free.take(length)
            bin_.append(length)
            gap -= length
        if gap:
            smallest = bin_[-1]
            pair = free.tightest_pair(gap + smallest, smallest)
            if pair:
                bin_.pop()
                for length in pair:
                    free.take(length)
                    bin_.append(length)
                free.put(smallest)
                gap += smallest - sum(pair)
                while length := free.longest(gap):
                    free.take(length)
                    bin_.append(length)
                    gap -= length
        yield bin_


def assign_bins(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset in the bin of every piece."""
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(size + 2))
    next_of = first.tolist()
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, bin_ in enumerate(plan_bins(lengths, size)):
        offset = 0
        for length in bin_:
            row = order[next_of[length]]
            next_of[length] += 1
            bins[row], offsets[row] = number, offset
            offset += length
    return bins, offsets


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with its sequence and its place there, gapless from 0.

    The number of groups follows the number of pieces, about ``group_pieces`` in
    each, so a group fits a task at any input size and wastes at most part of one
    sequence. Repeated documents are separate pieces. No pieces give no rows.
    """
    total = pieces.count()
    groups = max(1, -(-total // group_pieces))
    dealt = pieces.withColumn(
        "pack_group",
        F.pmod(F.xxhash64("doc_id", "row_fp", "row_no", "piece"), F.lit(groups)),
    )

    def place(table: pa.Table) -> pa.Table:
        rows = table.sort_by(
            [(c, "ascending") for c in ("length", "doc_id", "piece", "row_fp", "row_no")]
        )
        bins, offsets = assign_bins(rows["length"].to_numpy(), size)
        sequence = rows["pack_group"].to_numpy() * (1 << 32) + bins
        return pa.table(
            [
                *(rows[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                pa.array(sequence, pa.int64()),
                pa.array(offsets, pa.int64()),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )

    return dealt.groupBy("pack_group").applyInArrow(released(place), _PLACED)
