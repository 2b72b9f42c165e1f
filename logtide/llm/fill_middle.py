"""Fill-in-the-middle: a text is cut at two unit ends and its parts change places.

The cuts are given as numbers of units. A text's bytes are divided into blocks of a
fixed size; two Fenwick trees over the blocks hold how many units end and how many
code points start in each. A binary-lifting descent from the highest power of two
finds the block in which a unit ends and counts the code points before it on the way;
only inside that block is the boundary looked for byte by byte.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import arrow_map, keyed, utf8

BLOCK_BYTES = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("line", "char")
_MADE = (
    "doc_id long, row_fp long, n_units long, form string, prefix_chars long, middle_chars long,"
    " output string"
)


def _fenwick(counts: np.ndarray) -> list[int]:
    """Entry ``i`` holds the sum of the ``i & -i`` counts up to the ``i``-th."""
    sums = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(len(sums))
    return (sums - sums[at - (at & -at)]).tolist()


class BlockCounts:
    """Where the units of a text end, in bytes and code points."""

    def __init__(self, text: bytes, unit: str = "line", block: int = BLOCK_BYTES):
        self._block = block
        self._size = len(text)
        data = np.frombuffer(text, np.uint8)
        self._starts = (data & 0xC0) != 0x80
        if unit == "line":
            self._ends = data == 0x0A
        else:
            self._ends = np.append(self._starts[1:], True) if len(data) else self._starts
        if len(data) and not self._ends[-1]:
            self._ends[-1] = True
        edges = np.arange(0, len(data), block)
        ends, starts = (
            np.add.reduceat(flags, edges, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
            for flags in (self._ends, self._starts)
        )
        self.n_units = int(ends.sum())
        self._ends_tree, self._starts_tree = _fenwick(ends), _fenwick(starts)

    def after(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units <= 0:
            return 0, 0
        if units > self.n_units:
            raise ValueError(f"the text has {self.n_units} units, not {units}")
        block, left, chars = 0, units, 0
        step = 1 << (len(self._ends_tree).bit_length() - 1)
        while step:
            further = block + step
            if further < len(self._ends_tree) and self._ends_tree[further] < left:
                block, left, chars = (
                    further, left - self._ends_tree[further], chars + self._starts_tree[further]
                )
            step >>= 1
        first = block * self._block
        inside = int(np.flatnonzero(self._ends[first : first + self._block])[left - 1]) + 1
        return first + inside, chars + int(np.count_nonzero(self._starts[first : first + inside]))


def check_sentinels(*sentinels: str) -> None:
    """Refuses sentinels of which one could begin inside another: with such, text
    beside a sentinel could be read as part of one."""
    for one in sentinels:
        for other in sentinels:
            if not one or (one is not other and one in other):
                raise ValueError("a sentinel is empty or part of another")
            if any(one.endswith(other[:n]) for n in range(1, min(len(one), len(other)))):
                raise ValueError(f"{other!r} could begin inside {one!r}")


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document; a null id counts as an empty one."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return tuple(int(digest[n : n + 8], 16) for n in range(0, 32, 8))


def fill_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
    seed: int = 7, fim_percent: int = 100, spm_percent: int = 50,
    prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE,
) -> DataFrame:
    """Every document with its parts in their new order.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or
    ``plain``, the text as it is: empty and null texts, texts that hold a sentinel, and
    those that ``fim_percent`` leaves out. The two cuts, the share and the order follow
    from ``seed`` and the id alone, so rows that repeat an id get the same numbers, each
    for its own text. ``unit`` is ``line`` (up to and with a line feed; the last may lack
    it) or ``char``. ``n_units`` counts them in every form; ``prefix_chars`` and
    ``middle_chars`` are code points, null if plain. A null id counts as an empty one.
    Whole texts are cut, of any length; other columns are left out, so no name clashes.
    Nothing is shuffled.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    check_sentinels(prefix, suffix, middle)
    p, s, m = (x.encode() for x in (prefix, suffix, middle))

    def made(doc_id: int | None, text: bytes) -> tuple:
        counts = BlockCounts(text, unit)
        one, two, share, order = draws(seed, doc_id)
        if not text or p in text or s in text or m in text or share % 100 >= fim_percent:
            return counts.n_units, "plain", None, None, text
        ends = (one % (counts.n_units + 1), two % (counts.n_units + 1))
        (a, a_chars), (b, b_chars) = counts.after(min(ends)), counts.after(max(ends))
        if order % 100 < spm_percent:
            form, parts = "spm", (s, text[b:], p, text[:a], m, text[a:b])
        else:
            form, parts = "psm", (p, text[:a], s, text[b:], m, text[a:b])
        return counts.n_units, form, a_chars, b_chars - a_chars, b"".join(parts)

    def make(batches) -> Iterator[dict]:
        names = [field.split()[0] for field in _MADE.split(", ")][2:]
        for batch in batches:
            rows = [
                made(doc_id, text or b"")
                for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(2)), strict=True)
            ]
            columns = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}
            columns["output"] = [x.decode() for x in columns["output"]]
            yield columns | {"doc_id": batch.column(0), "row_fp": batch.column(1)}

    return arrow_map(keyed(docs, id_col, text_col), make, _MADE)


def restored(
    output: Column, form: Column, prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE
) -> Column:
    """The text that an output and its form were made from."""

    def halves(text: Column, sentinel: str) -> Column:
        return F.split(text, re.escape(sentinel), 2)

    psm = halves(F.substring(output, len(prefix) + 1, 1 << 30), suffix)
    psm_rest = halves(psm[1], middle)
    spm = halves(F.substring(output, len(suffix) + 1, 1 << 30), prefix)
    spm_rest = halves(spm[1], middle)
    return (
        F.when(form == "psm", F.concat(psm[0], psm_rest[1], psm_rest[0]))
        .when(form == "spm", F.concat(spm_rest[0], spm_rest[1], spm[0]))
        .otherwise(output)
    )
