"""Words, word hashes and window hashes as numpy arrays, for use inside tasks.

Words of a text are maximal runs of bytes other than 0x20 and 0x09-0x0D, which is
what ``bytes.split()`` yields. A word is known by its 64-bit hash, a window of
words by a polynomial over those hashes modulo 2^64.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Input of groups after which a task gives freed memory back.
RELEASE_BYTES = 8 << 20
BASE_1, BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hash of each word's bytes. Hashing anew is faster than looking words up."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


class WindowHashes:
    """Polynomial hashes of all windows of a fixed width in a word sequence."""

    def __init__(self, base: int):
        self._base = np.uint64(base | 1)
        self._inverse = np.uint64(pow(base | 1, -1, 1 << 64))
        self._up = self._down = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self._up):
            size = max(n, 2 * len(self._up))
            for name, factor in (("_up", self._base), ("_down", self._inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def at(self, words: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
        n = len(words)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self._up[:n], out=sums[1:])
        return mixed((sums[starts + width] - sums[starts]) * self._down[starts])


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names whatever else is there.

    ``row_fp`` tells rows apart that repeat an id with another text.
    """
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row_fp"),
        text.alias("text"),
    )


def unused(columns: list[str], stem: str) -> str:
    """A beginning that no column name has, whatever its case."""
    while any(c.lower().startswith(stem) for c in columns):
        stem = f"_{stem}"
    return stem


def _stage() -> int | None:
    context = TaskContext.get()
    return None if context is None else context.stageId()


def stage_memo(name, make: Callable):
    """An object that the tasks of one stage share in a Python worker.

    The package comes to tasks by value, anew each time, so the object is kept under a
    module name of its own.
    """
    if _stage() is None:
        return make()
    forget_other_stages()
    kept = sys.modules["_stage_memo"].__dict__["objects"]
    if name not in kept:
        kept[name] = make()
    return kept[name]


def forget_other_stages() -> None:
    """Lets go of what tasks of another stage left in this worker."""
    module = sys.modules.setdefault("_stage_memo", types.ModuleType("_stage_memo"))
    if module.__dict__.get("stage") != _stage():
        module.stage, module.objects = _stage(), {}


def release_memory() -> None:
    """Gives what a task has freed back to the system.

    Python workers outlive their tasks, and the allocators keep freed memory: without
    this an idle worker holds a few hundred megabytes beside the next stage.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of one group that gives freed memory back when it ends.

    Small groups do so together: once they have brought ``RELEASE_BYTES``.
    """
    held = 0

    def run(table: pa.Table) -> pa.Table:
        nonlocal held
        forget_other_stages()
        held += table.nbytes
        result = function(table)
        del table
        if held >= RELEASE_BYTES:
            release_memory()
            held = 0
        return result

    return run


def arrow_map(df: DataFrame, function, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a generator of plain column dictionaries.

    ``function`` gets the record batches of a task and yields dictionaries of
    column name to list or array.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_other_stages()
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[field.name], type=field.type) for field in arrow], schema=arrow
            )
            columns = None
        release_memory()

    return df.mapInArrow(run, schema)
