"""A stream of range-stamped Parquet files whose offset is the last block read.

Register ``BlockPolls`` with ``spark.dataSource.register`` and read
``spark.readStream.format("block_polls").schema(...).load(folder)`` with the options

- ``prefix``: stamped files are ``prefix[_yymmdd]_from_to.parquet``, a file or a folder;
- ``from_block``: the first block wanted, 0 if not given;
- ``block_column``: ``block_number`` if not given;
- ``slice_mb``: input of one task, 128 if not given.

A poll takes every whole block between the last poll's and the largest in a name. Each
block comes from one file, the first in block order that holds it, so files may overlap;
a block that a file brings after the poll passed it is not read again. Only names and
sizes are listed by the driver; footers and rows are read by tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from logtide.sources.files import STAMP

SLICE_MB = 128


def _file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def claims(stamped: list[tuple[int, int, str]], start: int, end: int) -> list[tuple[int, int, str]]:
    """Blocks after ``start`` up to ``end`` that each (from, to, name) is to deliver.

    No block is in two claims, and each that a file with ``to`` up to ``end`` holds is
    in one. Files that reach beyond ``end`` came later and wait for the next poll.
    """
    found, position = [], start
    for low, high, name in sorted((f, -t, n) for f, t, n in stamped if t <= end):
        first, last = max(low, position + 1), -high
        if first <= last:
            found.append((first, last, name))
            position = last
    return found


@dataclass
class Slice(InputPartition):
    """Row groups ``number``, ``number + slices``, ... of a file, and the blocks wanted."""

    path: str
    first: int
    last: int
    number: int
    slices: int


class BlockPolls(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_polls"

    def schema(self):
        raise ValueError("block_polls needs a schema: readStream.schema(...)")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return BlockPollReader(schema, dict(self.options.items()))


class BlockPollReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        lowered = {key.lower(): value for key, value in options.items()}
        self.folder = lowered["path"].rstrip("/")
        self.stamp = re.compile(re.escape(lowered["prefix"]) + STAMP)
        self.before = int(lowered.get("from_block", 0)) - 1
        self.column = lowered.get("block_column", "block_number")
        self.slice_bytes = int(lowered.get("slice_mb", SLICE_MB)) << 20
        self.spark_schema = schema

    def _stamped(self) -> list[tuple[int, int, str]]:
        from pyarrow import fs

        system, folder = _file_system(self.folder)
        listed = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        matches = [self.stamp.fullmatch(info.base_name) for info in listed]
        return [(int(m[2]), int(m[3]), m[0]) for m in matches if m]

    def initialOffset(self) -> dict:
        return {"block": self.before}

    def latestOffset(self) -> dict:
        return {"block": max([self.before, *(high for _, high, _ in self._stamped())])}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        from pyarrow import fs

        system, folder = _file_system(self.folder)
        found = []
        for first, last, name in claims(self._stamped(), start["block"], end["block"]):
            at = f"{folder}/{name}"
            info = system.get_file_info(at)
            parts = [info] if info.is_file else system.get_file_info(fs.FileSelector(at, recursive=True))
            for part in parts:
                if part.is_file and not part.base_name.startswith(("_", ".")):
                    slices = max(1, -(-part.size // self.slice_bytes))
                    found += [Slice(part.path, first, last, n, slices) for n in range(slices)]
        return found

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.spark_schema)
        system, _ = _file_system(self.folder)
        with system.open_input_file(partition.path) as stream:
            file = pq.ParquetFile(stream)
            at = file.schema_arrow.get_field_index(self.column)
            groups = [
                g for g in range(partition.number, file.num_row_groups, partition.slices)
                if _may_hold(file.metadata.row_group(g).column(at).statistics, partition)
            ]
            wanted = list(dict.fromkeys([*schema.names, self.column]))
            for batch in file.iter_batches(row_groups=groups, columns=wanted):
                blocks = batch.column(self.column)
                inside = pc.and_(
                    pc.greater_equal(blocks, partition.first), pc.less_equal(blocks, partition.last)
                )
                rows = pa.Table.from_batches([batch]).filter(inside).select(schema.names).cast(schema)
                yield from rows.to_batches()


def _may_hold(statistics, partition: Slice) -> bool:
    if statistics is None or not statistics.has_min_max:
        return True
    return statistics.max >= partition.first and statistics.min <= partition.last
