"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds the ids of consecutive documents. Every ``FRAME_IDS`` ids are one
zstandard frame of unsigned 16- or 32-bit little-endian values. A skippable frame
then lists the documents: ids, missing-id flags and end positions. The last
skippable frame is a seek table: compressed size, decompressed size and the low
32 bits of the XXH64 of each frame, the number of frames, a flag byte and a magic
number. A reader of one document decompresses the frames it lies in, and checks
their sums.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.llm.tokens import Encoder, largest_id, tokenizer_path
from logtide.llm.words import arrow_map, keyed

FRAME_IDS = 1 << 16
FILE_IDS = 1 << 26
# Skippable frame magics, seek table magic, checksum flag.
_DIRECTORY_MAGIC, _SEEK_MAGIC, _FOOTER_MAGIC, _HAS_CHECKSUMS = (
    0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80,
)
_HEAD, _FOOTER, _DIRECTORY = "<II", "<IBI", "<QIB"
_ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_MANIFEST = "path string, n_docs long, n_ids long, first_doc long, first_fp long"


class FrameWriter:
    """Writes documents in the given order to a binary stream."""

    def __init__(self, stream, width: int = 2, frame_ids: int = FRAME_IDS):
        self._out, self._dtype, self._frame_ids = stream, np.dtype(f"<u{width}"), frame_ids
        self._zstd = zstandard.ZstdCompressor(level=3)
        self._parts: list[np.ndarray] = []
        self._held = self.n_ids = 0
        self._doc_ids: list[int | None] = []
        self._ends: list[int] = []
        self._frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and ids.max() > np.iinfo(self._dtype).max:
            raise ValueError(f"id {ids.max()} does not fit {self._dtype.itemsize} bytes")
        self._doc_ids.append(doc_id)
        self.n_ids += len(ids)
        self._ends.append(self.n_ids)
        self._parts.append(ids.astype(self._dtype))
        self._held += len(ids)
        if self._held >= self._frame_ids:
            held = np.concatenate(self._parts)
            full = len(held) - len(held) % self._frame_ids
            for lo in range(0, full, self._frame_ids):
                self._write(held[lo : lo + self._frame_ids].tobytes())
            self._parts, self._held = [held[full:]], len(held) - full

    def _write(self, raw: bytes) -> None:
        packed = self._zstd.compress(raw)
        self._out.write(packed)
        self._frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self._held:
            self._write(np.concatenate(self._parts).tobytes())
        ids = np.array([d or 0 for d in self._doc_ids], "<i8")
        known = np.array([d is not None for d in self._doc_ids], "u1")
        directory = self._zstd.compress(
            struct.pack(_DIRECTORY, len(ids), self._frame_ids, self._dtype.itemsize)
            + ids.tobytes() + np.array(self._ends, "<u8").tobytes() + known.tobytes()
        )
        self._out.write(struct.pack(_HEAD, _DIRECTORY_MAGIC, len(directory)) + directory)
        table = np.array(self._frames, _ENTRY).tobytes() + struct.pack(
            _FOOTER, len(self._frames), _HAS_CHECKSUMS, _FOOTER_MAGIC
        )
        self._out.write(struct.pack(_HEAD, _SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents by their number from a seekable binary file."""

    def __init__(self, file):
        self._file = file
        footer = struct.calcsize(_FOOTER)
        footer_at = file.size() - footer
        n_frames, flags, magic = struct.unpack(_FOOTER, self._at(footer_at, footer))
        if magic != _FOOTER_MAGIC or flags != _HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        table = n_frames * _ENTRY.itemsize
        self._frames = np.frombuffer(self._at(footer_at - table, table), _ENTRY)
        self._starts = np.concatenate([[0], np.cumsum(self._frames["compressed"], dtype=np.int64)])
        head = struct.calcsize(_HEAD)
        directory_at = int(self._starts[-1])
        _, directory = struct.unpack(_HEAD, self._at(directory_at, head))
        self._zstd = zstandard.ZstdDecompressor()
        raw = self._zstd.decompress(self._at(directory_at + head, directory))
        n, self._frame_ids, width = struct.unpack_from(_DIRECTORY, raw)
        self._dtype, begin = np.dtype(f"<u{width}"), struct.calcsize(_DIRECTORY)
        ids = np.frombuffer(raw, "<i8", n, begin).tolist()
        self.ends = np.frombuffer(raw, "<u8", n, begin + 8 * n).astype(np.int64)
        known = np.frombuffer(raw, "u1", n, begin + 16 * n).tolist()
        self.doc_ids = [d if k else None for d, k in zip(ids, known, strict=True)]
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self._last: tuple[int, np.ndarray] = (-1, np.empty(0, self._dtype))

    def _at(self, offset: int, size: int) -> bytes:
        self._file.seek(offset)
        return self._file.read(size)

    def _frame(self, number: int) -> np.ndarray:
        if self._last[0] != number:
            entry = self._frames[number]
            raw = self._zstd.decompress(
                self._at(int(self._starts[number]), int(entry["compressed"])),
                max_output_size=int(entry["size"]),
            )
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != entry["checksum"]:
                raise ValueError(f"frame {number} does not match its checksum")
            self._last = (number, np.frombuffer(raw, self._dtype))
        return self._last[1]

    def document(self, number: int) -> np.ndarray:
        begin, end = int(self.starts[number]), int(self.ends[number])
        parts, size = [], self._frame_ids
        for k in range(begin // size, -(-end // size) if end > begin else begin // size):
            parts.append(self._frame(k)[max(0, begin - k * size) : end - k * size])
        return np.concatenate(parts) if parts else np.empty(0, self._dtype)


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    directory: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    width: int | None = None,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode, append ``end_id``, and write files in ascending order of the id.

    Returns the manifest, written below ``directory``: one row per file with
    ``base``, the number of ids in all files before. Rows without an id come
    first, rows with the same id follow each other in the order of their text
    hash, a null or empty text has the end id alone. A task writes under a new
    name each time it runs and only files of tasks that ended are in the
    manifest, so a repeated task does no harm. ``width`` is 2 or 4 bytes an id: by
    default 2 if every id of the tokenizer and ``end_id`` fit. One that does not fit a
    given width is refused.
    """
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    if width is None:
        width = 2 if max(largest_id(path), end_id) < 1 << 16 else 4
    ordered = (
        keyed(docs, id_col, text_col)
        .repartitionByRange("doc_id", "row_fp")
        .sortWithinPartitions("doc_id", "row_fp")
    )
    end = np.array([end_id], "<u4")

    def write(batches) -> Iterator[dict]:
        encoder, writer, head = Encoder(path), None, None
        filesystem, root = _opened(directory)
        filesystem.create_dir(root, recursive=True)

        def finish() -> dict:
            writer.close()
            stream.close()
            filesystem.move(f"{root}/.{name}", f"{root}/{name}")
            return {
                "path": [f"{directory}/{name}"], "n_docs": [n_docs], "n_ids": [writer.n_ids],
                "first_doc": [head[0]], "first_fp": [head[1]],
            }

        for batch in batches:
            for doc_id, row_fp, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name, n_docs, head = f"tokens-{uuid.uuid4().hex}.zst", 0, (doc_id, row_fp)
                    stream = filesystem.open_output_stream(f"{root}/.{name}", compression=None)
                    writer = FrameWriter(stream, width)
                ids = np.concatenate([np.frombuffer(encoder.encode(text), "<u4"), end])
                writer.add(doc_id, ids)
                n_docs += 1
                if writer.n_ids >= file_ids:
                    yield finish()
                    writer = None
        if writer is not None:
            yield finish()

    arrow_map(ordered, write, _MANIFEST).write.parquet(f"{directory}/manifest")
    return read_manifest(spark, directory)


def read_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """The files in order, with the number of ids before each."""
    before = Window.orderBy("first_doc", "first_fp", "path").rowsBetween(
        Window.unboundedPreceding, -1
    )
    files = spark.read.schema(_MANIFEST).parquet(f"{directory}/manifest")
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents read back from the files: start, number of ids, CRC-32, ids.

    With ``doc_ids`` only those documents are decompressed.
    """
    wanted = None if doc_ids is None else set(doc_ids)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def read(batches) -> Iterator[dict]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                filesystem, name = _opened(path)
                with filesystem.open_input_file(name) as file:
                    reader = FrameReader(file)
                    numbers = [
                        i for i, d in enumerate(reader.doc_ids) if wanted is None or d in wanted
                    ]
                    for lo in range(0, len(numbers), 500):
                        some = numbers[lo : lo + 500]
                        found = [reader.document(i).astype("<u4") for i in some]
                        rows = {
                            "doc_id": [reader.doc_ids[i] for i in some],
                            "start": base + reader.starts[some],
                            "n_tokens": [len(ids) for ids in found],
                            "ids_crc32": [zlib.crc32(ids.tobytes()) for ids in found],
                        }
                        if with_ids:
                            rows["ids"] = [ids.astype(np.int32) for ids in found]
                        yield rows

    tasks = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return arrow_map(manifest.select("path", "base").repartition(tasks, "path"), read, schema)
