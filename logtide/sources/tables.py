"""Keyed Parquet tables: delete+insert and insert-if-absent by partition overwrite.

A table is two plain Parquet folders::

    rows/bucket=<n>/part-....parquet       the rows, by block range or key hash
    places/<key>/part-....parquet          key hash and bucket of every row

``places`` tells where a key may stand: 16 bytes per row, read instead of the key
columns of the table. Every write adds its places before its rows, and none are taken
away but by ``compact``, so the buckets found for a key are always all that hold it,
however far apart, and at worst a few more. Only the first write of a table puts its rows
first and reads the places off them; until they are there they count as missing. A write that replaces rows reads these
buckets and those of the batch, and puts them back with Spark's dynamic partition
overwrite; a write of new keys only appends. Spark moves the new partitions in when all
tasks have ended: a write that dies before leaves the old rows, and a write that is
repeated gives the same table. Places are of the key that the table is opened with: a
write under another key drops them, and they are made anew from the rows when needed.
One writer per table; readers open it between writes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.joins import broadcast_if_small, lookup_keys
from logtide.schemas import check_schema
from logtide.session import new_run_dir
from logtide.sources import storage

BUCKET = "bucket"
_HASH = "key_hash"
_PLACES = T.StructType([T.StructField(_HASH, T.LongType()), T.StructField(BUCKET, T.LongType())])
_NO_BUCKET = "__HIVE_DEFAULT_PARTITION__"
# Fixed numbers: up to so many ranges stand for a list of buckets, and up to so many
# folders are listed one by one instead of all at once.
MAX_RUNS = 16
MAX_LISTED = 32
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING = Lock()


def block_buckets(blocks_per_bucket: int, column: str = "block_number") -> Column:
    return F.floor(F.col(column) / blocks_per_bucket)


def hash_buckets(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _in_buckets(buckets: Iterable[int | None]) -> Column:
    """Rows of the buckets; neighbours are told by their ends, where that is shorter."""
    numbers = sorted(b for b in buckets if b is not None)
    runs: list[list[int]] = []
    for number in numbers:
        if runs and number <= runs[-1][1] + 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    if 0 < len(runs) <= MAX_RUNS < len(numbers):
        found = reduce(lambda a, b: a | b, [F.col(BUCKET).between(*run) for run in runs])
    else:
        found = F.col(BUCKET).isin(numbers) if numbers else F.lit(False)
    return found | F.col(BUCKET).isNull() if None in buckets else found


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders listed in a few tasks a core, not in a task each."""
    with _LISTING:
        before = spark.conf.get(_LISTING_TASKS)
        wanted = max(64, 4 * spark.sparkContext.defaultParallelism)
        spark.conf.set(_LISTING_TASKS, min(int(before), wanted))
        try:
            yield
        finally:
            spark.conf.set(_LISTING_TASKS, before)


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: list[str],
        bucket: Column,
        sort_by: Iterable[str] = (),
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.bucket = bucket
        self.sort_by = list(sort_by)
        self._stored = T.StructType(self.schema.fields + [T.StructField(BUCKET, T.LongType())])
        self._rows = f"{self.root}/rows"
        self._places = f"{self.root}/places/{'+'.join(self.keys)}"

    # --- reading -----------------------------------------------------------

    def exists(self) -> bool:
        """Whether the table was ever written, be it without rows."""
        return storage.exists(self.spark, self._rows)

    def buckets(self) -> list[int | None]:
        """Buckets that have rows, in order; rows without one come last."""
        prefix = f"{BUCKET}="
        names = [n[len(prefix):] for n in storage.list_names(self.spark, self._rows) if n.startswith(prefix)]
        return sorted((None if n == _NO_BUCKET else int(n) for n in names), key=lambda b: (b is None, b))

    def _open(self) -> DataFrame:
        """All rows with their bucket."""
        if not self.exists():
            return self.spark.createDataFrame([], self._stored)
        with _few_listing_tasks(self.spark):
            return self.spark.read.schema(self._stored).parquet(self._rows)

    def read(self, from_bucket: int | None = None, to_bucket: int | None = None) -> DataFrame:
        """All rows, or those of a range of buckets, either end open."""
        rows = self._open()
        if from_bucket is not None:
            rows = rows.where(F.col(BUCKET) >= from_bucket)
        if to_bucket is not None:
            rows = rows.where(F.col(BUCKET) <= to_bucket)
        return rows.select(*self.schema.fieldNames())

    def high_water(self, column: str) -> int:
        """Largest value of a column that grows with the bucket, 0 when empty.

        Only the last bucket is read.
        """
        numbered = [b for b in self.buckets() if b is not None]
        if not numbered:
            return 0
        rows = self._open().where(F.col(BUCKET) == numbered[-1])
        return rows.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]

    def holding(self, keys: DataFrame) -> list[int | None]:
        """Buckets that hold one of the keys, and at worst a few more.

        Eight bytes per key make a broadcast of millions of keys small, and a shuffle,
        where there are more, narrow. Bucket numbers come to the driver, no keys.
        """
        if not self.keys or not self.exists():
            return []
        self._ready_places()
        wanted = lookup_keys(keys.select(F.xxhash64(*self.keys).alias(_HASH)))
        places = self.spark.read.schema(_PLACES).parquet(self._places)
        return [r[0] for r in places.join(wanted, _HASH, "left_semi").select(BUCKET).distinct().collect()]

    def matching(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is among the keys, from the buckets that may hold them."""
        rows = self._open().where(_in_buckets(self.holding(keys)))
        wanted = lookup_keys(keys.select(*self.keys))
        return rows.join(wanted, self.keys, "left_semi").select(*self.schema.fieldNames())

    def within(self, buckets: list[int | None]) -> DataFrame:
        """All rows of some buckets."""
        return self._open().where(_in_buckets(buckets)).select(*self.schema.fieldNames())

    # --- writing -----------------------------------------------------------

    def _bucketed(self, batch: DataFrame) -> DataFrame:
        return check_schema(batch, self.schema).withColumn(BUCKET, self.bucket.cast("long"))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows by bucket. The rebalance hint lets adaptive execution cut a bucket that
        holds most of the batch into several tasks and join the small ones."""
        rows = rows.select(*self._stored.fieldNames()).hint("rebalance", BUCKET)
        return rows.sortWithinPartitions(BUCKET, *self.sort_by) if self.sort_by else rows

    def _put(self, rows: DataFrame, mode: str) -> None:
        """``append`` rows, or ``overwrite`` the buckets that they are in."""
        writer = self._dealt(rows).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self._rows)

    def _add_places(self, rows: DataFrame, mode: str = "append") -> None:
        for name in storage.list_names(self.spark, f"{self.root}/places"):
            if name != "+".join(self.keys):
                storage.delete(self.spark, f"{self.root}/places/{name}")
        if self.keys:
            if mode == "append":
                self._ready_places()
            self._write_places(rows, mode)

    def _write_places(self, rows: DataFrame, mode: str) -> None:
        # Copies of a key in a bucket stay: nothing is shuffled to find them.
        rows.select(F.xxhash64(*self.keys).alias(_HASH), BUCKET).write.mode(mode).parquet(self._places)

    def _ready_places(self) -> None:
        """Places of the rows that are there, if a write under another key left none."""
        if self.exists() and not storage.exists(self.spark, f"{self._places}/_SUCCESS"):
            self._write_places(self._open(), "overwrite")

    def _staged(self, batch: DataFrame) -> tuple[DataFrame, str, int]:
        """The batch written beside the table, so that the steps of a write see the same
        rows and compute them once; where, and how many."""
        path = new_run_dir(self.spark, "batch")
        self._bucketed(batch).write.parquet(path)
        rows = self.spark.read.schema(self._stored).parquet(path)
        return rows, path, rows.count()

    def _first(self, batch: DataFrame) -> int:
        """The rows of a table that is not there, written once; the rows added."""
        storage.delete(self.spark, f"{self.root}/places")
        self._put(self._bucketed(batch), "append")
        rows = self._open()
        if self.keys:
            self._write_places(rows, "overwrite")
            rows = self.spark.read.schema(_PLACES).parquet(self._places)
        return rows.count()

    def append(self, batch: DataFrame) -> int:
        """Add rows without looking at keys; the rows added."""
        if not self.exists():
            return self._first(batch)
        rows, path, added = self._staged(batch)
        if added:
            self._add_places(rows)
            self._put(rows, "append")
        storage.delete(self.spark, path)
        return added

    def replace(self, batch: DataFrame) -> int:
        """Make the batch the whole table; the rows written."""
        if not self.exists():
            return self._first(batch)
        rows, path, written = self._staged(batch)
        # First the places of old and new rows, at last those of the new ones alone.
        self._add_places(rows)
        self._dealt(rows).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            BUCKET
        ).parquet(self._rows)
        self._add_places(rows, "overwrite")
        storage.delete(self.spark, path)
        return written

    def upsert(self, batch: DataFrame, also_delete: DataFrame | None = None) -> int:
        """Delete every row with a key of the batch, then insert the batch.

        Rows of the batch that share a key all stay, as in a delete followed by
        an insert. NULL keys match nothing. ``also_delete`` holds further keys
        whose rows go. Returns the rows inserted.
        """
        return self.merge(batch, None, also_delete)

    def merge(
        self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame] | None,
        also_delete: DataFrame | None = None,
    ) -> int:
        """Put ``combine(new, old)`` in the place of the rows with a key of the batch.

        ``old`` are the rows with a key of the batch, wherever they stand, and ``new`` the
        rows of the batch with their keys; what comes back has to be rows of either. Rows
        of the batch with a key that the table does not have go in as they are. Rows of
        ``also_delete`` go. Without ``combine`` the batch goes in as it is. The touched
        buckets are read once and written once. Returns the rows of the batch.
        """
        if not self.exists():
            return self._first(batch)
        new, path, added = self._staged(batch)
        keys = new.select(*self.keys)
        gone = keys if also_delete is None else keys.unionByName(also_delete.select(*self.keys))
        touched = self.holding(gone)
        if touched:
            filled = [r[0] for r in new.select(BUCKET).distinct().collect()]
            self._add_places(new)
            self._rewrite(touched, list({*touched, *filled}), new, keys, gone, combine)
        elif added:
            self._add_places(new)
            self._put(new, "append")
        storage.delete(self.spark, path)
        return added

    def _rewrite(
        self, touched: list[int | None], buckets: list[int | None], new: DataFrame, keys: DataFrame,
        gone: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame] | None,
    ) -> None:
        names = self._stored.fieldNames()
        opened = self._open()
        stored = opened.where(_in_buckets(buckets))
        rows = stored.join(lookup_keys(gone), self.keys, "left_anti").select(*names)
        if combine is None:
            rows = rows.unionByName(new.select(*names))
        else:
            holding = opened.where(_in_buckets(touched))
            old = holding.join(lookup_keys(keys), self.keys, "left_semi").select(*names)
            known = broadcast_if_small(old.select(*self.keys).distinct())
            met = new.join(known, self.keys, "left_semi").select(*names)
            unmet = new.join(known, self.keys, "left_anti").select(*names)
            rows = rows.unionByName(unmet).unionByName(combine(met, old))
        # Rows go from touched buckets alone, so no other can be left without rows.
        before = self._files_of(touched)
        self._put(rows, "overwrite")
        after = self._files_of(touched)
        for bucket, files in before.items():
            # A bucket that has no rows left is not overwritten.
            if files and after[bucket] == files:
                storage.delete(self.spark, self._folder(bucket))

    def _folder(self, bucket: int | None) -> str:
        return f"{self._rows}/{BUCKET}={_NO_BUCKET if bucket is None else bucket}"

    def _files(self, bucket: int | None) -> list[str]:
        return storage.list_names(self.spark, self._folder(bucket))

    def _files_of(self, buckets: list[int | None]) -> dict[int | None, list[str]]:
        """Files of each bucket. Many folders are listed in one call."""
        if len(buckets) <= MAX_LISTED:
            return {b: self._files(b) for b in buckets}
        listed = self.spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", self._open()._jdf.inputFiles())
        found: dict[str, list[str]] = {}
        for path in filter(None, listed.split("\n")):
            folder, name = path.split("/")[-2:]
            found.setdefault(folder, []).append(name)
        return {b: sorted(found.get(self._folder(b).rsplit("/", 1)[1], [])) for b in buckets}

    def insert_absent(self, batch: DataFrame) -> int:
        """Insert the rows whose key is not in the table; the rows inserted.

        The batch must hold each key once (see ``first_by_key``). The key columns are
        read only where a key of the batch may stand.
        """
        rows, path, added = self._staged(batch)
        buckets = self.holding(rows)
        if buckets:
            known = self._open().where(_in_buckets(buckets)).select(*self.keys)
            known = known.join(broadcast_if_small(rows.select(*self.keys)), self.keys, "left_semi")
            fresh, fresh_path, added = self._staged(rows.join(known, self.keys, "left_anti").drop(BUCKET))
        else:
            fresh, fresh_path = rows, path
        if added or not self.exists():
            self._add_places(fresh)
            self._put(fresh, "append")
        for used in {path, fresh_path}:
            storage.delete(self.spark, used)
        return added

    def compact(self) -> int:
        """Merge the files of buckets that have several, and the places; how many buckets."""
        spread = [b for b in self.buckets() if sum(n.endswith(".parquet") for n in self._files(b)) > 1]
        if spread:
            self._put(self._open().where(_in_buckets(spread)), "overwrite")
            self._add_places(self._open(), "overwrite")
        return len(spread)
