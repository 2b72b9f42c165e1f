"""File sources, file bookkeeping and file sinks."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import POLL_LIMIT
from logtide.functions.columns import megabytes_text
from logtide.schemas import EVENT_SIGNATURES, INDEXER_FIELDS, INDEXER_RECORD, RAW_LOGS
from logtide.sources import storage

POLL_SLOTS = 1000
# Fixed format: prefix[_yymmdd]_<from block>_<to block>.parquet
STAMP = r"(?:_(\d{6}))?_(\d+)_(\d+)\.parquet"


# --- scans -----------------------------------------------------------------


def scan_logs(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw logs with the fixed schema; lineage columns are kept where present."""
    stored = spark.read.parquet(*paths).schema.fieldNames()
    lineage = [T.StructField(n, T.StringType()) for n in ("_dlt_load_id", "_dlt_id") if n in stored]
    return spark.read.schema(T.StructType(RAW_LOGS.fields + lineage)).parquet(*paths)


def scan_signatures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=EVENT_SIGNATURES, header=True, escape='"')


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a ``.csv`` or ``.parquet`` path; any other ending is an error."""
    if path.endswith(".csv"):
        return spark.read.csv(path, schema=schema, header=True, inferSchema=schema is None)
    if path.endswith(".parquet"):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    raise ValueError(f"cannot load {path}: expected a .csv or .parquet file")


def json_records(
    responses: DataFrame,
    table: str,
    record: T.StructType = INDEXER_RECORD,
    text: str = "value",
) -> DataFrame:
    """Records of ``data.<table>`` in saved JSON responses, one row each.

    A response with ``errors`` or without the table fails the job; an empty list
    gives no rows.
    """
    body = T.StructType(
        [
            T.StructField("errors", T.StringType()),
            T.StructField("data", T.StructType([T.StructField(table, T.ArrayType(record))])),
        ]
    )
    parsed = responses.select(F.from_json(text, body).alias("response"))
    errors, rows = F.col("response.errors"), F.col(f"response.data.{table}")
    checked = (
        F.when(
            errors.isNotNull(),
            F.raise_error(F.concat(F.lit("response with errors: "), errors)),
        )
        .when(rows.isNull(), F.raise_error(F.lit(f"the response has no list '{table}'")))
        .otherwise(rows)
    )
    return parsed.select(F.inline(checked))


def rename_indexer_fields(records: DataFrame) -> DataFrame:
    return records.select(*[F.col(f"`{src}`").alias(dst) for src, dst in INDEXER_FIELDS.items()])


# --- reading by block ------------------------------------------------------


def block_range(
    df: DataFrame, from_block: int | None = None, to_block: int | None = None,
    column: str = "block_number",
) -> DataFrame:
    """Rows of an inclusive block range, either end open."""
    if from_block is not None:
        df = df.where(F.col(column) >= from_block)
    if to_block is not None:
        df = df.where(F.col(column) <= to_block)
    return df


def block_of_row(df: DataFrame, number: int, column: str = "block_number") -> int | None:
    """The block that holds the ``number``-th row in block order; the last block
    when there are fewer rows, None when there are none.

    Rows are counted in at most ``POLL_SLOTS`` equal slots of the block range,
    and the slot that holds the row is looked at again, until it is one block.
    Neither sorting nor a single task ever sees the rows.
    """
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not rows or rows <= number:
        return high
    before = 0
    while low < high:
        width = -(-(high - low + 1) // POLL_SLOTS)
        slot = F.floor((F.col(column) - low) / width).alias("slot")
        counted = df.where(F.col(column).between(low, high)).groupBy(slot).count()
        for at, count in sorted(tuple(row) for row in counted.collect()):
            if before + count >= number:
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
                break
            before += count
    return low


def poll_after(
    df: DataFrame, last_block: int | None, limit: int = POLL_LIMIT, column: str = "block_number"
) -> DataFrame:
    """The next rows after ``last_block``: about ``limit``, but whole blocks only.

    The limit names the last block to fetch, and that block is then read to its
    end; a poll that goes on from its largest block misses nothing.
    """
    newer = df if last_block is None else df.where(F.col(column) > last_block)
    cut = block_of_row(newer, limit, column)
    return newer.limit(0) if cut is None else newer.where(F.col(column) <= cut)


def latest_record(df: DataFrame, column: str = "block_number", tie: str = "id") -> DataFrame:
    return df.orderBy(F.col(column).desc(), F.col(tie).desc()).limit(1)


def block_extent(df: DataFrame, column: str = "block_number") -> DataFrame:
    return df.agg(
        F.min(column).alias("min_block"),
        F.max(column).alias("max_block"),
        F.count("*").alias("row_count"),
    )


def block_extent_of_files(spark: SparkSession, *paths: str, column: str = "block_number") -> DataFrame:
    """``block_extent`` of Parquet files from their footers alone; no row is read.

    Spark answers smallest, largest and count from footer statistics with the second
    version of its Parquet reader, which is asked for in a session of its own. Files
    without rows have no statistics; where the footers do not tell, rows are read.
    """
    own = spark.newSession()
    others = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in others if x.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        low, high, rows = block_extent(own.read.parquet(*paths), column).first()
    except PySparkException:
        return block_extent(spark.read.parquet(*paths), column)
    return spark.createDataFrame([(low, high, rows or 0)], "min_block long, max_block long, row_count long")


def schema_drift(spark: SparkSession, paths: list[str], expected: T.StructType, threads: int = 16) -> DataFrame:
    """How the columns of stored files differ from a schema, one row per difference.

    ``problem`` is ``missing``, ``unexpected`` or ``changed``. The schema of each path, a
    file or a folder written at once, is read from one footer; columns go by name,
    whatever their order or nullability. Paths that agree give no row.
    """
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}

    def differences(path: str) -> list[tuple]:
        stored = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
        found = []
        for name in sorted({*wanted, *stored}):
            told, real = wanted.get(name), stored.get(name)
            if told != real:
                problem = "missing" if real is None else "unexpected" if told is None else "changed"
                found.append((path.rsplit("/", 1)[-1], name, problem, told, real))
        return found

    with ThreadPoolExecutor(threads) as pool:
        rows = [row for found in pool.map(inheritable_thread_target(spark)(differences), paths) for row in found]
    return spark.createDataFrame(
        rows, "file string, column_name string, problem string, expected_type string, found_type string"
    )


# --- range-stamped files ---------------------------------------------------


def stamped_name(prefix: str, from_block: int, to_block: int, day: date | None = None) -> str:
    stamp = f"_{day:%y%m%d}" if day else ""
    return f"{prefix}{stamp}_{from_block}_{to_block}.parquet"


def range_stamped_write(
    df: DataFrame, folder: str, prefix: str, day: date | None = None,
    column: str = "block_number",
) -> dict | None:
    """Write ``df`` once and name the result by the block range it holds.

    The range is observed during the write itself, so nothing is read twice.
    None when there was no row.
    """
    spark = df.sparkSession
    seen = Observation()
    draft = f"{folder}/_incoming_{uuid.uuid4().hex}"
    df.observe(
        seen,
        F.min(column).alias("from_block"),
        F.max(column).alias("to_block"),
        F.count(F.lit(1)).alias("row_count"),
    ).write.parquet(draft)
    extent = seen.get
    if not extent.get("row_count"):
        storage.delete(spark, draft)
        return None
    name = stamped_name(prefix, extent["from_block"], extent["to_block"], day)
    if storage.exists(spark, f"{folder}/{name}"):
        raise FileExistsError(f"{folder}/{name}")
    storage.rename(spark, draft, f"{folder}/{name}")
    return {"path": f"{folder}/{name}", **extent}


def file_inventory(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Range-stamped files of a prefix, from their names alone.

    The listing is Spark's: ``binaryFile`` without its content column opens no
    file. A stamped name may be a file or a folder of part files.
    """
    schema = "file string, file_date string, from_block long, to_block long"
    names = storage.list_names(spark, folder)
    if not any(re.fullmatch(re.escape(prefix) + STAMP, n) for n in names):
        return spark.createDataFrame([], schema)
    name = F.regexp_extract("path", rf"/({re.escape(prefix)}{STAMP})(?:/|$)", 1)
    pattern = f"^{re.escape(prefix)}{STAMP}$"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{folder}/{prefix}_*")
        .select(name.alias("file"))
        .where(F.col("file") != "")
        .distinct()
    )

    def part(group: int) -> Column:
        return F.regexp_extract("file", pattern, group)

    return files.select(
        "file",
        F.nullif(part(1), F.lit("")).alias("file_date"),
        part(2).cast("long").alias("from_block"),
        part(3).cast("long").alias("to_block"),
    )


def latest_fetched_block(spark: SparkSession, folder: str, prefix: str) -> int | None:
    """Largest block of the stamped files; None when there are none."""
    return file_inventory(spark, folder, prefix).agg(F.max("to_block")).first()[0]


def next_start_block(
    spark: SparkSession, folder: str, prefix: str, from_block: int | None = None
) -> int:
    """Where the next fetch starts: one after the last block already on file."""
    if from_block is not None:
        return from_block
    last = latest_fetched_block(spark, folder, prefix)
    if last is None:
        raise ValueError(f"no files for prefix '{prefix}' in {folder}: give from_block")
    return last + 1


def latest_file(inventory: DataFrame) -> DataFrame:
    """The newest dated file by (date, last block); one row, or none."""
    newest = F.max(F.struct("file_date", "to_block", "from_block", "file")).alias("newest")
    return (
        inventory.where(F.col("file_date").isNotNull())
        .agg(newest)
        .where(F.col("newest").isNotNull())
        .select("newest.file", "newest.file_date", "newest.from_block", "newest.to_block")
    )


# --- messages and catalogs -------------------------------------------------


def encode_messages(events: DataFrame, key: str = "id") -> DataFrame:
    """Key and JSON value of each row, as a message sink wants them.

    NULL fields are written out, so that every message has all its fields.
    """
    body = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    return events.select(F.col(key).alias("key"), body.alias("value"))


def doc_catalog(metadata: DataFrame) -> DataFrame:
    """Document metadata with the file size as readable text."""
    if "file_size" not in metadata.columns:
        return metadata
    return metadata.withColumn("file_size", megabytes_text(F.col("file_size")))


def _doc_records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Parsed documents with ``readable``; an unreadable record keeps its text."""
    fields = T.StructType.fromDDL(
        "title string, id string, language string, file_path string, "
        "file_size long, created_at string"
    )
    with_text = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=multi_line)
    parsed = F.from_json(
        "value", with_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return lines.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"), parsed.alias("doc")
    ).withColumn("readable", F.col("doc._corrupt_record").isNull())


def read_doc_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Document metadata below ``path``: one JSON file per document, or JSON lines.

    Unreadable records are in ``unreadable_doc_metadata``.
    """
    records = _doc_records(spark, path, multi_line).where("readable")
    return records.select("doc.*").drop("_corrupt_record")


def unreadable_doc_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """File and text of the records that ``read_doc_metadata`` leaves out."""
    return _doc_records(spark, path, multi_line).where("NOT readable").select("file", "record")
