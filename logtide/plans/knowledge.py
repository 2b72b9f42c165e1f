"""Documents -> chunks -> vectors in a collection -> search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import EMBED_BATCH, PARAGRAPH_SEPARATOR, SEARCH_LIMIT
from logtide.operators.chunking import (
    EmbedFunction,
    chunk_documents,
    embed_chunks,
    load_results,
    resume_chunks,
)
from logtide.operators.vector_search import search_filter, vector_top_k
from logtide.session import new_run_dir
from logtide.sources.tables import KeyedTable, hash_buckets

COLLECTION = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("document_id", T.StringType()),
        T.StructField("document_title", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stage", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("char_count", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
    ]
)
HIT_COLUMNS = ["score", *[n for n in COLLECTION.fieldNames() if n != "vector"]]


def collection_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    keys = ["chunk_id"]
    return KeyedTable(spark, root, COLLECTION, keys, hash_buckets(keys, buckets))


def load_collection(
    collection: KeyedTable,
    documents: DataFrame,
    embed: EmbedFunction,
    resume: bool = True,
    separator: str = PARAGRAPH_SEPARATOR,
    embed_batch: int = EMBED_BATCH,
) -> DataFrame:
    """Chunk, embed and store documents; what became of each document.

    ``documents`` has id, title, language, content and optionally stage. With
    ``resume``, chunks that are stored stay as they are and are not embedded
    again; without it they are replaced. Chunks are cut once and written to the
    shared folder, for the report and the load.
    """
    spark = collection.spark
    if "stage" not in documents.columns:
        documents = documents.withColumn("stage", F.lit(None).cast("int"))
    path = new_run_dir(spark, "chunks")
    named = documents.withColumnRenamed("title", "document_title")
    chunk_documents(named, separator=separator).write.parquet(path)
    chunks = spark.read.parquet(path)
    if resume:
        stored = collection.matching(chunks).select("chunk_id")
    else:
        stored = spark.createDataFrame([], "chunk_id string")
    wanted = resume_chunks(chunks, stored)
    rows = embed_chunks(wanted, embed, embed_batch).select(*COLLECTION.fieldNames())
    # The report is of the collection as it was before, so it is written first.
    results_path = new_run_dir(spark, "load-results")
    load_results(documents, chunks, stored).write.parquet(results_path)
    if resume:
        collection.append(rows)
    else:
        collection.upsert(rows)
    return spark.read.parquet(results_path)


def search_text(
    collection: DataFrame,
    text: str,
    embed: EmbedFunction,
    limit: int = SEARCH_LIMIT,
    document: str | None = None,
    language: str | None = None,
    stages: list | None = None,
) -> DataFrame:
    """The chunks closest to a text, best first, with their payload."""
    query = embed([text])[0]
    where = search_filter(document, language, stages)
    return vector_top_k(collection, query, limit, where).select(*HIT_COLUMNS)
