"""Overlapping text chunks, resume filter, embedding and load summaries."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.constants import (
    CHARS_PER_OVERLAP_WORD,
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    EMBED_BATCH,
    PARAGRAPH_SEPARATOR,
)
from logtide.functions.text import strip, word_count, words
from logtide.operators.joins import lookup_join

EmbedFunction = Callable[[list[str]], list[list[float]]]


def _last_words(chunk: str, overlap: int) -> str:
    """What the next chunk takes over: one word per five characters of overlap,
    at most half of the words."""
    if overlap <= 0:
        return ""
    found = chunk.split()
    taken = min(overlap // CHARS_PER_OVERLAP_WORD, len(found) // 2)
    return " ".join(found[len(found) - taken :])


def fold_paragraphs(
    paragraphs: Iterable[str], chunk_size: int, overlap: int, separator: str
) -> list[str]:
    """Chunks of one document's paragraphs, in time linear in its length."""
    chunks: list[str] = []
    lead, taken, size, gap = "", [], 0, len(separator)
    for paragraph in paragraphs:
        if not taken:
            taken, size = [paragraph], len(paragraph)
        elif size + gap + len(paragraph) <= chunk_size:
            taken.append(paragraph)
            size += gap + len(paragraph)
        else:
            chunks.append(lead + separator.join(taken))
            lead = _last_words(chunks[-1], overlap) + separator
            taken, size = [paragraph], len(lead) + len(paragraph)
    return [*chunks, lead + separator.join(taken)] if taken else chunks


def split_paragraphs(content: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    """Stripped paragraphs of a text, without the empty ones."""
    parts = F.split(strip(content), re.escape(separator))
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def chunk_paragraphs(
    paragraphs: str,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separator: str = PARAGRAPH_SEPARATOR,
) -> Column:
    """Chunks of the paragraphs in an array column, as ``array<string>``.

    A chunk takes paragraphs while it stays within ``chunk_size``; a longer
    paragraph stays whole. The next one starts with the last words of the chunk
    before. Every chunk depends on the one before, and SQL functions copy what they
    have gathered at each step, so documents are folded in Arrow batches.
    """

    @F.pandas_udf("array<string>")
    def cut(listed: pd.Series) -> pd.Series:
        return listed.map(
            lambda p: None if p is None else fold_paragraphs(p, chunk_size, overlap, separator)
        )

    return cut(F.col(paragraphs))


def chunk_documents(
    documents: DataFrame,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separator: str = PARAGRAPH_SEPARATOR,
    id_column: str = "id",
    content: str = "content",
) -> DataFrame:
    """One row per chunk, with its id ``<document>_<n>`` and its sizes.

    No shuffle: a document is cut where its row is. Other document columns
    (title, language, stage) go along.
    """
    carried = [c for c in documents.columns if c not in (id_column, content)]
    split = documents.select(
        F.col(id_column).alias("document_id"),
        *carried,
        split_paragraphs(F.col(content), separator).alias("paragraphs"),
    )
    cut = split.select(
        "document_id",
        *carried,
        F.posexplode(chunk_paragraphs("paragraphs", chunk_size, overlap, separator)).alias(
            "chunk_no", "chunk"
        ),
    )
    stripped = cut.withColumn("content", strip(F.col("chunk")))
    return stripped.select(
        F.concat_ws("_", "document_id", "chunk_no").alias("chunk_id"),
        "document_id",
        *carried,
        "content",
        F.length("content").alias("char_count"),
        word_count(F.col("content")).alias("word_count"),
    )


def resume_chunks(chunks: DataFrame, loaded: DataFrame) -> DataFrame:
    """Chunks whose id is not loaded yet.

    Loaded ids that were measured small are broadcast, so that chunk texts are
    not shuffled for the comparison.
    """
    return lookup_join(chunks, loaded.select("chunk_id").distinct(), "chunk_id", "left_anti")


def embed_chunks(
    chunks: DataFrame, embed: EmbedFunction, batch_size: int = EMBED_BATCH
) -> DataFrame:
    """Chunks with a ``vector`` from the caller's batch function.

    ``embed`` gets up to ``batch_size`` texts per call, inside the tasks; only
    texts and vectors pass between Spark and Python. The function is marked as
    not deterministic, so that Spark calls a costly model once per chunk.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        listed = texts.tolist()
        vectors: list[list[float]] = []
        for at in range(0, len(listed), batch_size):
            vectors.extend(embed(listed[at : at + batch_size]))
        return pd.Series(vectors, dtype=object)

    return chunks.withColumn("vector", run.asNondeterministic()(F.col("content")))


def load_results(documents: DataFrame, chunks: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per document: chunks in all, chunks to process, chunks skipped, success.

    A document without content has nothing to load and counts as failed. Chunks
    are counted per document in the map tasks before the join.
    """
    marked = chunks.select("document_id", "chunk_id").join(
        loaded.select("chunk_id").distinct().withColumn("is_loaded", F.lit(True)),
        "chunk_id",
        "left",
    )
    counted = marked.groupBy("document_id").agg(
        F.count("*").alias("total_chunks"),
        F.count_if(F.col("is_loaded").isNull()).alias("processed_chunks"),
        F.count_if(F.col("is_loaded")).alias("skipped_chunks"),
    )
    joined = documents.select(
        F.col("id").alias("document_id"), F.col("content").isNotNull().alias("success")
    ).join(counted, "document_id", "left")
    return joined.na.fill(0, ["total_chunks", "processed_chunks", "skipped_chunks"])


def load_summary(results: DataFrame) -> DataFrame:
    ok = F.col("success")
    return results.agg(
        F.count("*").alias("total_documents"),
        F.count_if(ok).alias("successful_documents"),
        F.count_if(~ok).alias("failed_documents"),
        F.coalesce(F.sum(F.when(ok, F.col("processed_chunks"))), F.lit(0)).alias(
            "total_chunks_processed"
        ),
        F.coalesce(F.sum(F.when(ok, F.col("skipped_chunks"))), F.lit(0)).alias(
            "total_chunks_skipped"
        ),
    )
