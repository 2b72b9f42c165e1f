"""Exact cosine top-k search over an ``array<float>`` column."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logtide.constants import SEARCH_LIMIT
from logtide.functions.vectors import cosine

# Query vectors sent to every task in one pass: at most this many numbers (32 MB).
QUERY_NUMBERS_PER_PASS = 4_000_000
# Queries and rows are scored in blocks of at most this many of each.
QUERY_BLOCK, ROW_BLOCK = 1024, 1024


def search_filter(
    document: str | None = None, language: str | None = None, stages: list | None = None
) -> Column | None:
    """Filter on the payload; any of several stages matches."""
    conditions = []
    if document is not None:
        conditions.append(F.col("document_id") == document)
    if language is not None:
        conditions.append(F.col("language") == language)
    if stages:
        conditions.append(F.col("stage").isin(list(stages)))
    return reduce(lambda a, b: a & b, conditions) if conditions else None


def vector_top_k(
    corpus: DataFrame,
    query: list[float],
    k: int = SEARCH_LIMIT,
    where: Column | None = None,
    vector: str = "vector",
    row_id: str = "chunk_id",
) -> DataFrame:
    """The ``k`` rows closest to one query, best first, with their ``score``.

    The filter comes before scoring. A first pass reads only ids and vectors and
    brings the ``k`` best ids to the driver; texts and other payload are then
    read for those rows alone.
    """
    if where is not None:
        corpus = corpus.where(where)
    schema = _hit_schema(T.StructField("query_id", T.IntegerType()), corpus.schema[row_id])
    best = [F.col("score").desc(), F.col(row_id).asc()]
    hits = _one_pass(corpus, [(0, query)], k, vector, row_id, schema).orderBy(*best).limit(k)
    ids = [row[0] for row in hits.select(row_id).collect()]
    found = corpus.where(F.col(row_id).isin(ids)) if ids else corpus.limit(0)
    literal = F.array(*[F.lit(float(x)) for x in query])
    return found.withColumn("score", cosine(F.col(vector), literal)).orderBy(*best).limit(k)


def _hit_schema(query_id: T.StructField, row_id: T.StructField) -> T.StructType:
    return T.StructType([query_id, row_id, T.StructField("score", T.DoubleType())])


def vector_top_k_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = SEARCH_LIMIT,
    vector: str = "vector",
    row_id: str = "chunk_id",
    query_id: str = "query_id",
    numbers_per_pass: int = QUERY_NUMBERS_PER_PASS,
) -> DataFrame:
    """The ``k`` closest rows of every query: (query_id, row_id, score, rank).

    Queries go to the tasks as one matrix. When they are more than fits a pass,
    they are taken in several passes over the corpus; none is left out.
    """
    total, size = queries.agg(F.count("*"), F.max(F.size(vector))).first()
    schema = _hit_schema(queries.schema[query_id], corpus.schema[row_id])
    if not total:
        return corpus.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    passes = -(-total * size // numbers_per_pass)
    part = F.pmod(F.xxhash64(query_id), F.lit(passes))
    found = []
    for number in range(passes):
        rows = queries.where(part == number).select(query_id, vector).collect()
        if rows:
            found.append(_one_pass(corpus, rows, k, vector, row_id, schema))
    best = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(row_id).asc())
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )


def _one_pass(
    corpus: DataFrame, rows: list, k: int, vector: str, row_id: str, schema: T.StructType
) -> DataFrame:
    """Best ``k`` rows of each task for a block of queries."""
    sizes = {len(row[1]) for row in rows}
    if len(sizes) > 1:
        raise ValueError(f"queries have vectors of different lengths: {sorted(sizes)}")
    matrix = np.array([row[1] for row in rows], dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    shared = corpus.sparkSession.sparkContext.broadcast((unit, [row[0] for row in rows]))
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, query_ids = shared.value
        best = [(np.empty(0), None)] * len(query_ids)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block, ids = _vectors(batch, vector, row_id, queries.shape[1])
            for row in range(0, len(block), ROW_BLOCK):
                rows = slice(row, row + ROW_BLOCK)
                for query in range(0, len(queries), QUERY_BLOCK):
                    some = slice(query, query + QUERY_BLOCK)
                    scores = _cosines(queries[some], block[rows])
                    best[some] = _merge_best(best[some], scores, ids[rows], k)
        for query, (scores, ids) in zip(query_ids, best):
            if len(scores):
                columns = [[query] * len(scores), ids.tolist(), scores.tolist()]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow_schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    vectors = corpus.select(row_id, vector).where(F.col(vector).isNotNull())
    return vectors.mapInArrow(run, schema)


def _vectors(
    batch: pa.RecordBatch, vector: str, row_id: str, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a batch as a matrix, and their row ids."""
    ids = np.array(batch.column(row_id).to_pylist())
    lengths = batch.column(vector).value_lengths().to_numpy(zero_copy_only=False)
    odd = np.flatnonzero(lengths != size)
    if len(odd):
        raise ValueError(
            f"vector of row {ids[odd[0]]!r} has {lengths[odd[0]]} numbers, the queries have {size}"
        )
    numbers = batch.column(vector).flatten().to_numpy(zero_copy_only=False)
    return numbers.astype(np.float64).reshape(batch.num_rows, size), ids


def _cosines(unit_queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores per query and row; rounded, so that equal vectors tie exactly."""
    lengths = np.linalg.norm(block, axis=1)
    products = unit_queries @ block.T
    scores = np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)
    return np.round(scores, 12)


def _merge_best(best: list, scores: np.ndarray, ids: np.ndarray, k: int) -> list:
    """The best ``k`` (score, id) per query after one more block of rows.

    Only rows that reach the k-th best score so far are looked at. Ties go to the
    smaller id, so copies of one vector never pile up.
    """
    if scores.shape[1] > k:
        floors = np.partition(scores, -k, axis=1)[:, -k]
    else:
        floors = np.full(len(scores), -np.inf)
    merged = []
    for (old_scores, old_ids), row, floor in zip(best, scores, floors):
        if len(old_scores) == k:
            floor = max(floor, old_scores[-1])
        hits = np.nonzero(row >= floor)[0]
        if old_ids is None:
            all_scores, all_ids = row[hits], ids[hits]
        else:
            all_scores = np.concatenate([old_scores, row[hits]])
            all_ids = np.concatenate([old_ids, ids[hits]])
        order = np.lexsort((all_ids, -all_scores))[:k]
        merged.append((all_scores[order], all_ids[order]))
    return merged
