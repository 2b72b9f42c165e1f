"""Document chunks, embeddings and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from logtide.constants import CHUNK_OVERLAP, CHUNK_SIZE, SPACE_CHARS
from logtide.functions.text import content_id
from logtide.operators import chunking, vector_search
from logtide.plans import knowledge
from logtide.session import new_run_dir
from logtide.sources import files
from suite.common import table

SEPARATOR = "\n"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
QUESTION = "what does the open index hold and how is it minted"


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A stand-in for an embedding model: how often each letter occurs."""
    return [[float(text.count(letter)) for letter in LETTERS] for text in texts]


def _documents(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("title"),
        F.col("lang").alias("language"),
        F.col("text").alias("content"),
    )


def _chunks(spark, sf):
    return chunking.chunk_documents(_documents(spark, sf), separator=SEPARATOR)


def doc_content_id(spark, sf):
    return _documents(spark, sf).select("id", content_id(F.col("content")).alias("content_id"))


def chunk_documents(spark, sf):
    return _chunks(spark, sf)


def doc_catalog(spark, sf):
    """Metadata as JSON, the catalog of it as CSV, read back."""
    base = new_run_dir(spark, "catalog")
    metadata = _documents(spark, sf).select(
        "title", "id", "language",
        F.concat(F.lit("docs/"), "id", F.lit(".md")).alias("file_path"),
        F.octet_length("content").cast("long").alias("file_size"),
    )
    metadata.write.json(f"{base}/metadata")
    found = files.read_doc_metadata(spark, f"{base}/metadata", multi_line=False)
    files.doc_catalog(found).drop("created_at").write.csv(f"{base}/catalog.csv", header=True)
    text = "title string, id string, language string, file_path string, file_size string"
    return files.read_table(spark, f"{base}/catalog.csv", text)


def resume_chunks(spark, sf):
    """What is left to load once the English documents are in."""
    loaded = _chunks(spark, sf).where("language = 'en'").select("chunk_id")
    left = chunking.resume_chunks(_chunks(spark, sf), loaded)
    return left.select("chunk_id", "document_id", "char_count", "word_count")


def load_summary(spark, sf):
    """Two loads: English documents first, then all; junk without text fails."""
    documents = _documents(spark, sf)
    documents = documents.withColumn(
        "content", F.when(F.length("content") >= 100, F.col("content"))
    )
    chunks = chunking.chunk_documents(documents, separator=SEPARATOR)
    loaded = chunks.where("language = 'en'").select("chunk_id")
    return chunking.load_summary(chunking.load_results(documents, chunks, loaded))


def embed_chunks(spark, sf):
    embedded = chunking.embed_chunks(_chunks(spark, sf), letter_counts)
    counts = F.transform("vector", lambda x: x.cast("int").cast("string"))
    return embedded.select(
        "chunk_id", "document_id", "language", "title", "char_count", "word_count",
        F.array_join(counts, ",").alias("vector"),
    )


def _collection(spark, sf, name):
    """All documents in a collection: the English ones first, then the rest."""
    documents = _documents(spark, sf)
    collection = knowledge.collection_table(spark, new_run_dir(spark, name), buckets=8)
    english = documents.where("language = 'en'")
    knowledge.load_collection(collection, english, letter_counts, separator=SEPARATOR)
    results = knowledge.load_collection(collection, documents, letter_counts, separator=SEPARATOR)
    return collection.read(), results


def load_collection(spark, sf):
    """What the second load did with each document, and what is stored of it."""
    stored, results = _collection(spark, sf, "load")
    held = stored.groupBy("document_id").agg(
        F.count("*").alias("stored_chunks"),
        F.count_distinct("chunk_id").alias("stored_ids"),
        F.sum(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x)).cast("long").alias("letters"),
    )
    return results.join(held, "document_id")


def search_documents(spark, sf):
    """English chunks closest to a question, from a stored collection."""
    stored, _ = _collection(spark, sf, "search")
    hits = knowledge.search_text(stored, QUESTION, letter_counts, 5, language="en")
    return hits.select(
        F.round("score", 6).alias("score"), "document_id", "document_title", "chunk_id", "char_count"
    )


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), F.col("label").alias("stage")
    )


def _question_vector(spark, sf):
    return _vectors(spark, sf).orderBy("vec_id").first()["vector"]


def vector_top_k(spark, sf):
    hits = vector_search.vector_top_k(
        _vectors(spark, sf), _question_vector(spark, sf), 10, row_id="vec_id"
    )
    return hits.select("vec_id", "stage", F.round("score", 6).alias("score"))


def vector_top_k_filtered(spark, sf):
    hits = vector_search.vector_top_k(
        _vectors(spark, sf),
        _question_vector(spark, sf),
        10,
        vector_search.search_filter(stages=[1, 2, 3]),
        row_id="vec_id",
    )
    return hits.select("vec_id", "stage", F.round("score", 6).alias("score"))


def vector_top_k_batch(spark, sf):
    """The vectors closest to the mean vector of each label."""
    vectors = _vectors(spark, sf)
    size = len(_question_vector(spark, sf))
    means = F.array(*[F.avg(F.col("vector")[i].cast("double")) for i in range(size)])
    queries = vectors.groupBy(F.col("stage").alias("query_id")).agg(means.alias("vector"))
    hits = vector_search.vector_top_k_batch(vectors, queries, 5, row_id="vec_id")
    return hits.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def vector_top_k_batch_ids(spark, sf):
    """The vectors closest to every embedding whose id is divisible by 20."""
    vectors = _vectors(spark, sf)
    queries = vectors.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "vector")
    hits = vector_search.vector_top_k_batch(vectors, queries, 5, row_id="vec_id")
    return hits.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


QUERIES = {
    "doc_content_id": doc_content_id,
    "chunk_documents": chunk_documents,
    "doc_catalog": doc_catalog,
    "resume_chunks": resume_chunks,
    "load_summary": load_summary,
    "embed_chunks": embed_chunks,
    "load_collection": load_collection,
    "search_documents": search_documents,
    "vector_top_k": vector_top_k,
    "vector_top_k_filtered": vector_top_k_filtered,
    "vector_top_k_batch": vector_top_k_batch,
    "vector_top_k_batch_ids": vector_top_k_batch_ids,
}


def _chunk_sql(where: str = "true") -> str:
    """Chunks by a recursion over paragraphs, all documents in step."""
    spaces = "'" + SPACE_CHARS + "'"
    split = "'[" + SPACE_CHARS + "]+'"
    sep = f"'{SEPARATOR}'"
    return f"""
paragraphs AS (
  SELECT doc_id, CAST(generate_subscripts(ps, 1) AS INTEGER) AS i, unnest(ps) AS p
  FROM (SELECT doc_id, list_filter(list_transform(string_split(trim(text, {spaces}), {sep}),
          lambda x: trim(x, {spaces})), lambda x: x <> '') AS ps
        FROM documents WHERE {where})
),
steps(doc_id, i, current, n, finished) AS (
  SELECT doc_id, i, p, 0, CAST(NULL AS VARCHAR) FROM paragraphs WHERE i = 1
  UNION ALL
  SELECT doc_id, i, CASE WHEN is_full THEN
      array_to_string(ws[len(ws) - least({CHUNK_OVERLAP // 5}, len(ws) // 2) + 1:], ' ')
      ELSE current END || {sep} || p,
    n + CAST(is_full AS INTEGER), CASE WHEN is_full THEN current END
  FROM (
    SELECT q.doc_id, q.i, q.p, s.current, s.n,
      length(s.current) + length(q.p) + 1 > {CHUNK_SIZE} AS is_full,
      CASE WHEN length(s.current) + length(q.p) + 1 > {CHUNK_SIZE}
        THEN regexp_split_to_array(trim(s.current, {spaces}), {split}) END AS ws
    FROM steps s JOIN paragraphs q ON q.doc_id = s.doc_id AND q.i = s.i + 1)
),
cut AS (
  SELECT doc_id, n - 1 AS n, finished AS chunk FROM steps WHERE finished IS NOT NULL
  UNION ALL
  SELECT doc_id, max(n), arg_max(current, i) FROM steps GROUP BY doc_id
),
chunks AS (
  SELECT doc_id || '_' || n AS chunk_id, CAST(doc_id AS VARCHAR) AS document_id,
    source AS title, lang AS language, content,
    CAST(length(content) AS INTEGER) AS char_count,
    CAST(len(regexp_split_to_array(content, {split})) AS INTEGER) AS word_count
  FROM (SELECT doc_id, n, trim(chunk, {spaces}) AS content FROM cut) JOIN documents USING (doc_id)
)"""


_COUNTS = " || ',' || ".join(
    f"(length(content) - length(replace(content, '{c}', '')))" for c in LETTERS
)
_LETTER_VECTOR = "[" + ", ".join(
    f"CAST(length(content) - length(replace(content, '{c}', '')) AS DOUBLE)" for c in LETTERS
) + "]"
_QUESTION_VECTOR = "[" + ", ".join(str(float(QUESTION.count(c))) for c in LETTERS) + "]"
_ASKED = "(SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1)"
_SCORE = f"list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST({_ASKED} AS DOUBLE[]))"
_BYTES = "strlen(text)"
_CENTS = f"({_BYTES} * 100) // 1048576"
_REST = f"({_BYTES} * 100) % 1048576"
_MB = f"""({_CENTS} + CAST({_REST} * 2 > 1048576
    OR ({_REST} * 2 = 1048576 AND {_CENTS} % 2 = 1) AS INTEGER))"""

ORACLES = {
    "doc_content_id": """SELECT CAST(doc_id AS VARCHAR) AS id, left(md5(text), 8) AS content_id
        FROM documents""",
    "chunk_documents": f"WITH RECURSIVE {_chunk_sql()} SELECT * FROM chunks",
    "doc_catalog": f"""SELECT source AS title, CAST(doc_id AS VARCHAR) AS id, lang AS language,
        'docs/' || doc_id || '.md' AS file_path,
        ({_MB} // 100) || '.' || lpad(CAST({_MB} % 100 AS VARCHAR), 2, '0') || ' MB' AS file_size
        FROM documents""",
    "resume_chunks": f"""WITH RECURSIVE {_chunk_sql()} SELECT chunk_id, document_id, char_count,
        word_count FROM chunks WHERE language <> 'en'""",
    "load_summary": f"""WITH RECURSIVE {_chunk_sql('length(text) >= 100')}
        SELECT (SELECT count(*) FROM documents) AS total_documents,
          (SELECT count(*) FROM documents WHERE length(text) >= 100) AS successful_documents,
          (SELECT count(*) FROM documents WHERE length(text) < 100) AS failed_documents,
          count(*) FILTER (language <> 'en') AS total_chunks_processed,
          count(*) FILTER (language = 'en') AS total_chunks_skipped FROM chunks""",
    "embed_chunks": f"""WITH RECURSIVE {_chunk_sql()} SELECT chunk_id, document_id, language,
        title, char_count, word_count, {_COUNTS} AS vector FROM chunks""",
    "load_collection": f"""WITH RECURSIVE {_chunk_sql()}, counted AS (
          SELECT document_id, language, list_sum({_LETTER_VECTOR}) AS letters FROM chunks)
        SELECT document_id, true AS success, count(*) AS total_chunks,
          count(*) FILTER (language <> 'en') AS processed_chunks,
          count(*) FILTER (language = 'en') AS skipped_chunks,
          count(*) AS stored_chunks, count(*) AS stored_ids,
          CAST(sum(letters) AS BIGINT) AS letters FROM counted GROUP BY document_id""",
    "search_documents": f"""WITH RECURSIVE {_chunk_sql("lang = 'en'")}, counted AS MATERIALIZED (
          SELECT *, {_LETTER_VECTOR} AS v FROM chunks),
        scored AS (
          SELECT *, CASE WHEN list_sum(v) = 0 THEN 0
            ELSE list_cosine_similarity(v, {_QUESTION_VECTOR}) END AS s FROM counted)
        SELECT round(s, 6) AS score, document_id, title AS document_title, chunk_id, char_count
        FROM scored
        ORDER BY round(s, 12) DESC, chunk_id LIMIT 5""",
    "vector_top_k": f"""SELECT vec_id, label AS stage, round({_SCORE}, 6) AS score
        FROM embeddings ORDER BY {_SCORE} DESC, vec_id LIMIT 10""",
    "vector_top_k_filtered": f"""SELECT vec_id, label AS stage, round({_SCORE}, 6) AS score
        FROM embeddings WHERE label IN (1, 2, 3) ORDER BY {_SCORE} DESC, vec_id LIMIT 10""",
    "vector_top_k_batch": """WITH parts AS (
          SELECT label, generate_subscripts(embedding, 1) AS i,
            CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
        means AS (SELECT label, list(x ORDER BY i) AS v FROM (
          SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i) GROUP BY label),
        ranked AS (
          SELECT m.label AS query_id, vec_id, s, CAST(row_number() OVER (
              PARTITION BY m.label ORDER BY round(s, 12) DESC, vec_id) AS INTEGER) AS rank
          FROM (SELECT m.label, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS s
                FROM embeddings CROSS JOIN means m) m)
        SELECT query_id, vec_id, rank, round(s, 6) AS score FROM ranked WHERE rank <= 5""",
    "vector_top_k_batch_ids": """WITH scored AS (
          SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(
              CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS s
          FROM embeddings e JOIN embeddings q ON q.vec_id % 20 = 0),
        ranked AS (
          SELECT query_id, vec_id, s, CAST(row_number() OVER (
              PARTITION BY query_id ORDER BY round(s, 12) DESC, vec_id) AS INTEGER) AS rank
          FROM scored)
        SELECT query_id, vec_id, rank, round(s, 6) AS score FROM ranked WHERE rank <= 5""",
}
