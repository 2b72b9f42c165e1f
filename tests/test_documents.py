import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.constants import SPACE_CHARS
from logtide.functions import text
from logtide.operators import chunking, vector_search
from logtide.plans import knowledge
from suite import documents
from tests.helpers import plan, tuples

DOCS = "id string, title string, language string, content string"


def expected_chunks(content, size, overlap, gap="\n\n"):
    """Brute force: try every next paragraph on the text built so far."""
    paragraphs = [p for p in (q.strip() for q in content.split(gap)) if p]
    chunks, at = [], 0
    lead = ""
    while at < len(paragraphs):
        end = at + 1
        while end < len(paragraphs) and len(lead + gap.join(paragraphs[at : end + 1])) <= size:
            end += 1
        chunk = lead + gap.join(paragraphs[at:end])
        chunks.append(chunk.strip())
        found = chunk.split()
        take = min(overlap // 5, len(found) // 2) if overlap > 0 else 0
        lead = " ".join(found[len(found) - take :]) + gap if take else gap
        at = end
    return chunks


def random_text(rng):
    spaces = [" ", " ", " ", "\t", "\n", " ", "　", "\x1f", "  "]
    letters = "abcé中\U0001f600"

    def paragraph():
        n = rng.choice([1, 3, 10, 40, 120])
        return "".join(
            "".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(spaces) for _ in range(n)
        )

    parts = [rng.choice(["", " ", " "]) if rng.random() < 0.15 else paragraph()
             for _ in range(rng.randint(0, 25))]
    return rng.choice(["", " \n　"]) + "\n\n".join(parts)


@pytest.mark.parametrize("size,overlap", [(3500, 700), (200, 50), (200, 0), (60, 4), (1, 700)])
def test_chunks_match_brute_force(spark, size, overlap):
    rng = random.Random(size + overlap)
    docs = [(f"d{i}", "t", "en", random_text(rng)) for i in range(60)]
    docs += [("empty", "t", "en", ""), ("blank", "t", "en", " \n\n "), ("null", "t", "en", None)]
    chunks = chunking.chunk_documents(spark.createDataFrame(docs, DOCS), size, overlap)
    found = {}
    for row in chunks.collect():
        found.setdefault(row.document_id, {})[row.chunk_id] = row
    for doc_id, _, _, content in docs:
        wanted = expected_chunks(content.strip(), size, overlap) if content else []
        rows = found.get(doc_id, {})
        assert set(rows) == {f"{doc_id}_{n}" for n in range(len(wanted))}
        for n, chunk in enumerate(wanted):
            row = rows[f"{doc_id}_{n}"]
            assert row.content == chunk
            assert (row.char_count, row.word_count) == (len(chunk), len(chunk.split()))


def test_folding_time_grows_with_the_document():
    def seconds(n):
        paragraphs = ["word " * 160] * n
        began = time.perf_counter()
        assert len(chunking.fold_paragraphs(paragraphs, 1000, 200, "\n\n")) == n
        return time.perf_counter() - began

    seconds(2000)
    assert seconds(64_000) < 12 * max(seconds(16_000), 0.02)


def test_chunking_does_not_shuffle(spark):
    docs = spark.createDataFrame([("a", "t", "en", "x")], DOCS)
    assert "Exchange" not in plan(chunking.chunk_documents(docs))


def test_space_characters_are_those_of_python(spark):
    everything = [chr(n) for n in range(0x3100) if not 0xD800 <= n < 0xE000]
    df = spark.createDataFrame([(c,) for c in everything], "c string")
    stripped = {r.c for r in df.where(text.strip(F.col("c")) == "").collect()}
    split = {r.c for r in df.where(F.size(text.words(F.concat(F.lit("a"), "c", F.lit("b")))) == 2).collect()}
    assert stripped == split == {c for c in everything if c.isspace()} == set(SPACE_CHARS)


def lengths(texts):
    return [[float(len(t)), 1.0] for t in texts]


def test_resume_embed_and_summary(spark):
    docs = spark.createDataFrame(
        [("a", "t", "en", "one\n\ntwo"), ("b", "t", "vi", "three"), ("c", "t", "en", ""), ("d", "t", "en", None)],
        DOCS,
    )
    chunks = chunking.chunk_documents(docs, 4, 0)
    assert tuples(chunks.select("chunk_id")) == [("a_0",), ("a_1",), ("b_0",)]
    loaded = chunks.where("chunk_id = 'a_0'")
    left = chunking.resume_chunks(chunks, loaded)
    embedded = chunking.embed_chunks(left, lengths, batch_size=1)
    assert tuples(embedded.select("chunk_id", "vector")) == [("a_1", [3.0, 1.0]), ("b_0", [5.0, 1.0])]
    assert set(embedded.columns) >= {"title", "language", "char_count", "word_count"}
    results = chunking.load_results(docs, chunks, loaded)
    assert tuples(results.select("document_id", "total_chunks", "processed_chunks", "skipped_chunks", "success")) == [
        ("a", 2, 1, 1, True), ("b", 1, 1, 0, True), ("c", 0, 0, 0, True), ("d", 0, 0, 0, False)
    ]
    assert tuple(chunking.load_summary(results).first()) == (4, 3, 1, 2, 1)
    assert tuple(chunking.load_summary(results.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_collection_loads_once_and_again(spark, run_dir):
    calls = spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return lengths(texts)

    docs = spark.createDataFrame([("a", "t", "en", "one"), ("b", "u", "vi", "three")], DOCS)
    collection = knowledge.collection_table(spark, run_dir, 2)
    knowledge.load_collection(collection, docs.where("id = 'a'"), counted)
    results = knowledge.load_collection(collection, docs, counted)
    assert calls.value == 2
    assert tuples(results.select("document_id", "processed_chunks", "skipped_chunks")) == [
        ("a", 0, 1), ("b", 1, 0)
    ]
    changed = docs.withColumn("content", F.concat("content", F.lit("!")))
    knowledge.load_collection(collection, changed, counted, resume=False)
    assert tuples(collection.read().select("content")) == [("one!",), ("three!",)]
    hits = knowledge.search_text(collection.read(), "four", lengths, 1, language="vi")
    assert hits.columns == knowledge.HIT_COLUMNS and hits.first().document_title == "u"


def test_content_id(spark):
    row = spark.createDataFrame([("abc",)], "x string").select(text.content_id(F.col("x")).alias("y")).first()
    assert row.y == "90015098"


VECTORS = "chunk_id string, document_id string, language string, stage int, vector array<float>"


def vectors(spark, rows=400, size=8, copies=150):
    rng = np.random.default_rng(4)
    made = rng.normal(size=(rows, size)).astype(np.float32)
    made[:copies] = made[0]
    made[5 % rows] = 0
    data = [
        (f"c{i:04d}", f"d{i % 7}", "en" if i % 2 else "vi", i % 4, [float(x) for x in v])
        for i, v in enumerate(made)
    ]
    return made, spark.createDataFrame(data, VECTORS).repartition(5)


def brute(made, query, k, keep=lambda i: True):
    rows = made.astype(np.float64)
    q = np.asarray(query, dtype=np.float64)
    norms = np.linalg.norm(rows, axis=1) * np.linalg.norm(q)
    scores = np.divide(rows @ q, norms, out=np.zeros(len(rows)), where=norms > 0)
    order = sorted((i for i in range(len(rows)) if keep(i)), key=lambda i: (-round(scores[i], 12), i))
    return [(f"c{i:04d}", round(scores[i], 9)) for i in order[:k]]


def test_top_k(spark):
    made, corpus = vectors(spark)
    query = [float(x) for x in made[0]]
    hits = vector_search.vector_top_k(corpus, query, 7).collect()
    assert [(h.chunk_id, round(h.score, 9)) for h in hits] == brute(made, query, 7)
    assert vector_search.vector_top_k(corpus.limit(0), query, 7).count() == 0


def test_filters(spark):
    made, corpus = vectors(spark)
    query = [1.0] * 8
    where = vector_search.search_filter(language="en", stages=[1, 2])
    hits = vector_search.vector_top_k(corpus, query, 5, where).collect()
    assert [h.chunk_id for h in hits] == [c for c, _ in brute(made, query, 5, lambda i: i % 4 == 1)]
    one = vector_search.search_filter(document="d3")
    assert {h.document_id for h in vector_search.vector_top_k(corpus, query, 5, one).collect()} == {"d3"}
    assert vector_search.search_filter() is None


@pytest.mark.parametrize("per_pass", [10**6, 24])
def test_many_queries_in_one_or_more_passes(spark, per_pass):
    made, corpus = vectors(spark)
    asked = [[float(x) for x in made[i]] for i in (0, 5, 200, 300, 399)]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, vector array<float>")
    hits = vector_search.vector_top_k_batch(corpus, queries, 4, numbers_per_pass=per_pass)
    for number, query in enumerate(asked):
        rows = sorted((r for r in hits.collect() if r.query_id == number), key=lambda r: r["rank"])
        assert [(r.chunk_id, round(r.score, 9)) for r in rows] == brute(made, query, 4)
    assert vector_search.vector_top_k_batch(corpus, queries.limit(0), 4).count() == 0


def test_small_corpus_and_zero_query(spark):
    made, corpus = vectors(spark, rows=3, copies=1)
    queries = spark.createDataFrame([(1, [0.0] * 8)], "query_id int, vector array<float>")
    assert vector_search.vector_top_k_batch(corpus, queries, 10).count() == len(made)
    assert {r.score for r in vector_search.vector_top_k(corpus, [0.0] * 8, 10).collect()} == {0.0}


def test_many_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(vector_search, "ROW_BLOCK", 5)
    rng = np.random.default_rng(5)
    corpus, queries = rng.normal(size=(40, 4)), rng.normal(size=(11, 4))
    found = vector_search.vector_top_k_batch(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "chunk_id long, vector array<double>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id int, vector array<double>"),
        k=3,
    )
    unit = corpus / np.linalg.norm(corpus, axis=1, keepdims=True)
    wanted = {(i, r + 1): int(c) for i, q in enumerate(queries) for r, c in enumerate(np.argsort(-(unit @ q))[:3])}
    assert {(r.query_id, r["rank"]): r.chunk_id for r in found.collect()} == wanted


def test_registered_batch_search_asks_with_every_20th_id(spark, run_dir):
    made = np.random.default_rng(6).normal(size=(20_600, 4))
    rows = [(i + 1, v, i % 10) for i, v in enumerate(made.tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{run_dir}/embeddings.parquet")
    found = documents.QUERIES["vector_top_k_batch_ids"](spark, run_dir).collect()
    unit = made / np.linalg.norm(made, axis=1, keepdims=True)
    asked = np.arange(20, len(made) + 1, 20)
    assert len(asked) > vector_search.QUERY_BLOCK
    best = np.argsort(-(unit[asked - 1] @ unit.T), axis=1)[:, :5] + 1
    wanted = {(int(q), n + 1): int(i) for q, ids in zip(asked, best, strict=True) for n, i in enumerate(ids)}
    assert len(found) == len(wanted) and {(r.query_id, r["rank"]): r.vec_id for r in found} == wanted


def test_a_vector_of_another_length_is_named(spark):
    corpus = spark.createDataFrame([("a", [1.0, 2.0]), ("odd", [1.0])], "chunk_id string, vector array<double>")
    with pytest.raises(Exception, match="odd"):
        vector_search.vector_top_k(corpus, [1.0, 0.0], 1).collect()
