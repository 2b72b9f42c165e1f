"""One registered query per operator, with the SQL that states its answer where
SQL can."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import (
    bayes_minhash,
    content_parts,
    cover_dedup,
    feistel_shards,
    fill_middle,
    fm_decontaminate,
    frame_store,
    hard_negatives,
    length_histogram,
    ordinal_quality,
    rule_ledger,
    two_fit_packing,
    warc_derivatives,
)
from logtide.llm.oracles import ORACLES  # noqa: F401
from logtide.llm.words import arrow_map, keyed, utf8
from logtide.llm.workspace import Workspace


CONTEXT_LIMITS = tuple(1 << n for n in range(9, 18))
QUANTILES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratings = ordinal_quality.graded_labels(_table(spark, sf_dir, "labels"))
    model = ordinal_quality.train(docs, ratings, 3)
    tails = F.col("tails")
    return ordinal_quality.score(docs, model).select(
        "doc_id", "score", "expected_grade",
        tails[0].alias("p_not_toxic"), tails[1].alias("p_good"), (tails[1] >= 0.5).alias("kept"),
    )


def q_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.ledger(_table(spark, sf_dir, "documents"))
    base = rule_ledger.policy_mask("base-1")
    failed = F.col("failure_bits").bitwiseAND(F.lit(base).cast("long")) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & rule_ledger.passes(rule_ledger.DEFAULT_POLICY)).alias("kept"),
        "failure_bits",
    )


def q_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op3")
    lengths = length_histogram.token_lengths(_table(spark, sf_dir, "documents"))
    histogram = work.saved(length_histogram.length_histogram(lengths, work), "histogram")
    work.drop("lengths")
    asked = F.lit(None).cast("string").alias("asked")
    at_limits = length_histogram.at_limits(histogram, list(CONTEXT_LIMITS))
    at_quantiles = length_histogram.at_quantiles(histogram, list(QUANTILES))
    return (
        histogram.select(asked, "*")
        .unionByName(at_limits.withColumn("asked", F.lit("limit")))
        .unionByName(
            at_quantiles.withColumn("asked", F.concat(F.lit("quantile "), F.col("quantile").cast("string")))
            .drop("quantile")
        )
    )


def _cut_content(text: Column, turn: Column) -> Column:
    """A text as two text parts, cut in the middle, with an attachment between them
    whose kind goes by the turn."""
    whole = F.coalesce(text, F.lit(""))
    half = F.floor(F.char_length(whole) / 2).cast("int")
    kinds = F.array(*(F.lit(k) for k in ("text", "image", "audio", "document")))
    kind = F.get(kinds, F.pmod(F.coalesce(turn, F.lit(0)), F.lit(4)).cast("int"))

    def part(type_: Column, text: Column, ref: Column) -> Column:
        return F.struct(
            type_.alias("type"), text.alias("text"), ref.alias("ref"),
            F.lit(None).cast("long").alias("tokens"),
        )

    none = F.lit(None).cast("string")
    return F.array(
        part(F.lit("text"), F.left(whole, half), none),
        part(kind, F.lit(""), F.concat(kind, F.lit("/"), turn.cast("string"))),
        part(F.lit("text"), F.substring(whole, half + 1, F.char_length(whole)), none),
    )


def q_content_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    formatted = content_parts.format_conversations(
        rows.unionByName(extra).withColumn("parts", _cut_content(F.col("text"), F.col("turn")))
    )
    turns = content_parts.read_turns(F.col("formatted"), placeholders=False)
    loss = content_parts.read_loss_text(F.col("formatted"), F.col("loss_mask"))
    read = formatted.select("*", turns.alias("turns"), loss.alias("loss"))
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "placeholder_tokens",
    )


def q_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_decontaminate.find_contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"),
        null_ids=True,
    )
    items = F.array_sort("bench_items")
    n_hit = F.aggregate(
        "bench_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]
    )
    return found.select(
        "doc_id", F.col("bench_n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def q_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op6")
    pieces = work.saved(two_fit_packing.token_pieces(_table(spark, sf_dir, "documents")), "pieces")
    return two_fit_packing.pack(pieces)


def _kept_digest(docs: DataFrame) -> DataFrame:
    """Word count, removed words and digest of the kept ones; ``spans`` may be null."""

    def digest(batches):
        for batch in batches:
            rows = {"n_words": [], "n_removed": [], "kept_sha256": []}
            for text, spans in zip(utf8(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                words = text.split() if text else []
                kept = cover_dedup.kept_words(words, spans) if spans else words
                rows["n_words"].append(len(words))
                rows["n_removed"].append(len(words) - len(kept))
                rows["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield rows | {"doc_id": batch.column(0), "row_fp": batch.column(1)}

    return arrow_map(
        docs.select("doc_id", "row_fp", "text", "spans"), digest,
        "doc_id long, row_fp long, n_words long, n_removed long, kept_sha256 string",
    )


def q_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(_table(spark, sf_dir, "documents"), "doc_id", "text")
    changed = _kept_digest(cover_dedup.repeated_spans(docs, Workspace(spark, "op7")))
    changed = changed.dropDuplicates(["doc_id", "row_fp"]).select(
        F.col("doc_id").alias("changed_id"), F.col("row_fp").alias("changed_fp"),
        F.col("n_removed").alias("gone"), F.col("kept_sha256").alias("left_sha256"),
    )
    whole = _kept_digest(docs.withColumn("spans", F.lit(None).cast("array<struct<first:int,last:int>>")))
    same = F.col("doc_id").eqNullSafe(F.col("changed_id")) & (F.col("row_fp") == F.col("changed_fp"))
    return whole.join(changed, same, "left").select(
        "doc_id", "n_words", F.coalesce("gone", "n_removed").alias("n_removed"),
        F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"),
    )


def q_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derivatives.derivatives(warc_derivatives.responses(_table(spark, sf_dir, "pages")))


def q_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bayes_minhash.near_duplicates(
        _table(spark, sf_dir, "documents"), Workspace(spark, "op10"), shingle_words=4
    )
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def q_frame_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op8")
    manifest = frame_store.write_token_files(_table(spark, sf_dir, "documents"), work.path("files"))
    return frame_store.read_tokens(manifest, with_ids=False)


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, Workspace(spark, "op11"), label=label
    )


def q_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel_shards.shard_documents(_table(spark, sf_dir, "documents"), Workspace(spark, "op12"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )


def q_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_ordinal_quality": q_ordinal_quality,
    "op2_rule_ledger": q_rule_ledger,
    "op3_length_histogram": q_length_histogram,
    "op4_content_parts": q_content_parts,
    "op5_fm_decontaminate": q_fm_decontaminate,
    "op6_best_two_fit": q_best_two_fit,
    "op7_cover_dedup": q_cover_dedup,
    "op8_frame_store": q_frame_store,
    "op9_warc_derivatives": q_warc_derivatives,
    "op10_bayes_minhash": q_bayes_minhash,
    "op11_hard_negatives": q_hard_negatives,
    "op12_feistel_shards": q_feistel_shards,
    "op13_fill_middle": q_fill_middle,
}

