"""A corpus pipeline over ``documents``, one operator a stage.

Every stage is written as Parquet and read again as the next one's documents. All
but the last keep the columns of the documents; where a stage shortens a text it
counts ``n_chars`` anew, and a document left without words goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import (
    bayes_minhash,
    cover_dedup,
    fm_decontaminate,
    rule_ledger,
    two_fit_packing,
)
from logtide.llm.words import arrow_map, unused, utf8
from logtide.llm.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy, as they are.

    Null and empty texts fail it. Repeated rows and ids are judged each by itself; no
    rows give no rows.
    """
    return docs.where(rule_ledger.accepted(F.col("text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id,
    and of texts that share it the one with the smallest hash.

    Of rows that are equal in id and text one stays. Texts that are not near-duplicates
    all stay, also under one id.
    """
    found = bayes_minhash.near_duplicates(docs, Workspace(spark, "stage-near"))
    # A text without words is a group of its own.
    alone = [F.when(F.col("group_no").isNull(), F.col(c)).alias(f"alone_{c}") for c in ("doc_id", "row_fp")]
    own = unused(docs.columns, "kept_")
    kept = (
        found.where("kept").groupBy("group_no", *alone)
        .agg(F.min(F.struct("doc_id", "row_fp")).alias("first"))
        .select(F.col("first.doc_id").alias(f"{own}id"), F.col("first.row_fp").alias(f"{own}fp"))
    )
    rows = docs.join(kept, _same_row(own), "left_semi").withColumn(f"{own}fp", _fingerprint())
    return rows.dropDuplicates(["doc_id", f"{own}fp"]).drop(f"{own}fp")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that an earlier document has.

    Null texts, empty ones and such without a repeated window are as they were; a text
    of which no word is left goes.
    """
    work = Workspace(spark, "stage-substring")
    found = cover_dedup.repeated_spans(docs, work)

    def cut(batches):
        for batch in batches:
            texts = zip(utf8(batch.column(2)), batch.column(3).to_pylist(), strict=True)
            yield {
                "cut_id": batch.column(0), "cut_fp": batch.column(1),
                "cut_text": [cover_dedup.without_spans(t, s).decode() for t, s in texts],
            }

    own = unused(docs.columns, "cut_")
    shorter = arrow_map(found, cut, "cut_id long, cut_fp long, cut_text string")
    shorter = shorter.dropDuplicates(["cut_id", "cut_fp"]).toDF(f"{own}id", f"{own}fp", f"{own}text")
    joined = docs.join(shorter, _same_row(own), "left")
    return _shortened(joined, docs.columns, F.col(f"{own}text"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``benchmark``.

    Null and empty texts and those without a passage are as they were; a text of which
    no word is left goes. Repeated rows and ids are searched each by itself.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = unused(docs.columns, "bench_")
    found = fm_decontaminate.find_contamination(
        docs, benchmark, prefix=own, cut_col=f"{own}cut", null_ids=True
    )
    return _shortened(found, docs.columns, F.col(f"{own}cut"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place there.

    A null or empty text is one piece of the end id; repeated rows and ids are packed
    each by itself; no rows give no rows.
    """
    work = Workspace(spark, "stage-packing")
    return two_fit_packing.pack(work.saved(two_fit_packing.token_pieces(docs), "pieces"))


def _same_row(own: str) -> Column:
    """Whether a row of the documents is the one named by an operator's answer."""
    return F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (_fingerprint() == F.col(f"{own}fp"))


def _fingerprint() -> Column:
    return F.xxhash64(F.col("text"))


def _shortened(rows: DataFrame, columns: list[str], new_text: Column) -> DataFrame:
    """``columns`` with the new text where there is one, if it still has a word."""
    text = F.coalesce(new_text, F.col("text"))
    changed = {"text": text}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(
            new_text.isNotNull(), F.char_length(new_text).cast("long")
        ).otherwise(F.col("n_chars")).alias("n_chars")
    still_there = new_text.isNull() | new_text.rlike(r"[^ \t-\r]")
    return rows.where(still_there).select(
        *(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in columns)
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]
#: Shingle similarity, tokenizer ids and packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; rows of the last one."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.saved(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
