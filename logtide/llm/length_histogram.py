"""Token counts: an exact histogram of encoded lengths.

Documents are counted by encoded length. Sums over the longer and shorter lengths
then answer, for every context limit, how many documents fit, how many tokens
there are, and how many remain when each document is cut at the limit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.tokens import Encoder, tokenizer_path
from logtide.llm.words import arrow_map
from logtide.llm.workspace import Workspace

BLOCK = 1024


def token_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row ``n_tokens`` per document; a null or empty text has 0."""
    path = tokenizer or tokenizer_path()

    def lengths(batches):
        encoder = Encoder(path)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield {"n_tokens": np.fromiter((len(encoder.encode(t)) // 4 for t in texts), np.int64)}

    return arrow_map(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), lengths, "n_tokens long")


def length_histogram(
    lengths: DataFrame, work: Workspace, column: str = "n_tokens"
) -> DataFrame:
    """One row per length that occurs: the exact histogram and its suffix sums.

    ``n_docs`` and ``n_tokens`` count the documents of that length.
    ``docs_at_least`` and ``tokens_at_least`` are the suffix sums from that length
    on; ``docs_up_to`` and ``tokens_up_to`` the rest with this length;
    ``truncated_tokens`` is the total when every document is cut at this length.
    Lengths are summed in blocks of 1,024 first, so that no task holds more than
    one block or one row per block. Null lengths are left out; no documents give
    no rows; documents of one length are one row, however many; other columns are not
    read. The counts are written, as two steps read them and making them means encoding
    every document.
    """
    counted = (
        lengths.where(F.col(f"`{column}`").isNotNull())
        .groupBy(F.col(f"`{column}`").cast("long").alias("length"))
        .agg(F.count("*").alias("n_docs"))
        .select(
            "length",
            "n_docs",
            (F.col("length") * F.col("n_docs")).alias("n_tokens"),
            F.floor(F.col("length") / BLOCK).alias("block"),
        )
    )
    rows = work.saved(counted, "lengths")
    blocks = rows.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens")
    )
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    inside = (
        Window.partitionBy("block").orderBy(F.col("length").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    sums = rows.join(blocks, "block").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(inside) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum("n_tokens").over(inside) + F.col("later_tokens")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    docs_before, tokens_before = (
        F.col("all_docs") - F.col("docs_at_least"),
        F.col("all_tokens") - F.col("tokens_at_least"),
    )
    return sums.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_at_least",
        "tokens_at_least",
        (docs_before + F.col("n_docs")).alias("docs_up_to"),
        (tokens_before + F.col("n_tokens")).alias("tokens_up_to"),
        (tokens_before + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """A row of the histogram's columns per context limit, whether its length occurs or not.

    ``docs_up_to`` documents fit the limit, and ``truncated_tokens`` are left when every
    document is cut at it. Both follow from the row next below the limit: its sums up
    to it, and the limit for each document above. One pass finds these rows for all
    limits; a limit below every length takes the sums of nothing. Without documents
    all counts are 0. A limit asked for twice has two rows.
    """

    def below(limit: int) -> Column:
        row = F.struct("length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least", "docs_up_to", "tokens_up_to")
        return F.max(F.when(F.col("length") <= limit, row))

    found = histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("all_docs"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("all_tokens"),
        F.array(
            *(F.struct(F.lit(int(x)).cast("long").alias("limit"), below(int(x)).alias("row")) for x in limits)
        ).alias("asked"),
    ).select("all_docs", "all_tokens", F.explode("asked").alias("a")).select(
        "all_docs", "all_tokens", F.col("a.limit").alias("length"), F.col("a.row").alias("row")
    )
    here = F.col("row.length") == F.col("length")

    def of(name: str) -> Column:
        return F.coalesce(F.col(f"row.{name}"), F.lit(0))

    above = F.col("all_docs") - of("docs_up_to")
    return found.select(
        "length",
        F.when(here, of("n_docs")).otherwise(0).alias("n_docs"),
        F.when(here, of("n_tokens")).otherwise(0).alias("n_tokens"),
        F.when(here, of("docs_at_least")).otherwise(above).alias("docs_at_least"),
        F.when(here, of("tokens_at_least")).otherwise(F.col("all_tokens") - of("tokens_up_to"))
        .alias("tokens_at_least"),
        of("docs_up_to").alias("docs_up_to"),
        of("tokens_up_to").alias("tokens_up_to"),
        (of("tokens_up_to") + F.col("length") * above).alias("truncated_tokens"),
    )


def at_quantiles(histogram: DataFrame, quantiles: list[float]) -> DataFrame:
    """The histogram row, with its ``quantile``, of the smallest length that at least
    that share of documents does not pass. Without documents there are none."""
    total = F.col("docs_up_to") + F.col("docs_at_least") - F.col("n_docs")
    row = F.struct(*histogram.columns)

    def first(quantile: float) -> Column:
        return F.struct(
            F.lit(float(quantile)).alias("quantile"),
            F.min(F.when(F.col("docs_up_to") >= F.lit(float(quantile)) * total, row)).alias("row"),
        )

    found = histogram.agg(F.explode(F.array(*(first(q) for q in quantiles))).alias("a"))
    return found.where("a.row IS NOT NULL").select("a.quantile", "a.row.*")
