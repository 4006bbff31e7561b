"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.tokens import VOCABULARY, encode

# Lengths are summed inside blocks of this many lengths first, then over the blocks.
BLOCK = 1024


def token_length(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of ids of each whole text; 0 for null."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([len(encode(t, vocabulary)) if t else 0 for t in batch], index=batch.index, dtype="int64")

    return count(text)


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``length, n_docs`` over every row of ``docs``; null and empty texts have length 0."""
    return docs.select(token_length(F.col("text"), vocabulary).alias("length")).groupBy("length").agg(
        F.count(F.lit(1)).alias("n_docs"))


def context_totals(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as context limit: what fits, what is cut, what remains.

    ``docs_longer`` and ``tokens_longer`` are suffix sums over greater lengths,
    ``truncated_tokens`` is the total with every document cut to the limit,
    ``quantile`` the share of documents that fit whole. No row for an empty
    histogram.
    """
    rows = histogram.select("length", "n_docs", F.floor(F.col("length") / BLOCK).alias("block"),
                            (F.col("length") * F.col("n_docs")).alias("tokens"))
    down = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block", (F.sum("block_docs").over(down) - F.col("block_docs")).alias("docs_above"),
        (F.sum("block_tokens").over(down) - F.col("block_tokens")).alias("tokens_above"),
        F.sum("block_docs").over(everything).alias("docs"), F.sum("block_tokens").over(everything).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.join(blocks, "block").select(
        "length", "n_docs", "tokens", "docs", "all_tokens",
        (F.col("docs_above") + F.sum("n_docs").over(inside) - F.col("n_docs")).alias("docs_longer"),
        (F.col("tokens_above") + F.sum("tokens").over(inside) - F.col("tokens")).alias("tokens_longer"))
    return summed.select(
        F.col("length").alias("context_limit"), "n_docs", F.col("all_tokens").alias("total_tokens"),
        (F.col("docs") - F.col("docs_longer")).alias("docs_fitting"), "docs_longer", "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("truncated_tokens"),
        ((F.col("docs") - F.col("docs_longer")) / F.col("docs")).alias("quantile"))


def totals_at(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """One row: the truncated total for each of ``limits``, in one pass over the histogram."""
    return histogram.agg(*[F.coalesce(F.sum(F.least("length", F.lit(n)) * F.col("n_docs")), F.lit(0)).alias(f"tokens_{n}")
                           for n in limits])


def quantile_length(totals: DataFrame, share: float) -> DataFrame:
    """The smallest length at which at least ``share`` of the documents fit whole; null if there are none."""
    return totals.where(F.col("quantile") >= share).agg(F.min("context_limit").alias("length"))
