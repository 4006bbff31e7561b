"""Genomic order and exact row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locusweave.functions.loci import LAST_CHROMOSOME

ORDINAL_BIN = 1 << 16
LAST_BIN = 1 << 15
COPY_BLOCK = 10_000


def genomic_sort(df: DataFrame, chrom: str, pos: str, *more: str) -> DataFrame:
    """Total order for a sink. All other columns break ties, so that a range
    partitioning can cut through a locus that holds very many rows."""
    lead = [chrom, pos, *more]
    rest = [c for c in df.columns if c not in lead]
    return df.orderBy(*[F.col(f"`{c}`") for c in lead + rest])


def _clamped(value: Column, low: int, high: int, missing: int) -> Column:
    bounded = F.least(F.greatest(value.cast("bigint"), F.lit(low)), F.lit(high))
    return F.when(value.isNull(), missing).otherwise(bounded)


def number_rows(df: DataFrame, chrom: str, pos: str, ties: list[str], name: str = "ordinal") -> DataFrame:
    """Add the 1-based rank of every row by chromosome number, position and ``ties``.

    Equal rows are counted before anything is ordered, so copies travel as one
    row. Ranks inside a bin come from a window over that bin; the rows before a
    bin come from the bin counts. Chromosome numbers and bins are clamped to fixed
    ranges, so that table has less than a million narrow rows whatever the input,
    which is why it may be summed in one task and broadcast.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    placed = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_chrom", _clamped(F.col(f"`{chrom}`"), 0, LAST_CHROMOSOME, LAST_CHROMOSOME + 1))
        .withColumn("_bin", _clamped(F.floor(F.col(f"`{pos}`") / ORDINAL_BIN), -1, LAST_BIN, -2))
    )
    before = Window.orderBy("_chrom", "_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_chrom", "_bin").agg(F.sum("_copies").alias("_rows"))
        .select("_chrom", "_bin", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # The chromosome leads inside a bin too, for numbers that were clamped together.
    inside = (
        Window.partitionBy("_chrom", "_bin").orderBy(F.col(f"`{chrom}`"), F.col(f"`{pos}`"), *[F.col(f"`{t}`") for t in ties])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        placed.join(F.broadcast(offsets), ["_chrom", "_bin"])
        .withColumn("_first", F.col("_offset") + F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    )
    # Copies are written out in two steps with an exchange in between, so that
    # one much-copied row is expanded by many tasks.
    blocks = ranked.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPY_BLOCK)))
    ).repartition("_chrom", "_bin", "_first", "_block")
    begin = F.col("_block") * COPY_BLOCK
    return blocks.withColumn(
        "_step", F.explode(F.sequence(begin + 1, F.least(F.col("_copies"), begin + COPY_BLOCK)))
    ).select(*columns, (F.col("_first") + F.col("_step")).alias(name))
