"""Interval tables landed so that a lookup by position reads the files around the positions only.

An interval is stored once, in the cell of its chromosome, the finest level at
which it touches two bins at most, and the bin it starts in. A position then needs
two cells per level, and Spark prunes all other partitions when it runs, by the
distinct cells of the positions it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.sources.sinks import write_partitioned

LEVELS = (20, 23, 26, 29)  # bins of 1, 8, 64 and 512 million bases
LONGER = 63  # the level of intervals that are too long for all of these, one cell per chromosome
LAST_BIN = 1 << 12  # bins beyond are one, so that the cells of a chromosome have a fixed bound


def _cell(chrom: Column, level: int, bin_: Column) -> Column:
    bounded = F.least(F.greatest(bin_, F.lit(0)), F.lit(LAST_BIN))
    return F.shiftleft(chrom.cast("bigint"), 32) + F.lit(level << 16).cast("bigint") + bounded


def _own_cell(chrom: str, start: str, end: str) -> Column:
    first = lambda k: F.shiftright(F.col(start).cast("bigint"), k)
    cell = _cell(F.col(chrom), LONGER, F.lit(0))
    for k in reversed(LEVELS):
        last = F.shiftright(F.col(end).cast("bigint"), k)
        cell = F.when(last - first(k) <= 1, _cell(F.col(chrom), k, first(k))).otherwise(cell)
    return cell


def land_intervals(df: DataFrame, path: str, chrom: str, start: str, end: str, mode: str = "errorifexists") -> None:
    """Writes the intervals with chromosome number, start and end in order; others can match no position and stay out."""
    valid = df.filter(F.col(chrom).isNotNull() & (F.col(start) <= F.col(end)))
    write_partitioned(valid.withColumn("cell", _own_cell(chrom, start, end)), path, "cell", [start], "parquet", mode)


def wanted_cells(loci: DataFrame, chrom: str, pos: str, reach: int = 0) -> DataFrame:
    """Distinct ``cell`` that can hold an interval within ``reach`` of a position.

    There are at most ``len(LEVELS) * LAST_BIN`` and a few per chromosome number.
    """
    at = F.col(pos).cast("bigint")

    def around(level: int) -> Column:
        low, high = F.shiftright(at - reach, level) - 1, F.shiftright(at + reach, level)
        bounded = lambda b: F.least(F.greatest(b, F.lit(0)), F.lit(LAST_BIN))
        return F.transform(F.sequence(bounded(low), bounded(high)), lambda b: _cell(F.col(chrom), level, b))

    bins = [*[around(k) for k in LEVELS], F.array(_cell(F.col(chrom), LONGER, F.lit(0)))]
    return loci.filter(F.col(chrom) >= 0).filter(at >= 0).select(F.explode(F.flatten(F.array(*bins))).alias("cell")).distinct()


def read_near(spark: SparkSession, path: str, loci: DataFrame, chrom: str, pos: str, reach: int = 0) -> DataFrame:
    """Landed intervals in the cells around ``loci``, each once: all that lie within ``reach`` of a position, and others near by.

    The cells are broadcast, their number being bounded, and prune the partitions
    to read.
    """
    cells = F.broadcast(wanted_cells(loci, chrom, pos, reach).withColumnRenamed("cell", "_cell"))
    stored = spark.read.parquet(path)
    return stored.join(cells, F.col("cell") == F.col("_cell"), "left_semi").drop("cell")
