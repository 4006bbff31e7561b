"""Data-quality reports: what the strict checks of a batch script would have stopped at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from locusweave.functions.loci import LAST_CHROMOSOME

LOCUS_PATTERN = "^(chr)?([0-9]+|X|Y|M|MT):[0-9]+$"


def watch(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are taken in the pass that writes it, and where to read them afterwards.

    A task that is run again after a lost executor may be counted twice, so these
    numbers only tell whether there is anything to report. What a report says is
    counted from flags written with the rows.
    """
    seen = Observation()
    return df.observe(seen, *[count.alias(name) for name, count in counts.items()]), seen


def flagged(df: DataFrame, flag: Column, name: str) -> DataFrame:
    """Rows per phenotype for which ``flag`` holds, as ``name``; phenotypes without any are left out."""
    return df.groupBy("phenotype").agg(F.count_if(flag).alias(name)).filter(F.col(name) > 0)


def locus_quality(df: DataFrame, locus: str) -> DataFrame:
    """Counts of well-formed, malformed, prefixed and missing locus texts."""
    text = F.col(locus)
    good = text.rlike(LOCUS_PATTERN)
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(text.isNull()).alias("num_missing"),
        F.count_if(good).alias("num_valid"),
        F.count_if(~good).alias("num_malformed"),
        F.count_if(good & text.startswith("chr")).alias("num_prefixed"),
    )


def unmatched_hits(hits: DataFrame, variant_info: DataFrame) -> DataFrame:
    """Hits per phenotype whose ID is unknown to the variant table."""
    unknown = hits.join(variant_info.select("ID"), "ID", "left_anti")
    return unknown.groupBy("phenotype").agg(F.count(F.lit(1)).alias("num_unmatched"))


def marker_is_broken() -> Column:
    """Whether a row has a marker but no locus from it, or one on a chromosome that does not exist."""
    placed = F.col("chromosome").between(1, LAST_CHROMOSOME) & F.col("position").isNotNull()
    return F.col("Marker").isNotNull() & ~F.coalesce(placed, F.lit(False))


def unparsed_markers(annotated: DataFrame) -> DataFrame:
    """Rows per phenotype whose marker is broken."""
    return flagged(annotated, marker_is_broken(), "num_unparsed")


def require_rows(df: DataFrame, what: str) -> None:
    """Fail on an input without rows; looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"the {what} holds no rows")


def sample_overlap(samples: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Sizes of both ID sets and of their intersection, each ID counted once.

    Both sides are tagged and grouped by ID, one shuffle instead of a join and two counts.
    """
    tagged = (
        samples.select(F.col("sample_id"), F.lit(1).alias("_s"), F.lit(0).alias("_p"))
        .unionByName(phenotypes.select(F.col("sample_id"), F.lit(0).alias("_s"), F.lit(1).alias("_p")))
        .groupBy("sample_id").agg(F.max("_s").alias("_s"), F.max("_p").alias("_p"))
    )
    return tagged.agg(
        F.count_if(F.col("_s") == 1).alias("num_samples"),
        F.count_if(F.col("_p") == 1).alias("num_phenotyped"),
        F.count_if((F.col("_s") == 1) & (F.col("_p") == 1)).alias("num_shared"),
    )


def shared_samples(samples: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """IDs present in both tables."""
    return samples.select("sample_id").intersect(phenotypes.select("sample_id"))


def require_shared(samples: DataFrame, phenotypes: DataFrame) -> None:
    """Fail when no sample is shared; looks for one row only."""
    if shared_samples(samples, phenotypes).isEmpty():
        raise ValueError("no sample IDs are shared between the sample table and the phenotype table")
