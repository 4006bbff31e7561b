"""Outputs. Ordered files come from range partitions, so no output passes through one task."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.functions.traits import encode_traits
from locusweave.operators.ordering import genomic_sort
from locusweave.session import settle

# Characters removed from a name, and characters trimmed off its ends.
UNSAFE_IN_NAMES = ' <>:"/\\|?*'
TRIMMED_FROM_NAMES = " ."

# Tasks of a join of one phenotype's results with variant info.
BUCKETS = 64


def safe_name(name: Column) -> Column:
    """A column value as a file or folder name."""
    return F.btrim(F.translate(name, UNSAFE_IN_NAMES, ""), F.lit(TRIMMED_FROM_NAMES))


# Plain tab-separated text: no quoting, nulls and empty texts as nothing. The comment
# character is moved away from ``#``, or a header such as ``#Chrom`` would be quoted.
TSV = {"sep": "\t", "header": "true", "quote": "\u0000", "comment": "\u0001", "nullValue": "", "emptyValue": ""}


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", order: list[str] | None = None) -> None:
    """Plain text table, with ``order`` in genomic order by these columns (chromosome, position, more).

    Finding the ranges of an ordered output reads the rows once before they are
    written, so they are settled first and computed once.
    """
    rows = df if order is None else settle(df)
    (rows if order is None else genomic_sort(rows, *order)).write.mode(mode).options(**TSV).csv(path)
    if order is not None:
        rows.unpersist()


def write_partitioned(
    df: DataFrame, path: str, by: str, order: list[str], file_format: str = "parquet", mode: str = "errorifexists"
) -> None:
    """One folder per value of ``by``, rows in ``order`` inside it.

    Rows are placed by range of value, order and then all other columns, so a small
    value lands in one file and a value or place with very many rows is written by
    many tasks. Rows are settled before their ranges are looked for, so they are
    computed once.
    """
    lead = [by, *order]
    keys = [F.col(f"`{c}`") for c in lead + [c for c in df.columns if c not in lead]]
    settled = settle(df)
    rows = settled.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = rows.write.mode(mode).partitionBy(by)
    if file_format == "csv":
        writer = writer.options(**TSV)
    writer.format(file_format).save(path)
    settled.unpersist()


def write_by_phenotype(df: DataFrame, path: str, file_format: str = "csv", mode: str = "errorifexists") -> None:
    """Summary statistics or hits, one folder per phenotype in genomic order."""
    named = df.withColumn("phenotype_name", safe_name(F.col("phenotype")))
    write_partitioned(named, path, "phenotype_name", ["chromosome", "position", "ID"], file_format, mode)


def write_regions(regions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Region table in genomic order, its trait lists as text."""
    coded = regions.withColumn("phenotypes", encode_traits(F.col("phenotypes")))
    write_tsv(coded, path, mode, ["chrom", "chromStart"])


def write_by_region(members: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Region members, one folder per region."""
    write_partitioned(members, path, "region", ["chromosome", "position", "phenotype"], "csv", mode)


def write_vcf_chunks(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Predictor input, one folder per chunk. A chunk is one sorted file, small by construction."""
    plain = rows.repartition("chunk").sortWithinPartitions("chunk", "ordinal").drop("ordinal")
    plain.write.mode(mode).partitionBy("chunk").options(**TSV).csv(path)


def land_bucketed(
    df: DataFrame, path: str, key: str, buckets: int, by: str | None = None, order: str | None = None, mode: str = "errorifexists"
) -> DataFrame:
    """One-time landing as an external table bucketed by a join key, and the table read back.

    Two tables landed with the same key and count, such as results and variant
    info by ``ID``, join without moving either side. Rows are moved to their
    bucket's file by hash, so nothing is computed twice to find ranges; adaptive
    execution cuts a bucket with very many rows into several files. ``by`` adds a
    folder per value, and files are sorted by ``order``, the key by default.
    """
    table = f"landed_{crc32(path.encode()):08x}"
    bucket = F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets))
    rows = df.withColumn("_bucket", bucket).hint("rebalance", *([F.col(f"`{by}`")] if by else []), F.col("_bucket")).drop("_bucket")
    writer = rows.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, key).sortBy(order or key)
    (writer.partitionBy(by) if by else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def land_results(df: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "errorifexists") -> DataFrame:
    """One-time landing of text results as Parquet, by phenotype and bucketed by ID.

    Files are sorted so that chi-square filters skip row groups. A read of ``path``
    cuts the files by size, as a filter over all phenotypes wants it; the table
    returned joins a phenotype to variant info without an exchange.
    """
    return land_bucketed(df, path, "ID", buckets, "phenotype", "chi2", mode)


def land_variant_info(df: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "errorifexists") -> DataFrame:
    """One-time landing of variant info, bucketed like the results."""
    return land_bucketed(df, path, "ID", buckets, mode=mode)
