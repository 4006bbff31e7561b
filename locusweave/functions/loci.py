"""Column expressions for chromosomes, markers, alleles and variant keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VARIANT_KEY = "Chrom:PosOA>EA"
LAST_CHROMOSOME = 25


def strip_chr(chrom: Column) -> Column:
    return F.replace(chrom.cast("string"), F.lit("chr"), F.lit(""))


def add_chr(chrom: Column) -> Column:
    text = chrom.cast("string")
    return F.when(text.startswith("chr"), text).otherwise(F.concat(F.lit("chr"), text))


def chrom_number(chrom: Column) -> Column:
    """1..22, X=23, Y=24, M=25 from names with or without ``chr``; other contigs give null.

    The input appears once in the expression, so a filter on the result that is
    pushed below the projection does not evaluate it again and again. A name that
    merely contains one of the letters becomes a number outside the table.
    """
    name = strip_chr(chrom)
    for letter, number in (("X", "23"), ("Y", "24"), ("MT", "25"), ("M", "25")):
        name = F.replace(name, F.lit(letter), F.lit(number))
    numbers = F.array(F.lit(None).cast("int"), *[F.lit(n) for n in range(1, LAST_CHROMOSOME + 1)])
    return F.get(numbers, name.try_cast("int"))


def chrom_name(number: Column) -> Column:
    """``chr1``..``chr22``, ``chrX``, ``chrY``, ``chrM`` from a chromosome number."""
    return F.concat(
        F.lit("chr"),
        F.when(number == 23, "X").when(number == 24, "Y").when(number == 25, "M")
        .otherwise(number.cast("string")),
    )


def gene_name(attributes: Column) -> Column:
    """``gene_name`` of a GTF attribute column, found by key."""
    return F.regexp_extract(attributes, 'gene_name "([^"]+)"', 1)


def parse_marker(df: DataFrame, marker: str = "Marker") -> DataFrame:
    """Split ``chr<c>:<pos>`` into ``chromosome`` and ``position``, writing X as 23 in the marker too.

    Chromosomes X, Y, M and MT get their numbers with or without ``chr``, and
    other numbers stay as they are. Markers that do not parse give nulls instead
    of failing the job; the quality operators count them.
    """
    sortable = F.regexp_replace(F.col(marker), "^chrX", "chr23")
    contig = F.split_part(F.col(marker), F.lit(":"), F.lit(1))
    return (
        df.withColumn(marker, sortable)
        .withColumn("chromosome", F.coalesce(chrom_number(contig), strip_chr(contig).try_cast("int")))
        .withColumn("position", F.split_part(F.col(marker), F.lit(":"), F.lit(2)).try_cast("bigint"))
    )


def locus_text(chrom: Column, pos: Column) -> Column:
    """``<chr>:<pos>`` without the ``chr`` prefix."""
    return F.concat_ws(":", strip_chr(chrom), pos.cast("string"))


def variant_key(chrom: Column, pos: Column, oa: Column, ea: Column) -> Column:
    """``<Chrom>:<Pos><OA>><EA>``, the key the motif predictor reports."""
    return F.concat(chrom.cast("string"), F.lit(":"), pos.cast("string"), oa, F.lit(">"), ea)


def peak_centre(start: Column, end: Column) -> Column:
    """Truncated midpoint of non-negative coordinates."""
    return F.floor((start + end) / 2).cast("bigint")


def _shared(a: Column, b: Column, take, longest: Column) -> Column:
    # Sharing k letters implies sharing every shorter run, so the number of
    # matching lengths is the length of the shared run.
    lengths = F.when(longest >= 1, F.sequence(F.lit(1), longest)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(lengths, lambda k: take(a, k) == take(b, k)))


def trimmed_alleles(pos: Column, oa: Column, ea: Column) -> Column:
    """Struct ``pos, oa, ea`` with shared suffix, then shared prefix removed, one letter kept on both sides."""
    spare = F.least(F.length(oa), F.length(ea)) - 1
    suffix = _shared(oa, ea, lambda s, k: F.right(s, k), spare)
    left_oa = F.substring(oa, F.lit(1), F.length(oa) - suffix)
    left_ea = F.substring(ea, F.lit(1), F.length(ea) - suffix)
    prefix = _shared(left_oa, left_ea, lambda s, k: F.left(s, k), spare - suffix)
    return F.struct(
        (pos + prefix).alias("pos"),
        F.substring(left_oa, prefix + 1, F.length(left_oa)).alias("oa"),
        F.substring(left_ea, prefix + 1, F.length(left_ea)).alias("ea"),
    )
