"""Expression evidence: lookup by variant ID and allele-aware candidate joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locusweave.functions.loci import add_chr, trimmed_alleles
from locusweave.schemas import require_columns

ALLELE_KEYS = ["chromosome", "position", "OA", "EA"]


def eqtl_lookup(eqtls: DataFrame, rsids: DataFrame) -> DataFrame:
    """eQTL rows of the listed IDs, as a semi join on the distinct list."""
    wanted = rsids.select(F.col("rsid")).distinct()
    return eqtls.join(wanted, "rsid", "left_semi")


def to_genomic_table(df: DataFrame, chrom: str, pos: str, additional: list[str] | None = None) -> DataFrame:
    """Any table as a genomic one: ``#Chrom`` with ``chr`` prefix, ``Pos``, then the extra columns."""
    extra = [c.strip() for c in additional or []]
    require_columns(df, [chrom, pos, *extra], "genomic table input")
    return df.select(add_chr(F.col(chrom)).alias("#Chrom"), F.col(pos).alias("Pos"), *[F.col(c) for c in extra])


def _allele_keys(df: DataFrame, oa: str, ea: str, trim: bool) -> DataFrame:
    alleles = (
        trimmed_alleles(F.col("position"), F.col(oa), F.col(ea))
        if trim
        else F.struct(F.col("position").alias("pos"), F.col(oa).alias("oa"), F.col(ea).alias("ea"))
    )
    return df.withColumn("_key", alleles).select(
        *df.columns, F.col("_key.pos").alias("_pos"), F.col("_key.oa").alias("_oa"), F.col("_key.ea").alias("_ea"))


def variant_allele_join(
    variants: DataFrame, eqtls: DataFrame, oa: str = "OA", ea: str = "EA", trim_alleles: bool = False
) -> DataFrame:
    """Variants with the eQTL rows of the same locus and alleles.

    ``oa`` and ``ea`` name the allele columns of the eQTL side, whose locus and
    allele columns are consumed by the match. ``trim_alleles`` compares alleles
    after removing what both share at either end, so that differently padded
    spellings of an indel meet. The key has four parts; a hot variant is split by
    adaptive execution on either side.
    """
    left = _allele_keys(variants, "OA", "EA", trim_alleles)
    right = _allele_keys(eqtls, oa, ea, trim_alleles).drop("position", oa, ea)
    return left.join(right, ["chromosome", "_pos", "_oa", "_ea"]).drop("_pos", "_oa", "_ea")


def first_collection(eqtls: DataFrame) -> DataFrame:
    return eqtls.select(
        *ALLELE_KEYS, F.col("gene").alias("gene_a"), F.col("pval").alias("pval_a"),
        F.col("cell_type").alias("celltype_a"))


def second_collection(eqtls: DataFrame) -> DataFrame:
    return eqtls.select(
        "chromosome", "position", "ref", "alt", F.col("gene").alias("gene_b"), F.col("source").alias("celltype_b"))


def causal_gene_candidates(
    variants: DataFrame, eqtls_a: DataFrame, eqtls_b: DataFrame, mode: str = "chained", trim_alleles: bool = False
) -> DataFrame:
    """Variants with their genes from two eQTL collections.

    ``chained`` keeps variants found in both, one row per pair of matches.
    ``union`` lists the matches of each collection on their own, so its size is
    the sum and not the product of the matches of a variant. ``collapsed`` keeps
    both genes on one row without the product: the matches of the first, each with
    the sorted list ``genes_b`` of the genes that the second has for the variant.
    """
    a, b = first_collection(eqtls_a), second_collection(eqtls_b)
    with_a = variant_allele_join(variants, a, trim_alleles=trim_alleles)
    if mode == "chained":
        return variant_allele_join(with_a, b, oa="ref", ea="alt", trim_alleles=trim_alleles)
    if mode == "collapsed":
        keys = variants.select(*ALLELE_KEYS).distinct()
        genes = variant_allele_join(keys, b, oa="ref", ea="alt", trim_alleles=trim_alleles).groupBy(*ALLELE_KEYS).agg(
            F.sort_array(F.collect_set("gene_b")).alias("genes_b"))
        return with_a.join(genes, ALLELE_KEYS).select(*with_a.columns, "genes_b")
    if mode != "union":
        raise ValueError("mode must be 'chained', 'collapsed' or 'union'")
    with_b = variant_allele_join(variants, b, oa="ref", ea="alt", trim_alleles=trim_alleles)
    return (
        with_a.select(*variants.columns, F.lit("a").alias("collection"), F.col("gene_a").alias("gene"),
                      F.col("pval_a").alias("eqtl_pval"), F.col("celltype_a").alias("cell_type"))
        .unionByName(with_b.select(
            *variants.columns, F.lit("b").alias("collection"), F.col("gene_b").alias("gene"),
            F.lit(None).cast("double").alias("eqtl_pval"), F.col("celltype_b").alias("cell_type")))
    )


def causal_gene_rank(matches: DataFrame) -> DataFrame:
    """Genes of each variant by best eQTL p-value, with the number of supporting cell types.

    Takes the rows of the first join. Cell types are counted by grouping twice,
    both steps combining in the map tasks, instead of a distinct count per group.
    """
    per_cell = matches.groupBy(*ALLELE_KEYS, "gene_a", "celltype_a").agg(F.min("pval_a").alias("_pval"))
    per_gene = per_cell.groupBy(*ALLELE_KEYS, "gene_a").agg(
        F.min("_pval").alias("best_pval"), F.count(F.lit(1)).alias("num_cell_types"))
    order = Window.partitionBy(*ALLELE_KEYS).orderBy("best_pval", "gene_a")
    return per_gene.select(
        *ALLELE_KEYS, F.col("gene_a").alias("gene"), "best_pval", "num_cell_types",
        F.row_number().over(order).cast("bigint").alias("gene_rank"))
