"""Genomic regions of hits: merging, lead variant, nearest gene and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locusweave.functions.loci import chrom_number, gene_name
from locusweave.operators.intervals import merge_intervals, nearest_start, overlap_join
from locusweave.operators.ordering import number_rows
from locusweave.schemas import REGION_COLUMNS
from locusweave.session import fits_broadcast, settle

NO_GENE = "NA"
GENE_WINDOW = 1_000_000
FIRST_BASE = 2


def gene_table(annotation: DataFrame, x_as_23: bool = True) -> DataFrame:
    """Genes of an annotation table: chromosome number, closed interval and the ``gene_name`` attribute.

    Without ``x_as_23`` genes of X keep no number and are never nearest to a hit, which is numbered 23 there.
    """
    return (
        annotation.filter(F.col("feature") == "gene").filter(F.lit(x_as_23) | ~F.col("seqname").isin("chrX", "X"))
        .select(
            chrom_number(F.col("seqname")).alias("chromosome"),
            F.col("start").alias("gene_start"),
            F.col("end").alias("gene_end"),
            gene_name(F.col("attributes")).alias("gene_name"),
        )
    )


def nearest_gene(loci: DataFrame, genes: DataFrame, window: int = GENE_WINDOW) -> DataFrame:
    """Add ``closest_gene``: by distance to the gene start, among genes within ``window`` of the position."""
    nearest = nearest_start(
        loci, genes, chrom="chromosome", pos="position", start="gene_start", end="gene_end", name="gene_name",
        window=window,
    ).select("chromosome", "position", F.col("gene_name").alias("closest_gene"))
    return (
        loci.join(nearest, ["chromosome", "position"], "left")
        .withColumn("closest_gene", F.coalesce("closest_gene", F.lit(NO_GENE)))
        .select(*loci.columns, "closest_gene")
    )


def number_traits(hits: DataFrame) -> DataFrame:
    """``phenotype, trait``: the traits of a hit table, numbered by name. A row per trait is all that is ordered."""
    distinct = hits.filter(F.col("phenotype").isNotNull()).select("phenotype").distinct()
    return distinct.withColumn("trait", F.row_number().over(Window.orderBy("phenotype")))


def hit_regions(
    hits: DataFrame, genes: DataFrame | None = None, window_buffer: int = 1_000_000, gene_window: int = GENE_WINDOW,
    traits: DataFrame | None = None,
) -> DataFrame:
    """Regions of hits whose windows of ``window_buffer`` up and down overlap or touch.

    Hits are combined before the shuffle to one row per locus, whose traits are a set of
    numbers, so however many traits meet at a locus, runs are found along distinct
    positions. Everything a region reports is carried through both merging
    steps; hits are never joined back. ``traits`` numbers the traits
    (``number_traits``); without it the located hits are settled, as finding the
    traits reads them once more. ``phenotypes`` is an array; text tables hold it by ``functions.traits``.
    """
    located = hits.filter(F.col("chromosome").isNotNull() & F.col("position").isNotNull()).select(
        "chromosome", "position", "phenotype", "pval", "chi2")
    if traits is None:
        located = settle(located)
        traits = number_traits(located)
    traits = settle(traits)
    traits = F.broadcast(traits) if fits_broadcast(traits) else traits
    per_locus = located.join(traits, "phenotype", "left").groupBy("chromosome", "position").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("pval", (-F.col("chi2")).alias("order"))).alias("best"), F.collect_set("trait").alias("traits"),
    )
    spans = per_locus.select(
        F.col("chromosome").alias("chrom"),
        F.greatest(F.lit(FIRST_BASE).cast("bigint"), F.col("position") - window_buffer).alias("chromStart"),
        (F.col("position") + window_buffer).alias("chromEnd"),
        "n", F.struct("best.pval", "best.order", "position").alias("lead"), "traits",
    )
    once = F.coalesce(F.col("_item_no"), F.lit(0)) == 0
    n = F.sum(F.when(once, F.col("n")))
    merged = merge_intervals(
        spans, "chrom", "chromStart", "chromEnd",
        first={"n": n, "lead": F.min("lead"), "traits": F.collect_set("_item")},
        again={"n": n, "lead": F.min("lead"), "traits": F.array_sort(F.collect_set("_name"))},
        longest=2 * window_buffer, spread="traits", names=traits.withColumnsRenamed({"trait": "_item", "phenotype": "_name"}),
    )
    regions = merged.select(
        "chrom", "chromStart", "chromEnd",
        F.col("lead.position").alias("leadSnp_pos"),
        F.col("lead.pval").alias("leadSnp_pval"),
        F.col("n").alias("num_included_variants"),
        F.size("traits").cast("bigint").alias("num_phenotypes"),
        F.col("traits").alias("phenotypes"),
    )
    if genes is None:
        return regions.withColumn("leadSnp_closest_gene", F.lit(NO_GENE)).select(*REGION_COLUMNS)
    # A region has one lead, so whole regions travel through the search and are not joined back.
    nearest = nearest_start(
        regions, genes.withColumnRenamed("chromosome", "chrom"), chrom="chrom", pos="leadSnp_pos", start="gene_start",
        end="gene_end", name="gene_name", window=gene_window,
        carry=[c for c in regions.columns if c not in ("chrom", "leadSnp_pos")],
    )
    return nearest.withColumn("leadSnp_closest_gene", F.coalesce("gene_name", F.lit(NO_GENE))).select(*REGION_COLUMNS)


def number_regions(regions: DataFrame) -> DataFrame:
    """Add ``region_id`` in genomic order and the ``region`` name ``region_<n>_chr<c>:<start>-<end>``."""
    numbered = number_rows(regions, "chrom", "chromStart", ["chromEnd"], "region_id")
    return numbered.withColumn("region", F.format_string(
        "region_%d_chr%d:%d-%d", "region_id", "chrom", "chromStart", "chromEnd"))


def region_hits(regions: DataFrame, hits: DataFrame, bed: bool = True) -> DataFrame:
    """Hits inside each region whose trait is on the region's list, for all regions in one pass.

    The list is taken apart and the trait becomes part of the join key, which
    spreads a region that holds very many hits over its traits. ``bed`` adds the end column ``position2`` of the BED layout.
    """
    named = number_regions(regions).select(
        F.col("chrom").alias("chromosome"), "chromStart", "chromEnd", "region_id", "region",
        F.explode(F.array_distinct("phenotypes")).alias("phenotype"),
    )
    columns = ["region_id", "region", "chromosome", "position", "EA", "pval", "phenotype"]
    points = hits.select("chromosome", "position", "EA", "pval", "phenotype")
    members = overlap_join(
        points, named, chrom="chromosome", pos="position", start="chromStart", end="chromEnd", by=["phenotype"],
    ).select(*columns)
    if not bed:
        return members
    return members.withColumn("position2", F.col("position")).select(
        *columns[:4], "position2", *columns[4:])
