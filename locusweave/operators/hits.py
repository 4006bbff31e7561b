"""Association results: significance, annotation, best trait, combination and plot points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locusweave.functions.loci import LAST_CHROMOSOME, parse_marker
from locusweave.functions.stats import chi2_isf, chi2_sf, neg_log10_p
from locusweave.operators.ordering import genomic_sort
from locusweave.schemas import SUMSTATS_COLUMNS, require_columns

NO_ALIAS = "<no data>"
OTHER_ALIAS = "Other"

# The lines of the Manhattan plot, in -log10 p.
GENOME_WIDE_LINE = 7.301029995664
SIGNIFICANT_LINE = 11.0


def annotate(results: DataFrame, variant_info: DataFrame, known: str | None = None) -> DataFrame:
    """Results with p-value and locus, in the 12-column layout. Unmatched IDs keep null loci.

    With ``known``, a column of that name says whether the ID has variant information.

    The join runs on the variant ID; variant info has one row per ID, so rows never
    multiply, and a variant with very many results is split by adaptive execution.
    """
    info = parse_marker(variant_info.select("ID", "Marker", "OA", "EA", "EAF", "Info")).withColumn("_known", F.lit(True))
    flag = [] if known is None else [F.coalesce("_known", F.lit(False)).alias(known)]
    return (
        results.join(info, "ID", "left")
        .withColumn("pval", chi2_sf("chi2"))
        .select(*SUMSTATS_COLUMNS, *flag)
    )


def significant_hits(
    results: DataFrame, variant_info: DataFrame, pval_exponent: float = 6, known: str | None = None
) -> DataFrame:
    """Results with p below ``10 ** -pval_exponent``, annotated.

    The threshold is turned into a chi-square value once, so the filter is a plain
    comparison that reaches the scan, and p-values are computed for survivors only.
    """
    require_columns(results, ["ID", "beta", "chi2", "phenotype"], "results")
    threshold = chi2_isf(10.0 ** -float(pval_exponent))
    return annotate(results.filter(F.col("chi2") > F.lit(threshold)), variant_info, known)


def full_sumstats(results: DataFrame, variant_info: DataFrame, phenotype: str | None = None) -> DataFrame:
    """Unfiltered summary statistics of one trait, or of all traits at once."""
    if phenotype is not None:
        results = results.filter(F.col("phenotype") == phenotype)
    return annotate(results, variant_info)


def best_per_variant(hits: DataFrame) -> DataFrame:
    """The strongest association of each variant.

    ``row_number() = 1`` lets Spark keep one row per variant in every map task
    before the shuffle, so a variant with many traits does not grow a task.
    """
    order = Window.partitionBy("ID").orderBy(
        F.col("pval"), F.col("chi2").desc(), F.col("phenotype"), F.col("beta"), F.col("Marker"), F.col("OA"),
        F.col("EA"), F.col("EAF"), F.col("Info"),
    )
    return hits.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def all_hits(tables: list[DataFrame], one_per_variant: bool = False) -> DataFrame:
    """Hit tables of all traits together in genomic order, optionally one row per variant."""
    union = tables[0].select(*SUMSTATS_COLUMNS)
    for table in tables[1:]:
        union = union.unionByName(table.select(*SUMSTATS_COLUMNS))
    if one_per_variant:
        union = best_per_variant(union)
    return genomic_sort(union, "chromosome", "position")


def hits_table_name(run: str, pval_exponent: str = "", one_per_variant: bool = True) -> str:
    """Name of the combined hits table: run, threshold and kind."""
    threshold = f"_10E{pval_exponent}" if pval_exponent else ""
    kind = "one_pheno_only_per_variant" if one_per_variant else "all_phenotypes_per_variant"
    return f"{run}_hits_only{threshold}_{kind}"


def unique_aliases(alias_map: DataFrame) -> DataFrame:
    """One alias per phenotype; of several lines for a phenotype the last in file order is not
    known to a distributed read, so the greatest alias is taken."""
    return alias_map.groupBy("phenotype").agg(F.max("alias").alias("alias"))


def assign_alias(hits: DataFrame, alias_map: DataFrame | None) -> DataFrame:
    """Add ``alias``: the mapped name, a marker for unmapped phenotypes, or the phenotype without a map."""
    if alias_map is None:
        return hits.withColumn("alias", F.col("phenotype"))
    return (
        hits.join(unique_aliases(alias_map), "phenotype", "left")
        .withColumn("alias", F.coalesce("alias", F.lit(NO_ALIAS)))
        .select(*hits.columns, "alias")
    )


def count_aliases(table: DataFrame) -> DataFrame:
    return table.agg(F.count_distinct("alias").alias("num_aliases"))


def combined_sumstats(
    template: DataFrame, hits: DataFrame, alias_map: DataFrame | None, prefer: str = "template", replace: bool = False
) -> DataFrame:
    """Template rows and hits of all traits, equal 12-column rows once, with aliases.

    Template rows carry no alias. Which of two equal rows stays is decided by
    ``prefer``. Only the source rank is aggregated, so copies collapse before the
    shuffle, and the alias follows from source and phenotype afterwards. With
    ``replace``, hits take the place of all template rows of their variant.
    """
    if prefer not in ("template", "hits"):
        raise ValueError("prefer must be 'template' or 'hits'")
    if replace:
        template = template.join(hits.select("ID").distinct(), "ID", "left_anti")
    from_hits = F.lit(1 if prefer == "template" else -1)
    rows = (
        template.select(*SUMSTATS_COLUMNS).withColumn("_source", F.lit(0))
        .unionByName(hits.select(*SUMSTATS_COLUMNS).withColumn("_source", from_hits))
        .groupBy(*SUMSTATS_COLUMNS).agg(F.min("_source").alias("_source"))
    )
    aliased = assign_alias(rows, alias_map)
    alias = F.when(F.col("_source") == 0, NO_ALIAS).otherwise(F.col("alias"))
    return aliased.select(*SUMSTATS_COLUMNS, alias.alias("alias"))


def manhattan_points(table: DataFrame) -> DataFrame:
    """Plot coordinates: ``x`` runs through the chromosomes one after the other, ``y`` is -log10 p,
    also where p is too small for a double.

    Chromosome lengths are one row per chromosome number, at most 25 by the
    filter, so their running sum is one small task and is broadcast.
    """
    known = F.col("chromosome").between(1, LAST_CHROMOSOME)
    earlier = Window.orderBy("chromosome").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.filter(known).groupBy("chromosome").agg(F.max("position").alias("_length"))
        .select("chromosome", F.coalesce(F.sum("_length").over(earlier), F.lit(0)).alias("_offset"))
    )
    y = neg_log10_p(F.col("pval"), F.col("chi2"))
    return (
        table.filter(known).join(F.broadcast(offsets), "chromosome")
        .withColumn("x", F.col("_offset") + F.col("position"))
        .withColumn("y", y)
        .withColumn("is_genome_wide", F.col("y") > GENOME_WIDE_LINE)
        .withColumn("is_significant", F.col("y") > SIGNIFICANT_LINE)
        .drop("_offset")
    )


def manhattan_thinned(
    points: DataFrame, keep_above: float = GENOME_WIDE_LINE, x_width: int = 100_000, y_width: float = 0.1
) -> DataFrame:
    """A lighter plot table: every point above a line, and below it the highest point of each drawn cell.

    Only for drawing; the point table itself stays whole. A cell's highest point
    is picked in the map tasks first, as in ``best_per_variant``.
    """
    high = F.col("y") > keep_above
    cell: list[Column] = [
        F.col("chromosome"), F.floor(F.col("x") / x_width), F.floor(F.col("y") / y_width), high,
    ]
    order = Window.partitionBy(*cell).orderBy(F.col("y").desc(), F.col("x"), F.col("ID"), F.col("phenotype"), F.col("alias"))
    low = points.filter(~F.coalesce(high, F.lit(False)))
    thinned = low.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    return points.filter(high).unionByName(thinned)
