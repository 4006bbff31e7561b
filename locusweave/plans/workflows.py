"""The five analyses from files to files, one Spark application each.

Each function returns the folders it wrote. Tables with several readers are
written once and read back, so no result is computed twice and a lost executor
never sends an analysis back to its raw input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusweave import schemas
from locusweave.functions.loci import chrom_name, chrom_number
from locusweave.operators import association, eqtl, hits, quality, regions, tf_binding
from locusweave.operators.ordering import genomic_sort
from locusweave.session import tune
from locusweave.sources import files, interval_store, lookup_store, sinks

# Column names of the two eQTL collections and their names here.
COLLECTION_A = {
    "#Chrom": "Chrom", "Pos": "position", "OA": "OA", "EA": "EA", "Variant_position_end": "Variant_position_end",
    "Gene_name": "gene_a", "Forward_nominal_P": "pval_a", "Source": "celltype_a",
}
COLLECTION_B = {
    "#Chrom": "Chrom", "Pos": "position", "ref": "ref", "alt": "alt", "eqtlcat_gene": "gene_b", "Source": "celltype_b",
}
GENOMIC_COLUMNS = ["OA", "EA", "EAF", "beta", "pval", "Marker", "phenotype"]


def land_references(
    spark: SparkSession, output: str, peaks: str | None = None, annotation: str | None = None, eqtls: str | None = None,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Peaks and genes as interval stores, a directory of eQTL tables as a store by variant ID.

    They are given to the analyses with ``landed_peaks``, ``landed_genes`` and ``landed``.

    Written once per release of the references; an analysis then reads the parts near its variants.
    """
    tune(spark)
    out = {}
    if peaks:
        out["peaks"] = f"{output}/peaks"
        interval_store.land_intervals(
            tf_binding.peak_table(files.read_peaks(spark, peaks)), out["peaks"], "chromosome", "peak_start", "peak_end", mode)
    if annotation:
        out["genes"] = f"{output}/genes"
        interval_store.land_intervals(
            regions.gene_table(files.read_annotation(spark, annotation)), out["genes"], "chromosome", "gene_start", "gene_end", mode)
    if eqtls:
        out["eqtls"] = f"{output}/eqtls"
        lookup_store.land_eqtls(files.read_eqtl_directory(spark, eqtls), out["eqtls"], mode)
    return out


def _report(rows: DataFrame, flag: Column, seen: Observation, name: str, path: str, mode: str) -> None:
    """Flagged rows per phenotype; ``rows`` are read only if some were seen while they were written.

    Where there are no rows at all, Spark leaves the aggregates out and nothing was seen.
    """
    counted = quality.flagged(rows, flag, name)
    some = not rows.isEmpty() and seen.get[name] > 0
    sinks.write_tsv(counted if some else rows.sparkSession.createDataFrame([], counted.schema), path, mode)


def post_process_gwas(
    spark: SparkSession,
    variant_info: str,
    results: str,
    output: str,
    run_name: str,
    pval_exponent: float = 6,
    window_buffer: int = 500_000,
    one_per_variant: bool = True,
    aliases: str | None = None,
    annotation: str | None = None,
    template_trait: str | None = None,
    bed: bool = True,
    strict: bool = True,
    landed_genes: bool = False,
    buckets: int = sinks.BUCKETS,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Hits per phenotype, combined hit table, Manhattan points, regions and region members.

    ``template_trait`` is the trait whose full statistics underlie the Manhattan
    table, the alphabetically first one by default. The text results are landed as
    Parquet first and read as text only then; malformed rows fail that step, or
    are counted in a report with ``strict`` off. Hits with unknown IDs and with
    markers that do not parse are reported as well; whether there are any is
    counted while the rows are written, and a report without rows reads nothing.
    Results and variant info are landed in ``buckets`` by ID. With ``landed_genes``,
    ``annotation`` is a gene store of ``land_references``, read near the hits only.
    """
    tune(spark)
    names = ("landed", "variant_info", "hits", "hit_tables", "combined", "points", "regions", "members", "unmatched", "unparsed", "malformed")
    out = {name: f"{output}/{name}" for name in names}
    name = hits.hits_table_name(run_name, f"{pval_exponent:g}", one_per_variant)
    out["hits_table"] = f"{output}/{name}"
    info_table = sinks.land_variant_info(files.read_variant_info(spark, variant_info), out["variant_info"], buckets, mode)
    info = spark.read.schema(schemas.VARIANT_INFO).parquet(out["variant_info"])
    malformed = F.lit(False) if strict else F.col("is_malformed")
    table, landing = quality.watch(files.read_gwas_results(spark, results, strict), num_malformed=F.count_if(malformed))
    result_table = sinks.land_results(table, out["landed"], buckets, mode)
    quality.require_rows(info_table, "variant info")
    quality.require_rows(result_table, "result directory")
    raw = spark.read.schema("ID string, beta double, chi2 double, phenotype string").parquet(out["landed"])
    if not strict:
        _report(result_table, malformed, landing, "num_malformed", out["malformed"], mode)

    unmatched, unparsed = ~F.col("is_known"), quality.marker_is_broken()
    table, annotated = quality.watch(
        hits.significant_hits(raw, info, pval_exponent, "is_known"),
        num_unmatched=F.count_if(unmatched), num_unparsed=F.count_if(unparsed))
    sinks.write_partitioned(table, out["hits"], "phenotype", ["chromosome", "position", "ID"], mode=mode)
    checked = spark.read.schema(T.StructType([*schemas.SUMSTATS.fields, T.StructField("is_known", T.BooleanType())])).parquet(out["hits"])
    found = checked.select(*schemas.SUMSTATS_COLUMNS)
    sinks.write_by_phenotype(found, out["hit_tables"], mode=mode)
    sinks.write_tsv(hits.all_hits([found], one_per_variant), out["hits_table"], mode)
    _report(checked, unmatched, annotated, "num_unmatched", out["unmatched"], mode)
    _report(checked, unparsed, annotated, "num_unparsed", out["unparsed"], mode)

    trait = template_trait or files.result_phenotypes(spark, results)[0]
    alias_map = files.read_alias_map(spark, aliases) if aliases else None
    combined = hits.combined_sumstats(hits.full_sumstats(result_table, info_table, trait), found, alias_map)
    combined.write.mode(mode).parquet(out["combined"])
    sinks.write_tsv(hits.manhattan_points(spark.read.parquet(out["combined"])), out["points"], mode)

    genes = None
    if annotation and landed_genes:
        genes = interval_store.read_near(spark, annotation, found, "chromosome", "position", regions.GENE_WINDOW)
    elif annotation:
        genes = regions.gene_table(files.read_annotation(spark, annotation))
    table = regions.hit_regions(found, genes, window_buffer, traits=regions.number_traits(found))
    sinks.write_regions(table, out["regions"], mode)
    sinks.write_by_region(regions.region_hits(files.read_regions(spark, out["regions"]), found, bed), out["members"], mode)
    return out


def look_up_eqtls(
    spark: SparkSession, eqtls: str, rsids: str, output: str, mode: str = "errorifexists", landed: bool = False
) -> str:
    """eQTLs of the listed IDs in every cell type, by chromosome, position and gene.

    With ``landed``, ``eqtls`` is a store of ``land_references``, of which only the row groups that may hold an ID are read.
    """
    tune(spark)
    wanted = files.read_value_list(spark, rsids, "rsid")
    found = lookup_store.look_up(spark, eqtls, wanted) if landed else eqtl.eqtl_lookup(files.read_eqtl_directory(spark, eqtls), wanted)
    ordered = found.orderBy(
        chrom_number(F.col("chromosome")), "position_hg38", "gene", "cell_type", "rsid", "pval", "slope")
    sinks.write_tsv(ordered.select("rsid", "chromosome", "position_hg38", "gene", "pval", "slope", "cell_type"), output, mode)
    return output


def _collection(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    rows = files.read_header_table(
        spark, path, schemas.text_columns(list(columns)), what="eQTL collection").toDF(*columns.values())
    numbered = rows.withColumn("chromosome", chrom_number(F.col("Chrom"))).drop("Chrom")
    doubles = {c: F.col(c).try_cast("double") for c in numbered.columns if c.startswith("pval")}
    return numbered.withColumns({"position": F.col("position").try_cast("bigint"), **doubles})


def find_candidate_genes(
    spark: SparkSession, variants: str, collection_a: str, collection_b: str, output: str, trim_alleles: bool = False,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Genes of the variants in the first collection, then of those also in the second, and a ranking of the first."""
    tune(spark)
    out = {name: f"{output}/{name}" for name in ("first", "both", "ranking")}
    table = files.read_header_table(spark, variants, schemas.SUMSTATS, what="variant table")
    table = table.select("chromosome", "position", *GENOMIC_COLUMNS)
    matched = eqtl.variant_allele_join(table, _collection(spark, collection_a, COLLECTION_A), trim_alleles=trim_alleles)
    matched.write.mode(mode).parquet(out["first"])
    first = spark.read.parquet(out["first"])
    both = eqtl.variant_allele_join(
        first, _collection(spark, collection_b, COLLECTION_B), oa="ref", ea="alt", trim_alleles=trim_alleles)
    extra = ["Variant_position_end", *GENOMIC_COLUMNS, "gene_a", "pval_a", "celltype_a", "gene_b", "celltype_b"]
    ordered = genomic_sort(both, "chromosome", "position").withColumn("Chrom", chrom_name(F.col("chromosome")))
    sinks.write_tsv(eqtl.to_genomic_table(ordered, "Chrom", "position", extra), out["both"], mode)
    sinks.write_tsv(eqtl.causal_gene_rank(first), out["ranking"], mode)
    return out


def prepare_motif_input(
    spark: SparkSession, variants: str, output: str, chunk_size: int = tf_binding.PREDICTOR_CHUNK, mode: str = "errorifexists"
) -> dict[str, str]:
    """VCF chunks for the motif predictor and the key map that its answers are matched with."""
    tune(spark)
    out = {name: f"{output}/{name}" for name in ("vcf", "key_map")}
    table = files.read_variant_list(spark, variants)
    sinks.write_vcf_chunks(tf_binding.vcf_projection(table, chunk_size), out["vcf"], mode)
    sinks.write_tsv(tf_binding.variant_key_map(table), out["key_map"], mode)
    return out


def find_bound_factors(
    spark: SparkSession, variants: str, peaks: str, motif_effects: str, output: str, motif_matrix: str | None = None,
    biotypes: str | None = None, threshold: float = 0.2, from_matrix: bool = False, landed_peaks: bool = False,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Peaks over the variants, motif changes, and the factors that have both.

    The factors come from all peaks and from the per-model motif table, or from
    the averaged matrix with ``from_matrix``. With ``landed_peaks``, ``peaks`` is a
    store of ``land_references``, read near the variants only.
    """
    tune(spark)
    out = {name: f"{output}/{name}" for name in ("peaks", "peaks_filtered", "effects", "matrix_effects", "factors")}
    table = files.read_variant_list(spark, variants)
    key_map = tf_binding.variant_key_map(table)

    loci = tf_binding.variant_positions(table)
    if landed_peaks:
        known = interval_store.read_near(spark, peaks, loci, "chromosome", "position")
    else:
        known = tf_binding.peak_table(files.read_peaks(spark, peaks))
    over = tf_binding.peak_overlap(loci, known)
    sinks.write_tsv(over, out["peaks"], mode, ["chr", "pos", "distance_to_peak"])
    peak_hits = spark.read.schema(over.schema).option("sep", "\t").option("header", True).csv(out["peaks"])
    if biotypes:
        kept = tf_binding.peak_biotype_filter(peak_hits, files.read_value_list(spark, biotypes, "biotype"))
        sinks.write_tsv(kept, out["peaks_filtered"], mode, ["chr", "pos", "distance_to_peak"])

    effects = tf_binding.motif_effects(files.read_motif_effects(spark, motif_effects), key_map, threshold)
    sinks.write_tsv(effects, out["effects"], mode, ["Chrom", "Pos"])
    if motif_matrix:
        averaged = tf_binding.motif_matrix_effects(files.read_motif_matrix(spark, motif_matrix), key_map, threshold)
        sinks.write_tsv(averaged, out["matrix_effects"], mode, ["Chrom", "Pos"])
        effects = averaged if from_matrix else effects
    factors = tf_binding.double_evidence_tfs(peak_hits, effects)
    sinks.write_tsv(factors, out["factors"], mode, ["Chr", "Pos"])
    return out


def run_gwas(
    spark: SparkSession, genotypes: str, variants: str, samples: str, phenotypes: str, output: str,
    sex: str | None = None, ancestry: str | None = None, min_af: float = association.MIN_ALLELE_FREQUENCY,
    min_p_hwe: float = association.MIN_HWE_P, mode: str = "errorifexists",
) -> dict[str, str]:
    """Association of every phenotype with every variant that passes quality control, and the inflation factors.

    ``genotypes`` and ``variants`` are Parquet; the sample-level inputs are text tables.
    """
    tune(spark)
    out = {name: f"{output}/{name}" for name in ("results", "inflation")}
    cohort = files.read_samples(spark, samples)
    traits = files.read_sample_values(spark, phenotypes)
    quality.require_shared(cohort, traits)
    covariates = None
    if sex:
        covariates = files.read_sample_values(spark, sex, "sex covariate table", width=2)
    if ancestry:
        axes = files.read_sample_values(spark, ancestry, "ancestry covariate table")
        covariates = axes if covariates is None else covariates.join(axes, "sample_id")
    fits = association.association(
        files.read_genotypes(spark, genotypes), cohort, traits, covariates, min_af, min_p_hwe)
    loci = schemas.require_columns(
        spark.read.parquet(variants), ["ID", "chromosome", "position", "OA", "EA"], "variant table")
    sinks.write_partitioned(
        association.gwas_table(fits, loci), out["results"], "phenotype", ["chromosome", "position", "rsid"], mode=mode)
    sinks.write_tsv(association.genomic_inflation(spark.read.parquet(out["results"])), out["inflation"], mode)
    return out
