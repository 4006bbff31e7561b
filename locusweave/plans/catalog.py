"""Every registered query: fixture tables in, operator applied, comparable columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.functions.loci import chrom_name, chrom_number, gene_name, locus_text, parse_marker
from locusweave.functions.stats import chi2_sf
from locusweave.functions.traits import encode_traits
from locusweave.operators import association, eqtl, hits, quality, regions, tf_binding
from locusweave.plans.fixtures import Tables
from locusweave.session import settle, tune
from locusweave.sources.files import cell_type_from_filename, motif_matrix_cells, phenotype_from_filename

TEMPLATE_TRAIT = "trait_0"
WINDOW_BUFFER = 20_000
VCF_CHUNK = 300
SAFE_BIOTYPES = ["1-URGENT", "5-LOW"]
FACTORS = 50
MATRIX_VARIANTS = 2_000


def nine_digits(value: Column) -> Column:
    """Nine significant digits, so that engines whose exponentials differ in the last bit agree."""
    return F.when(value.isNotNull(), F.format_string("%.8e", value).try_cast("double"))


def _short_pval(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: nine_digits(F.col(n)) for n in names or ("pval",)})


def _hits(t: Tables) -> DataFrame:
    return hits.significant_hits(t.gwas, t.vi)


def _regions(t: Tables, found: DataFrame | None = None) -> DataFrame:
    return regions.hit_regions(_hits(t) if found is None else found, t.genes, WINDOW_BUFFER)


def _combined(t: Tables) -> DataFrame:
    return hits.combined_sumstats(hits.full_sumstats(t.gwas, t.vi, TEMPLATE_TRAIT), _hits(t), t.alias_map)


def _candidate_variants(t: Tables) -> DataFrame:
    return _hits(t).select("ID", "chromosome", "position", "OA", "EA", "EAF", "beta", "phenotype")


def _peak_hits(t: Tables, per_factor: bool = False) -> DataFrame:
    return tf_binding.peak_overlap(tf_binding.variant_positions(t.vlist), t.peaks, per_factor)


def _motif_effects(t: Tables) -> DataFrame:
    return tf_binding.motif_effects(t.effects, tf_binding.variant_key_map(t.vlist))


def _matrix_cells(t: Tables) -> DataFrame:
    """The motif matrices written as text, one per predictor run with a header and a line per factor, and read back as cells.

    Variants are dealt to runs of about ``MATRIX_VARIANTS``, so no row, list or header grows with their number.
    """
    runs = max(1, -(-t.vlist.count() // MATRIX_VARIANTS))
    cell = F.when(F.col("TF").isNotNull(), F.struct("TF", "score"))
    by_variant = (
        t.matrix_cells.filter("variant IS NOT NULL")
        .withColumn("matrix", F.pmod(F.xxhash64("variant"), F.lit(runs))).repartition("matrix")
        .groupBy("matrix", "variant").agg(F.map_from_entries(F.collect_list(cell)).alias("scores"))
    )
    matrices = by_variant.groupBy("matrix").agg(F.collect_list(F.struct("variant", "scores")).alias("columns"))

    def line(factor: Column) -> Column:
        score = F.transform(F.col("columns.scores"), lambda scores: F.coalesce(scores[factor], F.lit("")))
        return F.concat_ws("\t", factor, score)

    factors = F.array(*[F.lit(f"TF{i}") for i in range(FACTORS)])
    header = F.concat_ws("\t", F.lit(""), F.col("columns.variant"))
    text = settle(matrices.select("matrix", F.posexplode(F.concat(F.array(header), F.transform(factors, line))).alias("line", "value")))
    return motif_matrix_cells(text.filter("line = 0"), text.filter("line > 0"), "matrix")


def _matrix_effects(t: Tables) -> DataFrame:
    return tf_binding.motif_matrix_effects(_matrix_cells(t), tf_binding.variant_key_map(t.vlist))


def scan_variant_info(t: Tables) -> DataFrame:
    return t.vi


def scan_gwas_results(t: Tables) -> DataFrame:
    return t.gwas


def phenotype_from_file_name(t: Tables) -> DataFrame:
    phenotype = phenotype_from_filename(F.col("file_name")).alias("phenotype")
    return t.result_files.select("file_name", "ID", "beta", "chi2", phenotype)


def cell_type_from_file_name(t: Tables) -> DataFrame:
    named = t.eqtl_a.withColumn("file_name", F.concat("cell_type", F.lit("_cells_eqtl_full_v1.txt")))
    return named.select("rsid", "gene", "file_name", cell_type_from_filename(F.col("file_name")).alias("cells"))


def parsed_markers(t: Tables) -> DataFrame:
    return parse_marker(t.vi.select("ID", "Marker"))


def normalized_chromosomes(t: Tables) -> DataFrame:
    number = chrom_number(F.col("Chrom"))
    return t.vlist.select(
        "ID", number.alias("chrom_number"), chrom_name(number).alias("chrom_name"),
        locus_text(F.col("Chrom"), F.col("Pos")).alias("chr_pos"))


def chi2_pvalue(t: Tables) -> DataFrame:
    return t.gwas.select("ID", "phenotype", nine_digits(chi2_sf("chi2")).alias("pval"))


def significant_hits(t: Tables) -> DataFrame:
    return _short_pval(_hits(t))


def full_sumstats(t: Tables) -> DataFrame:
    return _short_pval(hits.full_sumstats(t.gwas, t.vi))


def best_pheno_per_variant(t: Tables) -> DataFrame:
    return _short_pval(hits.best_per_variant(_hits(t)))


def all_hits_table(t: Tables) -> DataFrame:
    found, early = _hits(t), F.col("phenotype") < "trait_3"
    return _short_pval(hits.all_hits([found.filter(early), found.filter(~early)]))


def all_hits_one_per_variant(t: Tables) -> DataFrame:
    found, early = _hits(t), F.col("phenotype") < "trait_3"
    return _short_pval(hits.all_hits([found.filter(early), found.filter(~early)], one_per_variant=True))


def alias_assign(t: Tables) -> DataFrame:
    return _short_pval(hits.assign_alias(_hits(t), t.alias_map))


def alias_count(t: Tables) -> DataFrame:
    return hits.count_aliases(_combined(t))


def combined_sumstats(t: Tables) -> DataFrame:
    return _short_pval(_combined(t))


def _region_text(table: DataFrame) -> DataFrame:
    return _short_pval(table, "leadSnp_pval").withColumn("phenotypes", encode_traits(F.col("phenotypes")))


def combined_prefer_hits(t: Tables) -> DataFrame:
    template = hits.full_sumstats(t.gwas, t.vi, TEMPLATE_TRAIT)
    return _short_pval(hits.combined_sumstats(template, _hits(t), t.alias_map, prefer="hits"))


def combined_replaced(t: Tables) -> DataFrame:
    template = hits.full_sumstats(t.gwas, t.vi, TEMPLATE_TRAIT)
    return _short_pval(hits.combined_sumstats(template, _hits(t), t.alias_map, replace=True))


def hit_regions(t: Tables) -> DataFrame:
    return _region_text(_regions(t))


def hit_regions_no_genes(t: Tables) -> DataFrame:
    return _region_text(regions.hit_regions(_hits(t), None, 5_000))


def region_hits(t: Tables) -> DataFrame:
    found = settle(_hits(t))
    return _short_pval(regions.region_hits(settle(_regions(t, found)), found))


def region_hits_named_traits(t: Tables) -> DataFrame:
    """Members with commas and percent signs in trait names, and regions on Y and the mitochondrion."""
    found = settle(hits.significant_hits(t.odd_gwas, t.odd_vi))
    return _short_pval(regions.region_hits(settle(_regions(t, found)), found))


def nearest_gene(t: Tables) -> DataFrame:
    """The gene is found once per variant and rides along the ID join."""
    variants = parse_marker(t.vi.select("ID", "Marker")).select("ID", "chromosome", "position")
    known = regions.nearest_gene(variants, t.genes, 100_000)
    return t.gwas.select("ID", "phenotype").join(known, "ID", "left").withColumn(
        "closest_gene", F.coalesce("closest_gene", F.lit(regions.NO_GENE)))


def gtf_gene_name(t: Tables) -> DataFrame:
    return t.attributes.select("line", gene_name(F.col("attributes")).alias("gene_name"))


def manhattan_points(t: Tables) -> DataFrame:
    points = hits.manhattan_points(settle(_combined(t)))
    return _short_pval(points).withColumn("y", F.round("y", 7))


def manhattan_thinned(t: Tables) -> DataFrame:
    thinned = hits.manhattan_thinned(hits.manhattan_points(settle(_combined(t))))
    return _short_pval(thinned).withColumn("y", F.round("y", 7))


def eqtl_lookup(t: Tables) -> DataFrame:
    return eqtl.eqtl_lookup(t.eqtl_a, _hits(t).select(F.col("ID").alias("rsid")))


def to_genomic_table(t: Tables) -> DataFrame:
    extra = ["OA", "EA", "EAF", "beta", "pval", "Marker", "phenotype"]
    return _short_pval(eqtl.to_genomic_table(_hits(t), "chromosome", "position", extra))


def variant_allele_join(t: Tables) -> DataFrame:
    return eqtl.variant_allele_join(_candidate_variants(t), eqtl.first_collection(t.eqtl_a))


def causal_gene_candidates(t: Tables) -> DataFrame:
    return eqtl.causal_gene_candidates(_candidate_variants(t), t.eqtl_a, t.eqtl_b)


def causal_gene_union(t: Tables) -> DataFrame:
    return eqtl.causal_gene_candidates(_candidate_variants(t), t.eqtl_a, t.eqtl_b, mode="union")


def causal_gene_collapsed(t: Tables) -> DataFrame:
    found = eqtl.causal_gene_candidates(_candidate_variants(t), t.eqtl_a, t.eqtl_b, mode="collapsed")
    return found.withColumn("genes_b", F.concat_ws(",", "genes_b"))


def causal_gene_rank(t: Tables) -> DataFrame:
    return eqtl.causal_gene_rank(variant_allele_join(t))


def variant_key_map(t: Tables) -> DataFrame:
    return tf_binding.variant_key_map(t.vlist)


def variant_loci(t: Tables) -> DataFrame:
    return tf_binding.variant_loci(t.vlist)


def vcf_projection(t: Tables) -> DataFrame:
    return tf_binding.vcf_projection(t.vlist, VCF_CHUNK)


def peak_overlap(t: Tables) -> DataFrame:
    return _peak_hits(t)


def peak_biotype_filter(t: Tables) -> DataFrame:
    biotypes = t.orders.sparkSession.createDataFrame([(b,) for b in SAFE_BIOTYPES], "biotype string")
    return tf_binding.peak_biotype_filter(_peak_hits(t), biotypes)


def peak_empty_biotypes(t: Tables) -> DataFrame:
    none = t.orders.sparkSession.createDataFrame([], "biotype string")
    return tf_binding.peak_biotype_filter(_peak_hits(t), none)


def motif_effect_filter(t: Tables) -> DataFrame:
    return tf_binding.motif_effects(t.effects, tf_binding.variant_key_map(t.vlist), 0.3)


def motif_matrix_unpivot(t: Tables) -> DataFrame:
    return tf_binding.motif_matrix_long(t.motif_matrix)


def motif_matrix_filter(t: Tables) -> DataFrame:
    return _matrix_effects(t)


def double_evidence_from_matrix(t: Tables) -> DataFrame:
    return tf_binding.double_evidence_tfs(_peak_hits(t, per_factor=True), _matrix_effects(t))


def double_evidence_tfs(t: Tables) -> DataFrame:
    return tf_binding.double_evidence_tfs(_peak_hits(t, per_factor=True), _motif_effects(t))


def sample_overlap(t: Tables) -> DataFrame:
    return quality.sample_overlap(t.genotyped, t.pheno.filter("y2 IS NOT NULL"))


def shared_samples(t: Tables) -> DataFrame:
    return quality.shared_samples(t.genotyped, t.pheno.filter("y2 IS NOT NULL"))


def variant_qc(t: Tables) -> DataFrame:
    qc = association.variant_qc(t.geno)
    return qc.withColumns({"af": F.round("af", 9), "p_hwe": F.round("p_hwe", 6)})


def variant_qc_filter(t: Tables) -> DataFrame:
    return association.variant_qc_filter(association.variant_qc(t.geno), min_p_hwe=1e-3).select("ID")


def variant_qc_plain_p(t: Tables) -> DataFrame:
    qc = association.variant_qc(t.geno, mid_p=False)
    return qc.select("ID", F.round("p_hwe", 6).alias("p_hwe"))


def variant_qc_two_sided(t: Tables) -> DataFrame:
    return association.variant_qc_filter(association.variant_qc(t.geno), min_p_hwe=1e-3, two_sided=True).select("ID")


def gwas_linear_regression(t: Tables) -> DataFrame:
    fits = association.association(t.geno, t.cohort, t.pheno)
    return _rounded_fits(fits)


def gwas_covariate_regression(t: Tables) -> DataFrame:
    fits = association.association(t.geno, t.cohort, t.pheno, t.cov)
    return _rounded_fits(fits)


def gwas_with_quality_control(t: Tables) -> DataFrame:
    fits = association.association(t.geno, t.cohort, t.pheno, min_af=0.05, min_p_hwe=1e-3)
    table = association.gwas_table(fits, t.loci)
    return table.withColumns({
        "EAF": F.round("EAF", 9), "beta": nine_digits(F.col("beta")), "tstat": F.round("tstat", 6), "pval": F.round("pval", 8)})


def _rounded_fits(fits: DataFrame) -> DataFrame:
    return fits.withColumns({
        "af": F.round("af", 9), "beta": nine_digits(F.col("beta")), "tstat": F.round("tstat", 6), "pval": F.round("pval", 8)})


def genomic_inflation(t: Tables) -> DataFrame:
    table = t.gwas.select("phenotype", chi2_sf("chi2").alias("pval"))
    return association.genomic_inflation(table).withColumn("lambda_gc", nine_digits(F.col("lambda_gc")))


def locus_quality(t: Tables) -> DataFrame:
    return quality.locus_quality(t.raw_vi, "Marker")


def unmatched_hits(t: Tables) -> DataFrame:
    return quality.unmatched_hits(_hits(t), t.good_vi)


def unparsed_markers(t: Tables) -> DataFrame:
    return quality.unparsed_markers(hits.annotate(t.gwas, t.raw_vi))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_variant_info, scan_gwas_results, phenotype_from_file_name, cell_type_from_file_name, parsed_markers,
        normalized_chromosomes, chi2_pvalue, significant_hits, full_sumstats, best_pheno_per_variant, all_hits_table,
        all_hits_one_per_variant, alias_assign, alias_count, combined_sumstats, combined_prefer_hits, combined_replaced, hit_regions,
        hit_regions_no_genes, region_hits, region_hits_named_traits, nearest_gene,
        gtf_gene_name, manhattan_points, manhattan_thinned, eqtl_lookup, to_genomic_table, variant_allele_join,
        causal_gene_candidates, causal_gene_union, causal_gene_collapsed, causal_gene_rank, variant_key_map, variant_loci, vcf_projection,
        peak_overlap, peak_biotype_filter, peak_empty_biotypes, motif_effect_filter, motif_matrix_unpivot, motif_matrix_filter,
        double_evidence_tfs, double_evidence_from_matrix,
        sample_overlap, shared_samples, variant_qc, variant_qc_filter, variant_qc_plain_p, variant_qc_two_sided, gwas_linear_regression,
        gwas_covariate_regression, gwas_with_quality_control, genomic_inflation, locus_quality, unmatched_hits, unparsed_markers,
    )
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the named query over the tables of ``sf_dir``.

    Building runs jobs where an operator settles an intermediate table or checks a size:
    region members, plot points, peaks, regressions and the inflation factor.
    """
    return QUERIES[name](Tables(tune(spark), sf_dir))
