"""The registered queries as plain SQL, written pairwise and by brute force on purpose."""

from __future__ import annotations

import math

from locusweave.functions import stats
from locusweave.plans.catalog import SAFE_BIOTYPES, TEMPLATE_TRAIT, WINDOW_BUFFER
from locusweave.plans.fixtures import with_clause


def _short(value: str) -> str:
    return f"CAST(printf('%.8e', {value}) AS DOUBLE)"


def _number(value: float) -> str:
    """A literal that both engines read as the same double."""
    return f"{value:.17e}"


def _ratio(x: str, upper, lead: float, last: float, lower, lower_last: float) -> str:
    n, d = f"({_number(lead)} * {x})", x
    for a, b in zip(upper, lower):
        n, d = f"(({n} + {_number(a)}) * {x})", f"(({d} + {_number(b)}) * {x})"
    return f"(({n} + {_number(last)}) / ({d} + {_number(lower_last)}))"


def chi2_sf_sql(chi2: str) -> str:
    """Survival function of chi-square with one degree of freedom by the approximation in ``stats``."""
    s, y, z = f"({chi2} / 2e0)", f"sqrt({chi2} / 2e0)", f"(2e0 / {chi2})"
    small = f"1e0 - {y} * {_ratio(s, stats.ERFC_A[:3], stats.ERFC_A[4], stats.ERFC_A[3], stats.ERFC_B[:3], stats.ERFC_B[3])}"
    middle = f"exp(-{s}) * {_ratio(y, stats.ERFC_C[:7], stats.ERFC_C[8], stats.ERFC_C[7], stats.ERFC_D[:7], stats.ERFC_D[7])}"
    tail = _ratio(z, stats.ERFC_P[:4], stats.ERFC_P[5], stats.ERFC_P[4], stats.ERFC_Q[:4], stats.ERFC_Q[4])
    large = f"exp(-{s}) * ({_number(1 / math.sqrt(math.pi))} - {z} * {tail}) / {y}"
    return (
        f"CASE WHEN {chi2} <= 0e0 THEN 1e0 WHEN {y} <= {_number(stats.ERFC_SMALL)} THEN {small} "
        f"WHEN {y} <= {_number(stats.ERFC_LARGE)} THEN {middle} ELSE {large} END"
    )


# Upper quantiles of chi-square with one degree of freedom at 1e-6 and 0.5.
THRESHOLD = "2.3928126976934827e1"
MEDIAN = "4.549364231195727e-1"

ANNOTATED = f"""annotated AS (
  SELECT g.ID, g.beta, g.chi2, {_short(chi2_sf_sql('g.chi2'))} AS pval, replace(v.Marker, 'chrX', 'chr23') AS Marker,
         l.chromosome, l.position, v.OA, v.EA, v.EAF, v.Info, g.phenotype,
         {chi2_sf_sql('g.chi2')} AS exact_pval
  FROM gwas g LEFT JOIN vi v ON v.ID = g.ID LEFT JOIN loci l ON l.ID = g.ID)"""
HITS = f"hits AS (SELECT * FROM annotated WHERE chi2 > {THRESHOLD})"
SUMSTATS = "ID, beta, chi2, pval, Marker, chromosome, position, OA, EA, EAF, Info, phenotype"

COMBINED = f"""combined AS (
  SELECT {SUMSTATS}, CASE WHEN source = 0 THEN '<no data>' ELSE coalesce(m.alias, '<no data>') END AS alias, exact_pval
  FROM (SELECT *, row_number() OVER (PARTITION BY {SUMSTATS} ORDER BY source) AS rn
        FROM (SELECT *, 0 AS source FROM annotated WHERE phenotype = '{TEMPLATE_TRAIT}'
              UNION ALL SELECT *, 1 AS source FROM hits) u) d
  LEFT JOIN (SELECT phenotype AS p, max(alias) AS alias FROM alias_map GROUP BY phenotype) m ON m.p = d.phenotype
  WHERE rn = 1)"""


def _regions(window: int) -> str:
    return f"""spans AS (
  SELECT *, greatest(2, position - {window}) AS s, position + {window} AS e FROM hits),
flagged AS (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chromosome ORDER BY s, ID, phenotype
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM spans),
islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY chromosome ORDER BY s, ID, phenotype ROWS UNBOUNDED PRECEDING) AS island
  FROM flagged),
leads AS (
  SELECT *, row_number() OVER (PARTITION BY chromosome, island ORDER BY chi2 DESC, position, phenotype) AS rn
  FROM islands),
bare_regions AS (
  SELECT chromosome AS chrom, CAST(min(s) AS BIGINT) AS chromStart, CAST(max(e) AS BIGINT) AS chromEnd,
         max(CASE WHEN rn = 1 THEN position END) AS leadSnp_pos, max(CASE WHEN rn = 1 THEN pval END) AS leadSnp_pval,
         count(*) AS num_included_variants, count(DISTINCT phenotype) AS num_phenotypes,
         string_agg(DISTINCT phenotype, ',' ORDER BY phenotype) AS phenotypes
  FROM leads GROUP BY chromosome, island)"""


REGIONS = _regions(WINDOW_BUFFER) + """,
gene_choice AS (
  SELECT r.chrom, r.chromStart, g.gene_name,
         row_number() OVER (PARTITION BY r.chrom, r.chromStart
                            ORDER BY abs(g.gene_start - r.leadSnp_pos), g.gene_start, g.gene_name) AS rn
  FROM bare_regions r JOIN genes g ON g.chromosome = r.chrom
   AND g.gene_start <= r.leadSnp_pos + 1000000 AND g.gene_end >= r.leadSnp_pos - 1000000),
regions AS (
  SELECT r.chrom, r.chromStart, r.chromEnd, r.leadSnp_pos, r.leadSnp_pval,
         coalesce(g.gene_name, 'NA') AS leadSnp_closest_gene, r.num_included_variants, r.num_phenotypes, r.phenotypes
  FROM bare_regions r LEFT JOIN gene_choice g ON g.chrom = r.chrom AND g.chromStart = r.chromStart AND g.rn = 1)"""

POINTS = """points AS (
  SELECT c.*, c.position + coalesce(o.before, 0) AS x, -log10(c.exact_pval) AS y
  FROM combined c JOIN (
    SELECT chromosome, CAST(sum(len) OVER (ORDER BY chromosome ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS before
    FROM (SELECT chromosome, max(position) AS len FROM combined GROUP BY chromosome) m) o ON o.chromosome = c.chromosome)"""
POINT_COLUMNS = (
    f"{SUMSTATS}, alias, x, round(y, 7) AS y, y > 7.301029995664 AS is_genome_wide, y > 11 AS is_significant")

PEAK_HITS = """peak_hits AS (
  SELECT v.chromosome AS chr, v.position AS pos, split_part(p.name, '.', 1) AS study_accession,
         split_part(p.name, '.', 2) AS transcription_factor, split_part(p.name, '.', 3) AS biotype,
         abs((p.thick_start + p.thick_end) // 2 - v.position) AS distance_to_peak
  FROM (SELECT DISTINCT chromosome, position FROM loci) v
  JOIN peaks p ON p.chromosome = v.chromosome AND p.peak_start < v.position AND p.peak_end >= v.position)"""

CHROM_NUMBER = "CAST(replace(replace({c}, 'chr', ''), 'X', '23') AS BIGINT)"


def _motif(threshold: float) -> str:
    return f"""motif AS (
  SELECT v.ID, {CHROM_NUMBER.format(c='v.Chrom')} AS Chrom, v.Pos, v.OA, v.EA,
         v.Chrom || ':' || CAST(v.Pos AS VARCHAR) || v.OA || '>' || v.EA AS "Chrom:PosOA>EA", e.tf AS TF, e.prediction,
         CAST(replace(e.score, '*', '') AS DOUBLE) AS score
  FROM effects e JOIN vlist v
    ON split_part(e.variant, '.', 1) = v.Chrom || ':' || CAST(v.Pos AS VARCHAR) || v.OA || '>' || v.EA
  WHERE abs(CAST(replace(e.score, '*', '') AS DOUBLE)) >= {threshold}e0)"""


MATRIX_MOTIF = f"""matrix_motif AS (
  SELECT v.ID, {CHROM_NUMBER.format(c='v.Chrom')} AS Chrom, v.Pos, v.OA, v.EA,
         v.Chrom || ':' || CAST(v.Pos AS VARCHAR) || v.OA || '>' || v.EA AS "Chrom:PosOA>EA", c.TF,
         CAST(replace(c.score, '*', '') AS DOUBLE) AS score
  FROM matrix_cells c JOIN vlist v
    ON split_part(c.variant, '.', 1) = v.Chrom || ':' || CAST(v.Pos AS VARCHAR) || v.OA || '>' || v.EA
  WHERE abs(CAST(replace(c.score, '*', '') AS DOUBLE)) >= 0.2e0)"""

VARIANTS = "variants AS (SELECT ID, chromosome, position, OA, EA, EAF, beta, phenotype FROM hits)"
MATCHED = """matched AS (
  SELECT v.*, a.gene AS gene_a, a.pval AS pval_a, a.cell_type AS celltype_a
  FROM variants v JOIN eqtl_a a
    ON a.chromosome = v.chromosome AND a.position = v.position AND a.OA = v.OA AND a.EA = v.EA)"""

COUNTS = """counts AS (
  SELECT ID, count(*) FILTER (n_alt = 0) AS n_hom_ref, count(*) FILTER (n_alt = 1) AS n_het,
         count(*) FILTER (n_alt = 2) AS n_hom_var, count(n_alt) AS n_called,
         CAST(sum(n_alt) AS DOUBLE) / (2 * count(n_alt)) AS af
  FROM geno GROUP BY ID),
hwe_terms AS (
  SELECT ID, n_het, h.h, exp(h.h * ln(2e0) - lgamma((minor - h.h) / 2 + 1) - lgamma(h.h + 1)
         - lgamma(n_called - h.h - (minor - h.h) / 2 + 1) + lgamma(n_called + 1) + lgamma(minor + 1)
         + lgamma(2 * n_called - minor + 1) - lgamma(2 * n_called + 1)) AS pr
  FROM (SELECT *, least(2 * n_hom_ref + n_het, 2 * n_hom_var + n_het) AS minor FROM counts) c,
       LATERAL (SELECT unnest(range(minor % 2, minor + 1, 2)) AS h) h),
hwe AS (
  SELECT t.ID, least(1e0, sum(CASE WHEN t.pr <= o.pr * (1e0 + 1e-8) THEN t.pr ELSE 0e0 END) - max(o.pr) / 2) AS p_hwe
  FROM hwe_terms t JOIN hwe_terms o ON o.ID = t.ID AND o.h = o.n_het GROUP BY t.ID),
qc AS (SELECT c.*, h.p_hwe FROM counts c JOIN hwe h ON h.ID = c.ID)"""

# The full variant by sample grid with missing genotypes at the variant's mean, then
# ordinary least squares; covariates are taken out one after the other.
GRID = """long_pheno AS (
  SELECT sample_id, 'y1' AS phenotype, y1 AS y FROM pheno WHERE y1 IS NOT NULL
  UNION ALL SELECT sample_id, 'y2', y2 FROM pheno WHERE y2 IS NOT NULL),
grid AS (
  SELECT v.ID, p.phenotype, p.sample_id, p.y, CAST(g.n_alt AS DOUBLE) AS called
  FROM (SELECT DISTINCT ID FROM geno) v CROSS JOIN long_pheno p
  LEFT JOIN geno g ON g.ID = v.ID AND g.sample_id = p.sample_id),
filled AS (
  SELECT ID, phenotype, sample_id, y, coalesce(called, avg(called) OVER (PARTITION BY ID, phenotype)) AS x FROM grid)"""


def _fit(table: str, lost: int) -> str:
    """Slope, t and p from (x, y) pairs with ``lost`` degrees of freedom taken; p by the finite series for integer df."""
    return f"""sums AS (
  SELECT ID, phenotype, count(*) AS n, regr_slope(y, x) AS slope, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy,
         regr_syy(y, x) AS syy, count(*) - {lost} AS dof
  FROM {table} GROUP BY ID, phenotype),
fits AS (
  SELECT *, CASE WHEN sxx > 1e-7 THEN slope END AS beta,
         CASE WHEN sxx > 1e-7 AND dof > 0 THEN slope / sqrt((syy - slope * sxy) / dof / sxx) END AS tstat
  FROM sums),
angles AS (SELECT *, atan(abs(tstat) / sqrt(dof)) AS a FROM fits),
tested AS (
  SELECT ID, phenotype, n, beta, tstat, CASE
    WHEN tstat IS NULL THEN NULL
    WHEN dof = 1 THEN 1 - 2 / pi() * a
    WHEN dof % 2 = 0 THEN 1 - sin(a) * list_sum([exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(cos(a), 2 * k)
         for k in range(0, dof // 2)])
    ELSE 1 - 2 / pi() * (a + sin(a) * list_sum([exp(lgamma(k + 1) - lgamma(k + 1.5)) * sqrt(pi()) / 2 * pow(cos(a), 2 * k + 1)
         for k in range(0, (dof - 1) // 2)])) END AS p
  FROM angles)"""


FIT_COLUMNS = f"""t.ID, t.phenotype, t.n, round(c.af, 9) AS af, {_short('t.beta')} AS beta, round(t.tstat, 6) AS tstat,
       round(t.p, 8) AS pval FROM tested t JOIN counts c ON c.ID = t.ID"""


def _residual(target: str, by: str) -> str:
    """``target`` less its regression on the centred column ``by`` within a variant and phenotype."""
    group = "(PARTITION BY ID, phenotype)"
    return (
        f"{target} - {by} * coalesce(sum({target} * {by}) OVER {group} / nullif(sum({by} * {by}) OVER {group}, 0), 0)"
    )


ADJUSTED = f"""centred AS (
  SELECT f.ID, f.phenotype, f.sample_id, x - avg(x) OVER g AS x, y - avg(y) OVER g AS y,
         sex - avg(sex) OVER g AS s, pc1 - avg(pc1) OVER g AS p
  FROM filled f JOIN cov ON cov.sample_id = f.sample_id WINDOW g AS (PARTITION BY f.ID, f.phenotype)),
without_sex AS (
  SELECT ID, phenotype, {_residual('x', 's')} AS x, {_residual('y', 's')} AS y, {_residual('p', 's')} AS p FROM centred),
adjusted AS (
  SELECT ID, phenotype, {_residual('x', 'p')} AS x, {_residual('y', 'p')} AS y FROM without_sex)"""


def _query(views: tuple[str, ...], steps: tuple[str, ...], select: str) -> str:
    head = with_clause(*views)
    return head + "".join(f",\n{s}" for s in steps) + "\n" + select


def oracle_sql() -> dict[str, str]:
    base, hit = ("gwas", "vi", "loci"), (ANNOTATED, HITS)
    biotypes = ", ".join(f"'{b}'" for b in SAFE_BIOTYPES)
    genomic = "'chr' || CAST(chromosome AS VARCHAR) AS \"#Chrom\", position AS \"Pos\""
    return {
        "scan_variant_info": _query(("vi",), (), "SELECT ID, Marker, OA, EA, EAF, Info FROM vi"),
        "scan_gwas_results": _query(("gwas",), (), "SELECT ID, phenotype, beta, chi2 FROM gwas"),
        "phenotype_from_file_name": _query(("result_files",), (), """
SELECT file_name, ID, beta, chi2,
       array_to_string(list_slice(string_split(file_name, '_'), 5, len(string_split(file_name, '_')) - 3), '_') AS phenotype
FROM result_files"""),
        "cell_type_from_file_name": _query(("eqtl_a",), (), """
SELECT rsid, gene, cell_type || '_cells_eqtl_full_v1.txt' AS file_name, cell_type || '_cells' AS cells FROM eqtl_a"""),
        "parsed_markers": _query(("vi", "loci"), (), """
SELECT v.ID, replace(v.Marker, 'chrX', 'chr23') AS Marker, l.chromosome, l.position FROM vi v JOIN loci l ON l.ID = v.ID"""),
        "normalized_chromosomes": _query(("vlist",), (), f"""
SELECT ID, CAST({CHROM_NUMBER.format(c='Chrom')} AS INT) AS chrom_number, Chrom AS chrom_name,
       replace(Chrom, 'chr', '') || ':' || CAST(Pos AS VARCHAR) AS chr_pos FROM vlist"""),
        "chi2_pvalue": _query(("gwas",), (), f"SELECT ID, phenotype, {_short(chi2_sf_sql('chi2'))} AS pval FROM gwas"),
        "significant_hits": _query(base, hit, f"SELECT {SUMSTATS} FROM hits"),
        "full_sumstats": _query(base, (ANNOTATED,), f"SELECT {SUMSTATS} FROM annotated"),
        "best_pheno_per_variant": _query(base, hit, f"""
SELECT {SUMSTATS} FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY chi2 DESC, phenotype) AS rn FROM hits) r
WHERE rn = 1"""),
        "all_hits_one_per_variant": _query(base, hit, f"""
SELECT {SUMSTATS} FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY chi2 DESC, phenotype) AS rn FROM hits) r
WHERE rn = 1"""),
        "all_hits_table": _query(base, hit, f"SELECT {SUMSTATS} FROM hits ORDER BY chromosome, position"),
        "alias_assign": _query((*base, "alias_map"), hit, f"""
SELECT {SUMSTATS.replace('phenotype', 'h.phenotype')}, coalesce(m.alias, '<no data>') AS alias
FROM hits h LEFT JOIN alias_map m ON m.phenotype = h.phenotype"""),
        "alias_count": _query((*base, "alias_map"), (*hit, COMBINED),
                              "SELECT count(DISTINCT alias) AS num_aliases FROM combined"),
        "combined_sumstats": _query((*base, "alias_map"), (*hit, COMBINED), f"SELECT {SUMSTATS}, alias FROM combined"),
        "combined_prefer_hits": _query((*base, "alias_map"), hit, f"""
SELECT {SUMSTATS.replace('phenotype', 'h.phenotype')}, coalesce(m.alias, '<no data>') AS alias FROM (SELECT DISTINCT {SUMSTATS} FROM hits) h
LEFT JOIN alias_map m ON m.phenotype = h.phenotype
UNION ALL SELECT {SUMSTATS}, '<no data>' FROM (
  SELECT {SUMSTATS} FROM annotated WHERE phenotype = '{TEMPLATE_TRAIT}' EXCEPT SELECT {SUMSTATS} FROM hits) t"""),
        "combined_replaced": _query((*base, "alias_map"), hit, f"""
SELECT {SUMSTATS.replace('phenotype', 'h.phenotype')}, coalesce(m.alias, '<no data>') AS alias FROM (SELECT DISTINCT {SUMSTATS} FROM hits) h
LEFT JOIN alias_map m ON m.phenotype = h.phenotype
UNION ALL SELECT DISTINCT {SUMSTATS}, '<no data>' FROM annotated
WHERE phenotype = '{TEMPLATE_TRAIT}' AND ID NOT IN (SELECT ID FROM hits)"""),
        "hit_regions": _query((*base, "genes"), (*hit, REGIONS), "SELECT * FROM regions"),
        "hit_regions_no_genes": _query(base, (*hit, _regions(5000)), """
SELECT chrom, chromStart, chromEnd, leadSnp_pos, leadSnp_pval, 'NA' AS leadSnp_closest_gene, num_included_variants,
       num_phenotypes, phenotypes FROM bare_regions"""),
        "region_hits": _query((*base, "genes"), (*hit, REGIONS, """numbered AS (
  SELECT *, row_number() OVER (ORDER BY chrom, chromStart) AS region_id FROM regions)"""), """
SELECT r.region_id, 'region_' || CAST(r.region_id AS VARCHAR) || '_chr' || CAST(r.chrom AS VARCHAR) || ':' ||
         CAST(r.chromStart AS VARCHAR) || '-' || CAST(r.chromEnd AS VARCHAR) AS region,
       h.chromosome, h.position, h.position AS position2, h.EA, h.pval, h.phenotype
FROM numbered r JOIN hits h ON h.chromosome = r.chrom AND h.position BETWEEN r.chromStart AND r.chromEnd
 AND list_contains(string_split(r.phenotypes, ','), h.phenotype)"""),
        "region_hits_named_traits": _query(("odd_gwas", "odd_vi", "genes"), (f"""placed AS (
  SELECT *, CAST(CASE c WHEN 'X' THEN '23' WHEN 'Y' THEN '24' WHEN 'MT' THEN '25' ELSE c END AS INT) AS chromosome,
         CAST(split_part(Marker, ':', 2) AS BIGINT) AS position
  FROM (SELECT *, replace(split_part(Marker, ':', 1), 'chr', '') AS c FROM odd_vi) v),
hits AS (
  SELECT g.ID, g.chi2, {_short(chi2_sf_sql('g.chi2'))} AS pval, l.chromosome, l.position, l.EA, g.phenotype
  FROM odd_gwas g JOIN placed l ON l.ID = g.ID WHERE g.chi2 > {THRESHOLD})""", _regions(WINDOW_BUFFER), """numbered AS (
  SELECT *, row_number() OVER (ORDER BY chrom, chromStart) AS region_id FROM bare_regions)"""), """
SELECT r.region_id, 'region_' || CAST(r.region_id AS VARCHAR) || '_chr' || CAST(r.chrom AS VARCHAR) || ':' ||
         CAST(r.chromStart AS VARCHAR) || '-' || CAST(r.chromEnd AS VARCHAR) AS region,
       h.chromosome, h.position, h.position AS position2, h.EA, h.pval, h.phenotype
FROM numbered r JOIN hits h ON h.chromosome = r.chrom AND h.position BETWEEN r.chromStart AND r.chromEnd"""),
        "nearest_gene": _query((*base, "genes"), (ANNOTATED, """choice AS (
  SELECT v.chromosome, v.position, g.gene_name,
         row_number() OVER (PARTITION BY v.chromosome, v.position
                            ORDER BY abs(g.gene_start - v.position), g.gene_start, g.gene_name) AS rn
  FROM (SELECT DISTINCT chromosome, position FROM loci) v JOIN genes g ON g.chromosome = v.chromosome
   AND g.gene_start <= v.position + 100000 AND g.gene_end >= v.position - 100000)"""), """
SELECT a.ID, a.phenotype, a.chromosome, a.position, coalesce(c.gene_name, 'NA') AS closest_gene
FROM annotated a LEFT JOIN choice c ON c.chromosome = a.chromosome AND c.position = a.position AND c.rn = 1"""),
        "gtf_gene_name": _query(("attributes",), (), """
SELECT line, split_part(split_part(attributes, ';', 3), '"', 2) AS gene_name FROM attributes"""),
        "manhattan_points": _query((*base, "alias_map"), (*hit, COMBINED, POINTS), f"SELECT {POINT_COLUMNS} FROM points"),
        "manhattan_thinned": _query((*base, "alias_map"), (*hit, COMBINED, POINTS), f"""
SELECT {POINT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY chromosome, floor(x / 100000), floor(y / 0.1e0), y > 7.301029995664
                               ORDER BY y DESC, x, ID, phenotype, alias) AS rn FROM points) r
WHERE rn = 1 OR y > 7.301029995664"""),
        "eqtl_lookup": _query((*base, "eqtl_a"), hit, "SELECT * FROM eqtl_a WHERE rsid IN (SELECT ID FROM hits)"),
        "to_genomic_table": _query(base, hit, f"SELECT {genomic}, OA, EA, EAF, beta, pval, Marker, phenotype FROM hits"),
        "variant_allele_join": _query((*base, "eqtl_a"), (*hit, VARIANTS, MATCHED), "SELECT * FROM matched"),
        "causal_gene_candidates": _query((*base, "eqtl_a", "eqtl_b"), (*hit, VARIANTS, MATCHED), """
SELECT m.*, b.gene AS gene_b, b.source AS celltype_b FROM matched m JOIN eqtl_b b
    ON b.chromosome = m.chromosome AND b.position = m.position AND b.ref = m.OA AND b.alt = m.EA"""),
        "causal_gene_union": _query((*base, "eqtl_a", "eqtl_b"), (*hit, VARIANTS), """
SELECT v.*, 'a' AS collection, a.gene, a.pval AS eqtl_pval, a.cell_type FROM variants v JOIN eqtl_a a
    ON a.chromosome = v.chromosome AND a.position = v.position AND a.OA = v.OA AND a.EA = v.EA
UNION ALL
SELECT v.*, 'b', b.gene, NULL, b.source FROM variants v JOIN eqtl_b b
    ON b.chromosome = v.chromosome AND b.position = v.position AND b.ref = v.OA AND b.alt = v.EA"""),
        "causal_gene_collapsed": _query((*base, "eqtl_a", "eqtl_b"), (*hit, VARIANTS, MATCHED), """
SELECT m.*, b.genes_b FROM matched m JOIN (
  SELECT chromosome AS c, position AS p, ref, alt, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes_b
  FROM eqtl_b GROUP BY chromosome, position, ref, alt) b
    ON b.c = m.chromosome AND b.p = m.position AND b.ref = m.OA AND b.alt = m.EA"""),
        "causal_gene_rank": _query((*base, "eqtl_a"), (*hit, VARIANTS, MATCHED), """
SELECT chromosome, position, OA, EA, gene_a AS gene, best_pval, num_cell_types,
       row_number() OVER (PARTITION BY chromosome, position, OA, EA ORDER BY best_pval, gene_a) AS gene_rank
FROM (SELECT chromosome, position, OA, EA, gene_a, min(pval_a) AS best_pval, count(DISTINCT celltype_a) AS num_cell_types
      FROM matched GROUP BY chromosome, position, OA, EA, gene_a) g"""),
        "variant_key_map": _query(("vlist",), (), """
SELECT *, Chrom || ':' || CAST(Pos AS VARCHAR) || OA || '>' || EA AS "Chrom:PosOA>EA" FROM vlist"""),
        "variant_loci": _query(("vlist",), (), """
SELECT DISTINCT replace(Chrom, 'chr', '') || ':' || CAST(Pos AS VARCHAR) AS chr_pos FROM vlist"""),
        "vcf_projection": _query(("vlist",), (f"""placed AS (
  SELECT *, {CHROM_NUMBER.format(c='Chrom')} AS c FROM vlist), numbered AS (
  SELECT *, row_number() OVER (ORDER BY c, Pos, ID, OA, EA) AS ordinal FROM placed)""",), """
SELECT c AS "#CHROM", Pos AS "POS", ID, OA AS "REF", EA AS "ALT", 100 AS "QUAL", '.' AS "FILTER", '.' AS "INFO",
       'GT:DP' AS "FORMAT", '0/1:154' AS "NA00001", ordinal, (ordinal - 1) // 300 + 1 AS chunk FROM numbered"""),
        "peak_overlap": _query(("loci", "peaks"), (PEAK_HITS,), "SELECT * FROM peak_hits"),
        "peak_biotype_filter": _query(("loci", "peaks"), (PEAK_HITS,),
                                      f"SELECT * FROM peak_hits WHERE biotype IN ({biotypes})"),
        "peak_empty_biotypes": _query(("loci", "peaks"), (PEAK_HITS,), "SELECT * FROM peak_hits"),
        "motif_effect_filter": _query(("effects", "vlist"), (_motif(0.3),), "SELECT * FROM motif"),
        "motif_matrix_unpivot": _query(("motif_matrix",), (), "\nUNION ALL ".join(
            f"SELECT 'M{i}' AS variant, TF, M{i} AS score FROM motif_matrix" for i in range(1, 8))),
        "motif_matrix_filter": _query(("matrix_cells", "vlist"), (MATRIX_MOTIF,), "SELECT * FROM matrix_motif"),
        "double_evidence_from_matrix": _query(("matrix_cells", "vlist", "loci", "peaks"), (PEAK_HITS, MATRIX_MOTIF), """
SELECT DISTINCT m.ID, m.Chrom AS Chr, m.Pos, m.OA, m.EA, m.TF AS transcription_factor, m.score,
       CASE WHEN m.score > 0 THEN 'gain' ELSE 'loss' END AS effect
FROM matrix_motif m JOIN peak_hits p ON p.chr = m.Chrom AND p.pos = m.Pos AND p.transcription_factor = m.TF"""),
        "double_evidence_tfs": _query(("effects", "vlist", "loci", "peaks"), (PEAK_HITS, _motif(0.2)), """
SELECT ID, Chr, Pos, OA, EA, transcription_factor, score, CASE WHEN score > 0 THEN 'gain' ELSE 'loss' END AS effect
FROM (SELECT DISTINCT m.ID, m.Chrom AS Chr, m.Pos, m.OA, m.EA, m.TF AS transcription_factor, m.prediction, m.score
      FROM motif m JOIN peak_hits p ON p.chr = m.Chrom AND p.pos = m.Pos AND p.transcription_factor = m.TF) d"""),
        "sample_overlap": _query(("genotyped", "pheno"), (), """
SELECT (SELECT count(*) FROM genotyped) AS num_samples, (SELECT count(*) FROM pheno WHERE y2 IS NOT NULL) AS num_phenotyped,
       (SELECT count(*) FROM (SELECT sample_id FROM genotyped INTERSECT SELECT sample_id FROM pheno WHERE y2 IS NOT NULL) i)
         AS num_shared"""),
        "shared_samples": _query(("genotyped", "pheno"), (), """
SELECT sample_id FROM genotyped INTERSECT SELECT sample_id FROM pheno WHERE y2 IS NOT NULL"""),
        "variant_qc": _query(("geno",), (COUNTS,), """
SELECT ID, n_hom_ref, n_het, n_hom_var, n_called, round(af, 9) AS af, round(p_hwe, 6) AS p_hwe FROM qc"""),
        "variant_qc_filter": _query(("geno",), (COUNTS,), "SELECT ID FROM qc WHERE af > 0.05 AND p_hwe > 1e-3"),
        "variant_qc_plain_p": _query(("geno",), (COUNTS, """plain AS (
  SELECT t.ID, least(1e0, sum(CASE WHEN t.pr <= o.pr * (1e0 + 1e-8) THEN t.pr ELSE 0e0 END)) AS p
  FROM hwe_terms t JOIN hwe_terms o ON o.ID = t.ID AND o.h = o.n_het GROUP BY t.ID)"""), "SELECT ID, round(p, 6) AS p_hwe FROM plain"),
        "variant_qc_two_sided": _query(("geno",), (COUNTS,), "SELECT ID FROM qc WHERE least(af, 1 - af) > 0.05 AND p_hwe > 1e-3"),
        "gwas_linear_regression": _query(("geno", "pheno"), (COUNTS, GRID, _fit("filled", 2)), f"SELECT {FIT_COLUMNS}"),
        "gwas_covariate_regression": _query(
            ("geno", "pheno", "cov"), (COUNTS, GRID, ADJUSTED, _fit("adjusted", 4)), f"SELECT {FIT_COLUMNS}"),
        "gwas_with_quality_control": _query(("geno", "pheno", "loci"), (COUNTS, GRID, _fit("filled", 2)), f"""
SELECT t.ID AS rsid, l.chromosome, l.position, l.OA, l.EA, round(q.af, 9) AS EAF, round(t.p, 8) AS pval,
       {_short('t.beta')} AS beta, round(t.tstat, 6) AS tstat, t.n, t.phenotype
FROM tested t JOIN qc q ON q.ID = t.ID JOIN loci l ON l.ID = t.ID WHERE q.af > 0.05 AND q.p_hwe > 1e-3"""),
        "genomic_inflation": _query(("gwas",), (), f"""
SELECT phenotype, {_short(f'median(chi2) / {MEDIAN}')} AS lambda_gc FROM gwas GROUP BY phenotype"""),
        "locus_quality": _query(("raw_vi",), (), """
SELECT count(*) AS num_rows, count(*) FILTER (Marker IS NULL) AS num_missing, count(*) FILTER (good) AS num_valid,
       count(*) FILTER (NOT good) AS num_malformed, count(*) FILTER (good AND Marker LIKE 'chr%') AS num_prefixed
FROM (SELECT Marker, regexp_full_match(Marker, '(chr)?([0-9]+|X|Y|M|MT):[0-9]+') AS good FROM raw_vi) r"""),
        "unmatched_hits": _query((*base, "good_vi"), hit, """
SELECT phenotype, count(*) AS num_unmatched FROM hits WHERE ID NOT IN (SELECT ID FROM good_vi) GROUP BY phenotype"""),
        "unparsed_markers": _query(("gwas", "raw_vi"), (), """
SELECT g.phenotype, count(*) AS num_unparsed FROM gwas g JOIN raw_vi v ON v.ID = g.ID
WHERE v.Marker NOT LIKE '%:%' GROUP BY g.phenotype"""),
    }
