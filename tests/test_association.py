import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from locusweave.functions.stats import chi2_isf, student_t_two_sided
from locusweave.operators import association

GENO = "ID string, sample_id bigint, n_alt int"


def _ols(y, x, covariates):
    """Coefficient, t and n of x from the full design matrix."""
    design = np.column_stack([np.ones(len(y)), *covariates, x])
    solution, _, rank, _ = np.linalg.lstsq(design, y, rcond=None)
    residual = y - design @ solution
    dof = len(y) - rank
    variance = residual @ residual / dof * np.linalg.pinv(design.T @ design)
    return solution[-1], solution[-1] / math.sqrt(variance[-1, -1]), len(y), dof


@pytest.fixture(scope="module")
def study(spark):
    rng = np.random.default_rng(11)
    n, variants = 80, 12
    calls = rng.binomial(2, rng.uniform(0.1, 0.6, variants)[:, None], (variants, n)).astype(object)
    calls[rng.random((variants, n)) < 0.08] = None
    calls[0] = 1
    sex, age = rng.integers(0, 2, n), rng.normal(5000, 12, n)
    x = np.array([[0 if v is None else v for v in r] for r in calls], float)
    y = {f"trait {k}": 0.4 * x[k + 1] + 0.7 * sex + 0.02 * age + rng.normal(0, 1, n) for k in range(5)}
    y["trait 1"][rng.random(n) < 0.2] = np.nan
    present = [(f"v{i}", s, calls[i][s]) for i in range(variants) for s in range(n) if not (calls[i][s] is None and s % 2)]
    geno = spark.createDataFrame(present + [("v1", 999, 2)], GENO)
    samples = spark.createDataFrame([(s,) for s in range(n)], "sample_id bigint")
    names = list(y)
    pheno = spark.createDataFrame(
        [(s, *[None if np.isnan(y[k][s]) else float(y[k][s]) for k in names]) for s in range(n)],
        "sample_id bigint, " + ", ".join(f"`{k}` double" for k in names))
    cov = spark.createDataFrame(
        [(s, int(sex[s]), float(age[s]), float(2 * age[s])) for s in range(n)],
        "sample_id bigint, sex int, age double, twice_age double")
    return dict(calls=calls, y=y, sex=sex, age=age, geno=geno, samples=samples, pheno=pheno, cov=cov)


def _expected(study, variant, trait, covariates):
    y = study["y"][trait]
    keep = ~np.isnan(y)
    x = np.array([np.nan if v is None else v for v in study["calls"][variant]], float)[keep]
    x = np.where(np.isnan(x), np.nanmean(x), x)
    return _ols(y[keep], x, [c[keep].astype(float) for c in covariates])


def _check(study, got, covariates):
    seen = 0
    for r in got.collect():
        i = int(r["ID"][1:])
        if i == 0:
            assert r["beta"] is None and r["tstat"] is None and r["pval"] is None
            continue
        beta, t, n, dof = _expected(study, i, r["phenotype"], covariates)
        assert r["beta"] == pytest.approx(beta, rel=1e-7, abs=1e-9)
        assert r["tstat"] == pytest.approx(t, rel=1e-7, abs=1e-9)
        assert r["n"] == n
        assert r["pval"] == pytest.approx(student_t_two_sided(np.array([t]), np.array([dof]))[0], rel=1e-5)
        seen += 1
    assert seen == 11 * 5


def test_regression_equals_least_squares(study):
    _check(study, association.association(study["geno"], study["samples"], study["pheno"]), [])


def test_covariates_equal_the_full_design(study):
    got = association.association(study["geno"], study["samples"], study["pheno"], study["cov"].drop("twice_age"))
    _check(study, got, [study["sex"], study["age"]])


def test_collinear_covariate_costs_no_degree_of_freedom(study):
    got = association.association(study["geno"], study["samples"], study["pheno"], study["cov"])
    _check(study, got, [study["sex"], study["age"]])


def test_small_blocks_stripes_and_groups_give_the_same(study, monkeypatch):
    columns = ["ID", "phenotype", "n"]
    cov = study["cov"].drop("twice_age")
    one = association.association(study["geno"], study["samples"], study["pheno"], cov, pvalues=False)
    monkeypatch.setattr(association, "BLOCK_PHENOTYPES", 2)
    monkeypatch.setattr(association, "STRIPE_SAMPLES", 9)
    monkeypatch.setattr(association, "GROUP_VARIANTS", 5)
    monkeypatch.setattr(association, "fits_broadcast", lambda df: False)
    many = association.association(study["geno"], study["samples"], study["pheno"], cov, pvalues=False)
    assert rows(one, *columns) == rows(many, *columns)
    a = {(r.ID, r.phenotype): r.beta for r in one.collect()}
    b = {(r.ID, r.phenotype): r.beta for r in many.collect()}
    assert all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a if a[k] is not None)
    _check(study, association.association(study["geno"], study["samples"], study["pheno"], cov), [study["sex"], study["age"]])


def test_exact_test_at_biobank_size_stays_in_the_row(spark):
    from math import exp, lgamma, log

    def brute(ref, het, var):
        minor, n = min(2 * ref + het, 2 * var + het), ref + het + var

        def lw(h):
            rare = (minor - h) // 2
            return h * log(2) - lgamma(rare + 1) - lgamma(h + 1) - lgamma(n - h - rare + 1)

        scale = lgamma(n + 1) + lgamma(minor + 1) + lgamma(2 * n - minor + 1) - lgamma(2 * n + 1)
        weights = [exp(lw(h) + scale) for h in range(minor % 2, minor + 1, 2)]
        seen = exp(lw(het) + scale)
        return min(1.0, sum(w for w in weights if w <= seen * (1 + 1e-8)) - seen / 2)

    data = [("a", 100_000, 200_000, 100_500), ("b", 399_000, 1_000, 3), ("c", 5, 1, 0), ("d", 0, 0, 0), ("e", 200_000, 0, 200_000), ("f", 50_000, 99_000, 51_000)]
    counts = spark.createDataFrame(data, "ID string, n_hom_ref bigint, n_het bigint, n_hom_var bigint")
    tested = association.with_hwe(association._with_frequency(counts)).select("ID", "p_hwe")
    plan = tested._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan, "a variant stays one row"
    got = {r.ID: r.p_hwe for r in tested.collect()}
    for name, *three in data:
        assert got[name] == pytest.approx(brute(*three), rel=1e-6, abs=1e-12), name


def test_names_with_dots_and_no_usable_sample(spark):
    geno = spark.createDataFrame([("v", s, s % 3) for s in range(9)], GENO)
    samples = spark.createDataFrame([(s,) for s in range(9)], "sample_id bigint")
    pheno = spark.createDataFrame([(s, float(s % 4)) for s in range(9)], "sample_id bigint, `a.b c` double")
    cov = spark.createDataFrame([(s, float(s)) for s in range(9)], "sample_id bigint, `pc.1` double")
    assert association.association(geno, samples, pheno, cov).first().phenotype == "a.b c"
    with pytest.raises(ValueError, match="no genotyped sample"):
        association.association(geno, samples, pheno.filter("sample_id < 0"))


def _counted(spark, df):
    """The rows of ``df`` with a counter of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_genotypes_are_scanned_once_for_many_traits_with_gaps(spark):
    """200 phenotypes, each missing for other samples, 11 covariates and quality control."""
    rng = np.random.default_rng(3)
    n, variants, traits = 300, 40, 200
    calls = rng.binomial(2, 0.3, (variants, n))
    cov = rng.normal(0, 1, (n, 11))
    y = rng.normal(0, 1, (n, traits)) + cov[:, :1] + 0.3 * calls[np.arange(traits) % variants].T
    y[rng.random((n, traits)) < 0.1] = np.nan
    geno = spark.createDataFrame([(f"v{i}", s, int(calls[i, s])) for i in range(variants) for s in range(n)], GENO)
    counted, seen = _counted(spark, geno)
    samples = spark.createDataFrame([(s,) for s in range(n)], "sample_id bigint")
    pheno = spark.createDataFrame([(s, *map(float, y[s])) for s in range(n)], "sample_id bigint, " + ", ".join(f"y{k} double" for k in range(traits)))
    axes = spark.createDataFrame([(s, *map(float, cov[s])) for s in range(n)], "sample_id bigint, " + ", ".join(f"pc{k} double" for k in range(11)))
    fits = association.association(counted, samples, pheno, axes, min_af=0.05, min_p_hwe=1e-6, pvalues=False)
    got = {(r.ID, r.phenotype): r for r in fits.collect()}
    assert seen.value == n * variants, "one scan"
    assert len(got) == variants * traits
    for i, k in [(0, 0), (7, 7), (39, 199), (5, 120)]:
        keep = ~np.isnan(y[:, k])
        beta, t, count, _ = _ols(y[keep, k], calls[i][keep].astype(float), [c[keep] for c in cov.T])
        r = got[f"v{i}", f"y{k}"]
        assert (r.beta, r.tstat, r.n) == (pytest.approx(beta, rel=1e-8), pytest.approx(t, rel=1e-8), count)


def test_quality_control_keeps_the_same_variants_and_reads_once(spark, study):
    counted, seen = _counted(spark, study["geno"])
    fits = association.association(counted, study["samples"], study["pheno"], min_af=0.05, min_p_hwe=1e-6)
    kept = {r.ID for r in fits.select("ID").distinct().collect()}
    assert seen.value == study["geno"].count()
    qc = association.variant_qc(study["geno"])
    assert kept == {r.ID for r in association.variant_qc_filter(qc).collect()}


def test_phenotypes_with_equal_gaps_share_sums(study):
    table = study["pheno"].join(study["cov"].drop("twice_age"), "sample_id")
    designs = association._designs(table, list(study["y"]), ["sex", "age"])
    [block] = association._blocks(designs, 2)
    names = [d.phenotype for d in block.designs]
    assert len(block.leads) == 2 and block.columns == 2 * 3 + 5
    gapped = names.index("trait 1")
    assert {block.group[i] for i in range(5) if i != gapped} == {1 - block.group[gapped]}


def test_calls_outside_the_sample_table_are_counted_only(spark, study):
    geno = study["geno"].union(spark.createDataFrame([("elsewhere", 5000 + s, s % 3) for s in range(6)], GENO))
    got = association.association(geno, study["samples"], study["pheno"])
    r = got.filter("ID = 'elsewhere'").collect()
    assert len(r) == 5 and all(x.beta is None and x.af == 0.5 for x in r)


def test_packed_calls(spark):
    geno = spark.createDataFrame([("a", 1, 2), ("a", 3, 0), ("a", 3, 1), ("a", 2, None), ("a", 9, 1), ("b", 7, 2)], GENO)
    slots = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 0, 2), (9, 1, 0)], "sample_id bigint, stripe int, slot int")
    got = {(r.ID, r.stripe): (bytes(r.calls), r.n_hom_ref, r.n_het, r.n_hom_var) for r in association.pack_genotypes(geno, slots).collect()}
    assert got == {("a", 0): (b"\x02\xff\x01", 1, 1, 1), ("a", 1): (b"\x01", 0, 1, 0), ("b", -1): (b"", 0, 0, 1)}


def test_few_calls_are_packed_as_a_list(spark):
    geno = spark.createDataFrame([("a", 3_999, 2), ("a", 7, 0), ("a", 7, 1), ("a", 8, None), ("b", 0, 1)], GENO)
    slots = spark.range(4_000).selectExpr("id AS sample_id", "0 AS stripe", "cast(id AS int) AS slot")
    got = {r.ID: r for r in association.pack_genotypes(geno, slots).collect()}
    assert len(got["a"].calls) == 2 * association.SPARSE_CALL.itemsize and got["a"].sparse
    assert np.frombuffer(bytes(got["a"].calls), association.SPARSE_CALL).tolist() == [(7, 1), (3_999, 2)]
    assert (bytes(got["b"].calls), got["b"].sparse) == (b"\x01", False)


@pytest.mark.parametrize("terms", [1, 1 << 21])
def test_sparse_and_dense_variants_equal_least_squares(spark, monkeypatch, terms):
    """Most variants are called in a twentieth of the samples, some in all; a list is cut into chunks or not."""
    monkeypatch.setattr(association, "CHUNK_TERMS", terms)
    monkeypatch.setattr(association, "STRIPE_SAMPLES", 150)
    rng = np.random.default_rng(23)
    n, variants = 400, 9
    calls = rng.binomial(2, 0.4, (variants, n)).astype(float)
    calls[2:][rng.random((variants - 2, n)) > 0.05] = np.nan
    sex, y = rng.integers(0, 2, n), rng.normal(0, 1, n)
    geno = spark.createDataFrame([(f"v{i}", s, int(calls[i, s])) for i in range(variants) for s in range(n) if not np.isnan(calls[i, s])], GENO)
    samples = spark.createDataFrame([(s,) for s in range(n)], "sample_id bigint")
    pheno = spark.createDataFrame([(s, float(y[s])) for s in range(n)], "sample_id bigint, y double")
    cov = spark.createDataFrame([(s, int(sex[s])) for s in range(n)], "sample_id bigint, sex int")
    got = {r.ID: r for r in association.association(geno, samples, pheno, cov).collect()}
    assert len(got) == variants
    for i in range(variants):
        x = np.where(np.isnan(calls[i]), np.nanmean(calls[i]), calls[i])
        beta, t, count, _ = _ols(y, x, [sex.astype(float)])
        assert (got[f"v{i}"].beta, got[f"v{i}"].tstat, got[f"v{i}"].n) == (pytest.approx(beta, rel=1e-8), pytest.approx(t, rel=1e-8), count)


def test_groups_follow_what_is_packed(spark):
    """Three calls of a variant in a wide stripe need no group per thousand variants, dense ones do."""
    packed = lambda size: spark.range(4_000).select(F.lit(0).alias("stripe"), F.lit(bytes(size)).alias("calls"))
    assert association._groups(packed(15), 10) == 1
    assert association._groups(packed(association.STRIPE_SAMPLES), 10) == 4
    assert association._groups(packed(15), association.GROUP_SUMS // 1_000) == 4


def test_quality_counts_and_one_sided_frequency(spark):
    geno = spark.createDataFrame(
        [("common", s, s % 3) for s in range(30)] + [("rare", s, 0) for s in range(30)]
        + [("fixed", s, 2) for s in range(30)] + [("empty", 1, None)], GENO)
    qc = association.variant_qc(geno)
    got = {r.ID: r for r in qc.collect()}
    assert (got["common"].n_hom_ref, got["common"].n_het, got["common"].n_hom_var, got["common"].af) == (10, 10, 10, 0.5)
    assert got["empty"].n_called == 0 and got["empty"].af is None
    assert {r.ID for r in association.variant_qc_filter(qc).collect()} == {"common", "fixed"}
    assert {r.ID for r in association.variant_qc_filter(qc, two_sided=True).collect()} == {"common"}


def test_published_layout(spark, study):
    variants = spark.createDataFrame([("v1", 1, 5, "A", "G")], "ID string, chromosome int, position bigint, OA string, EA string")
    table = association.gwas_table(association.association(study["geno"], study["samples"], study["pheno"]), variants)
    assert table.columns == ["rsid", "chromosome", "position", "OA", "EA", "EAF", "pval", "beta", "tstat", "n", "phenotype"]


@pytest.mark.parametrize("n", [1, 2, 7, 400, 1001])
def test_middle_pvalues_are_exact_order_statistics(spark, n):
    rng = np.random.default_rng(n)
    sets = {
        "uniform": rng.random(n), "tiny": 10.0 ** -rng.uniform(6, 300, n), "copies": np.repeat(0.25, n),
        "zeros": np.where(np.arange(n) % 3 > 0, 0.0, rng.random(n)), "narrow": 0.5 + rng.random(n) * 1e-12,
    }
    df = spark.createDataFrame([(k, float(v)) for k, vs in sets.items() for v in vs] + [("uniform", None)], "phenotype string, pval double")
    got = {r.phenotype: (r.p_low, r.p_high) for r in association.middle_pvalues(df).collect()}
    for k, vs in sets.items():
        s = np.sort(vs)
        assert got[k] == (s[(n - 1) // 2], s[n // 2])


def test_inflation_is_the_median_chi2_ratio(spark):
    rng = np.random.default_rng(5)
    chi2 = rng.chisquare(1, 500) * 1.3
    df = spark.createDataFrame([("t", math.erfc(math.sqrt(c / 2))) for c in chi2], "phenotype string, pval double")
    got = association.genomic_inflation(df).first()
    assert got.lambda_gc == pytest.approx(np.median(chi2) / chi2_isf(0.5), rel=1e-10)
