import math

import pytest

from conftest import rows
from locusweave.functions.stats import chi2_isf
from locusweave.operators import hits
from locusweave.schemas import SUMSTATS, SUMSTATS_COLUMNS

INFO = "ID string, Marker string, OA string, EA string, EAF double, Info double"
RESULT = "ID string, beta double, chi2 double, phenotype string"


@pytest.fixture
def info(spark):
    return spark.createDataFrame([
        ("rs1", "chr1:100", "A", "G", 0.1, 0.9), ("rs2", "chrX:200", "C", "T", 0.2, 0.8),
        ("rs3", "chr2:300", "G", "A", 0.3, 0.7)], INFO)


def _hit(id_, chi2, phenotype, pos=1, beta=0.1):
    return (id_, beta, chi2, math.erfc(math.sqrt(chi2 / 2)), f"chr1:{pos}", 1, pos, "A", "G", 0.1, 0.9, phenotype)


def test_threshold_is_strict_and_unmatched_ids_stay(spark, info):
    edge = chi2_isf(1e-6)
    results = spark.createDataFrame(
        [("rs1", 0.5, edge, "t"), ("rs2", 0.5, edge + 1e-9, "t"), ("rs9", -0.5, 40.0, "t"), ("rs3", 0.1, 3.0, "t")], RESULT)
    got = hits.significant_hits(results, info)
    assert got.columns == SUMSTATS_COLUMNS
    assert rows(got, "ID", "Marker", "chromosome", "position") == [("rs2", "chr23:200", 23, 200), ("rs9", None, None, None)]
    assert hits.significant_hits(results, info, 2).count() == 3


def test_no_hits_keeps_the_layout(spark, info):
    got = hits.significant_hits(spark.createDataFrame([("rs1", 0.5, 1.0, "t")], RESULT), info)
    assert got.count() == 0 and got.columns == SUMSTATS_COLUMNS


def test_filter_reaches_the_scan_before_the_join(spark, info, tmp_path):
    path = str(tmp_path / "results")
    spark.createDataFrame([("rs1", 0.5, 50.0, "t")], RESULT).write.parquet(path)
    plan = hits.significant_hits(spark.read.parquet(path), info)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(chi2,23.9" in plan


def test_full_sumstats_of_one_or_all_traits(spark, info):
    results = spark.createDataFrame([("rs1", 0.5, 1.0, "a"), ("rs1", 0.5, 2.0, "b")], RESULT)
    assert hits.full_sumstats(results, info).count() == 2
    assert rows(hits.full_sumstats(results, info, "b"), "phenotype", "chi2") == [("b", 2.0)]


def test_best_trait_survives_underflowing_pvalues(spark):
    table = spark.createDataFrame([
        _hit("rs1", 30.0, "a"), _hit("rs1", 50.0, "b"), _hit("rs1", 50.0, "c"), _hit("rs2", 2000.0, "a"),
        _hit("rs2", 3000.0, "b")], SUMSTATS)
    assert rows(hits.best_per_variant(table), "ID", "phenotype") == [("rs1", "b"), ("rs2", "b")]
    plan = hits.best_per_variant(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_all_hits_order_and_names(spark):
    a = spark.createDataFrame([_hit("rs1", 30.0, "a", 50), _hit("rs2", 31.0, "a", 7)], SUMSTATS)
    b = spark.createDataFrame([_hit("rs1", 33.0, "b", 50)], SUMSTATS)
    assert [(r.ID, r.phenotype) for r in hits.all_hits([a, b]).collect()] == [("rs2", "a"), ("rs1", "a"), ("rs1", "b")]
    assert [(r.ID, r.phenotype) for r in hits.all_hits([a, b], True).collect()] == [("rs2", "a"), ("rs1", "b")]
    assert hits.hits_table_name("run", "6") == "run_hits_only_10E6_one_pheno_only_per_variant"
    assert hits.hits_table_name("run", one_per_variant=False) == "run_hits_only_all_phenotypes_per_variant"


def test_alias_with_and_without_map(spark):
    table = spark.createDataFrame([_hit("rs1", 30.0, "a"), _hit("rs1", 30.0, "b")], SUMSTATS)
    names = spark.createDataFrame([("a", "Lineage 1")], "phenotype string, alias string")
    assert rows(hits.assign_alias(table, names), "phenotype", "alias") == [("a", "Lineage 1"), ("b", "<no data>")]
    assert rows(hits.assign_alias(table, None), "phenotype", "alias") == [("a", "a"), ("b", "b")]


def test_combined_keeps_equal_rows_once(spark):
    template = spark.createDataFrame([_hit("rs1", 30.0, "a"), _hit("rs2", 1.0, "a"), _hit("rs1", 29.0, "a")], SUMSTATS)
    found = spark.createDataFrame([_hit("rs1", 30.0, "a"), _hit("rs1", 30.0, "b"), _hit("rs1", 30.0, "b")], SUMSTATS)
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "phenotype string, alias string")
    got = hits.combined_sumstats(template, found, names)
    assert rows(got, "ID", "chi2", "phenotype", "alias") == [
        ("rs1", 29.0, "a", "<no data>"), ("rs1", 30.0, "a", "<no data>"), ("rs1", 30.0, "b", "B"),
        ("rs2", 1.0, "a", "<no data>")]
    assert ("rs1", 30.0, "a", "A") in rows(
        hits.combined_sumstats(template, found, names, prefer="hits"), "ID", "chi2", "phenotype", "alias")
    assert rows(hits.count_aliases(got)) == [(2,)]
    with pytest.raises(ValueError):
        hits.combined_sumstats(template, found, names, prefer="neither")


def test_manhattan_axis_and_lines(spark):
    def at(chrom, pos, p):
        return ("rs", 0.1, 1.0, p, f"chr{chrom}:{pos}", chrom, pos, "A", "G", 0.1, 0.9, "a", "A")

    table = spark.createDataFrame(
        [at(1, 10, 0.1), at(1, 90, 1e-8), at(3, 5, 1e-12), at(23, 1, 0.5), at(None, 1, 0.5)],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SUMSTATS.fields) + ", alias string")
    points = hits.manhattan_points(table)
    got = [(x, round(y, 6), g, s) for x, y, g, s in rows(points, "x", "y", "is_genome_wide", "is_significant")]
    assert got == [(10, 1.0, False, False), (90, 8.0, True, False), (95, 12.0, True, True), (96, 0.30103, False, False)]


def test_thinning_keeps_everything_above_the_line(spark):
    data = [("rs%d" % i, i, 0.05 * (i % 7), "a", "A", 1) for i in range(200)]
    data += [("hi%d" % i, i, 9.0, "a", "A", 1) for i in range(5)]
    points = spark.createDataFrame(data, "ID string, x bigint, y double, phenotype string, alias string, chromosome int")
    thin = hits.manhattan_thinned(points, x_width=50)
    assert thin.filter("y > 7.4").count() == 5
    low = thin.filter("y < 7.4")
    cells = {}
    for id_, x, y, *_ in data[:200]:
        cells[(x // 50, math.floor(y / 0.1))] = max(cells.get((x // 50, math.floor(y / 0.1)), 0), y)
    assert low.count() == len(cells)
    assert sorted(r.y for r in low.collect()) == sorted(cells.values())
