import pytest

from conftest import rows
from locusweave.operators import eqtl

VARIANT = "ID string, chromosome int, position bigint, OA string, EA string"
A = "rsid string, chromosome int, position bigint, OA string, EA string, gene string, cell_type string, pval double, slope double"
B = "chromosome int, position bigint, ref string, alt string, gene string, source string"


@pytest.fixture
def tables(spark):
    variants = spark.createDataFrame(
        [("v1", 1, 100, "A", "G"), ("v2", 1, 100, "A", "T"), ("v3", 23, 5, "CA", "C")], VARIANT)
    a = spark.createDataFrame([
        ("v1", 1, 100, "A", "G", "g1", "T", 1e-9, 0.1), ("v1", 1, 100, "A", "G", "g1", "B", 1e-7, 0.1),
        ("v1", 1, 100, "A", "G", "g2", "B", 1e-8, 0.1), ("v2", 1, 100, "G", "A", "g3", "B", 1e-8, 0.1),
        ("v3", 23, 5, "CA", "C", "g4", "B", 1e-5, 0.2)], A)
    b = spark.createDataFrame([
        (1, 100, "A", "G", "h1", "lung"), (1, 100, "A", "G", "h2", "skin"), (1, 100, "G", "A", "h3", "skin")], B)
    return variants, a, b


def test_lookup_takes_listed_ids_once(spark, tables):
    _, a, _ = tables
    wanted = spark.createDataFrame([("v1",), ("v1",), ("nope",)], "rsid string")
    assert rows(eqtl.eqtl_lookup(a, wanted), "rsid", "gene") == [("v1", "g1"), ("v1", "g1"), ("v1", "g2")]


def test_alleles_must_match_exactly_and_in_order(tables):
    variants, a, _ = tables
    got = eqtl.variant_allele_join(variants, eqtl.first_collection(a))
    assert rows(got, "ID", "gene_a") == [("v1", "g1"), ("v1", "g1"), ("v1", "g2"), ("v3", "g4")]


def test_trimming_joins_differently_padded_indels(spark):
    left = spark.createDataFrame([("v", 1, 100, "CAT", "CAATT")], VARIANT)
    right = spark.createDataFrame([("x", 1, 101, "A", "AAT", "g", "c", 0.1, 0.1)], A)
    right = eqtl.first_collection(right)
    assert eqtl.variant_allele_join(left, right).count() == 0
    padded = spark.createDataFrame([("x", 1, 99, "GCAT", "GCAATT", "g", "c", 0.1, 0.1)], A)
    assert eqtl.variant_allele_join(left, eqtl.first_collection(padded), trim_alleles=True).count() == 1


def test_chained_needs_both_and_union_lists_each(tables):
    variants, a, b = tables
    chained = eqtl.causal_gene_candidates(variants, a, b)
    assert chained.count() == 3 * 2 and {r.ID for r in chained.collect()} == {"v1"}
    union = eqtl.causal_gene_candidates(variants, a, b, mode="union")
    assert rows(union.groupBy("collection").count()) == [("a", 4), ("b", 2)]
    with pytest.raises(ValueError):
        eqtl.causal_gene_candidates(variants, a, b, mode="other")


def test_gene_rank_by_best_p_with_cell_type_support(tables):
    variants, a, _ = tables
    got = eqtl.causal_gene_rank(eqtl.variant_allele_join(variants, eqtl.first_collection(a)))
    assert rows(got, "position", "gene", "best_pval", "num_cell_types", "gene_rank") == [
        (5, "g4", 1e-5, 1, 1), (100, "g1", 1e-9, 2, 1), (100, "g2", 1e-8, 1, 2)]


def test_genomic_table_checks_and_prefixes(spark):
    df = spark.createDataFrame([(1, 5, "x"), (23, 6, "y")], "c int, p bigint, extra string")
    got = eqtl.to_genomic_table(df, "c", "p", [" extra"])
    assert got.columns == ["#Chrom", "Pos", "extra"]
    assert rows(got, "#Chrom", "Pos") == [("chr1", 5), ("chr23", 6)]
    with pytest.raises(ValueError, match="absent"):
        eqtl.to_genomic_table(df, "c", "p", ["absent"])
