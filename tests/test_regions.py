import random

from conftest import rows
from locusweave.operators import regions
from locusweave.schemas import REGION, SUMSTATS

GENES = "gene_name string, chromosome int, gene_start bigint, gene_end bigint"


def _hit(chrom, pos, chi2=30.0, phenotype="a", id_=None, ea="G"):
    return (id_ or f"rs{chrom}_{pos}", 0.1, chi2, 10.0 ** -chi2, f"chr{chrom}:{pos}", chrom, pos, "A", ea, 0.1, 0.9, phenotype)


def _regions(spark, data, **kwargs):
    return regions.hit_regions(spark.createDataFrame(data, SUMSTATS), **kwargs)


def test_hits_up_to_twice_the_buffer_apart_share_a_region(spark):
    data = [_hit(1, 10_000), _hit(1, 12_000), _hit(1, 14_001)]
    got = _regions(spark, data, window_buffer=1000)
    assert got.columns == REGION.fieldNames()
    assert rows(got, "chromStart", "chromEnd", "num_included_variants") == [(9_000, 13_000, 2), (13_001, 15_001, 1)]


def test_start_is_clamped_to_two(spark):
    assert rows(_regions(spark, [_hit(1, 40)], window_buffer=100), "chromStart", "chromEnd") == [(2, 140)]


def test_counts_are_of_rows_and_traits_are_distinct_and_sorted(spark):
    data = [_hit(1, 500, phenotype=p) for p in ("b", "a", "b")] + [_hit(1, 600, phenotype="c")]
    got = _regions(spark, data, window_buffer=100)
    assert rows(got, "num_included_variants", "num_phenotypes", "phenotypes") == [(4, 3, ["a", "b", "c"])]


def test_traits_with_commas_and_the_last_chromosomes_keep_their_hits(spark):
    from locusweave.functions.traits import decode_traits, encode_traits

    names = ["IL2, free", "50 %", "a%2Cb", "plain"]
    data = [_hit(c, 500 + i, phenotype=p) for c in (1, 24, 25) for i, p in enumerate(names)]
    hits = spark.createDataFrame(data, SUMSTATS)
    table = regions.hit_regions(hits, window_buffer=100)
    coded = table.withColumn("phenotypes", encode_traits("phenotypes")).withColumn("phenotypes", decode_traits("phenotypes"))
    assert rows(coded, "phenotypes") == [(sorted(names),)] * 3
    assert regions.region_hits(coded, hits).count() == len(data)


def test_lead_is_smallest_p_then_largest_chi2_then_position(spark):
    data = [_hit(1, 700, 400.0), _hit(1, 500, 500.0), _hit(1, 400, 500.0), _hit(1, 450, 30.0)]
    got = _regions(spark, data, window_buffer=1000)
    assert rows(got, "leadSnp_pos") == [(400,)]


def test_input_order_does_not_matter(spark):
    rng = random.Random(3)
    data = [_hit(rng.randrange(1, 4), rng.randrange(1, 10**6), rng.choice([30.0, 31.0]), rng.choice("abc")) for _ in range(300)]
    first = rows(_regions(spark, data, window_buffer=2000))
    rng.shuffle(data)
    assert rows(_regions(spark, data, window_buffer=2000)) == first


def test_nearest_gene_by_start_with_na(spark):
    genes = spark.createDataFrame(
        [("far_start_over_lead", 1, 100, 5_000), ("near_start", 1, 5_600, 5_700), ("elsewhere", 2, 9_000_000, 9_000_100)], GENES)
    data = [_hit(1, 5_000), _hit(2, 10), _hit(23, 77)]
    got = _regions(spark, data, genes=genes, window_buffer=100)
    assert rows(got, "chrom", "leadSnp_closest_gene") == [(1, "near_start"), (2, "NA"), (23, "NA")]
    assert rows(_regions(spark, data, window_buffer=100), "leadSnp_closest_gene") == [("NA",)] * 3


def test_hits_are_read_once_for_the_gene_search(spark, tmp_path):
    path = str(tmp_path / "hits")
    spark.createDataFrame([_hit(1, p) for p in range(1000, 90_000, 700)], SUMSTATS).write.parquet(path)
    genes = spark.createDataFrame([("g", 1, 100, 5_000)], GENES)
    found = spark.read.parquet(path)
    for traits, scans in ((regions.number_traits(found), 1), (None, 0)):  # settled when the traits had to be looked for
        df = regions.hit_regions(found, genes, 100, traits=traits)
        assert df.count() > 0
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan parquet") == scans


def test_hits_without_a_trait_count_but_are_not_listed(spark):
    data = [_hit(1, 500), _hit(1, 500, phenotype=None), _hit(2, 10, phenotype=None)]
    got = _regions(spark, data, window_buffer=100)
    assert rows(got, "chrom", "num_included_variants", "num_phenotypes", "phenotypes") == [(1, 2, 1, ["a"]), (2, 1, 0, [])]


def test_region_numbers_names_and_members(spark):
    data = [_hit(1, 5_000), _hit(1, 5_050, phenotype="b"), _hit(2, 900, phenotype="b"), _hit(23, 40)]
    found = spark.createDataFrame(data, SUMSTATS)
    table = regions.hit_regions(found, window_buffer=100)
    other = _hit(1, 5_010, phenotype="z")
    members = regions.region_hits(table, found.union(spark.createDataFrame([other], SUMSTATS)))
    assert members.columns == ["region_id", "region", "chromosome", "position", "position2", "EA", "pval", "phenotype"]
    assert rows(members, "region", "position", "position2", "phenotype") == [
        ("region_1_chr1:4900-5150", 5_000, 5_000, "a"), ("region_1_chr1:4900-5150", 5_050, 5_050, "b"),
        ("region_2_chr2:800-1000", 900, 900, "b"), ("region_3_chr23:2-140", 40, 40, "a")]
    assert "position2" not in regions.region_hits(table, found, bed=False).columns


def test_gene_table_from_annotation(spark):
    schema = "seqname string, feature string, start bigint, end bigint, attributes string"
    rows_ = [("chrX", "gene", 5, 9, 'gene_id "E1"; gene_type "x"; gene_name "ABC"; level 2;'),
             ("chrX", "exon", 5, 9, 'gene_name "ABC"')]
    assert rows(regions.gene_table(spark.createDataFrame(rows_, schema))) == [(23, 5, 9, "ABC")]
