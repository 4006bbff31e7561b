import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from locusweave.functions import loci
from locusweave.operators import tf_binding


def test_chromosome_names_and_numbers(spark):
    names = ["chr1", "22", "chrX", "X", "chrY", "MT", "chrM", "23", "chrUn_1", None, "0", "26"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    number = loci.chrom_number(F.col("c"))
    got = [tuple(r) for r in df.select(number, loci.chrom_name(number)).collect()]
    assert [g[0] for g in got] == [1, 22, 23, 23, 24, 25, 25, 23, None, None, None, None]
    assert [g[1] for g in got[:5]] == ["chr1", "chr22", "chrX", "chrX", "chrY"]


def test_prefix_is_added_once(spark):
    df = spark.createDataFrame([("chr5",), ("5",)], "c string")
    assert [r[0] for r in df.select(loci.add_chr(F.col("c"))).collect()] == ["chr5", "chr5"]


def test_marker_parsing_maps_x_and_tolerates_junk(spark):
    markers = ["chr3:1200", "chrX:77", "chr4-99", "chrQ:5", None, "chrY:5", "chrM:7", "chrMT:3", "X:9", "26:4"]
    df = loci.parse_marker(spark.createDataFrame([(m,) for m in markers], "Marker string"))
    assert [tuple(r) for r in df.collect()] == [
        ("chr3:1200", 3, 1200), ("chr23:77", 23, 77), ("chr4-99", None, None), ("chrQ:5", None, 5),
        (None, None, None), ("chrY:5", 24, 5), ("chrM:7", 25, 7), ("chrMT:3", 25, 3), ("X:9", 23, 9), ("26:4", 26, 4)]


def test_variant_keys_of_snvs_and_indels(spark):
    df = spark.createDataFrame(
        [("v1", "chr2", 501, "G", "T"), ("v2", "chr11", 90, "CTAT", "CTATTAT"), ("v3", "chr9", 7, "AG", "A")],
        "ID string, Chrom string, Pos bigint, OA string, EA string")
    assert rows(tf_binding.variant_key_map(df), loci.VARIANT_KEY) == [
        ("chr11:90CTAT>CTATTAT",), ("chr2:501G>T",), ("chr9:7AG>A",)]
    with pytest.raises(ValueError, match="OA"):
        tf_binding.variant_key_map(df.drop("OA"))


def _trim(pos, oa, ea):
    while len(oa) > 1 and len(ea) > 1 and oa[-1] == ea[-1]:
        oa, ea = oa[:-1], ea[:-1]
    while len(oa) > 1 and len(ea) > 1 and oa[0] == ea[0]:
        pos, oa, ea = pos + 1, oa[1:], ea[1:]
    return pos, oa, ea


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("AC", min_size=1, max_size=6), st.text("AC", min_size=1, max_size=6)), min_size=20, max_size=40))
def test_allele_trimming_equals_letter_by_letter(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pos bigint, oa string, ea string")
    got = df.select("pos", loci.trimmed_alleles(F.col("pos"), F.col("oa"), F.col("ea")).alias("t")).collect()
    for r in got:
        assert tuple(r["t"]) == _trim(r["pos"], *pairs[r["pos"]])
