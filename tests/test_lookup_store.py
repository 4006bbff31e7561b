"""Landed expression tables: lookups give what a semi join gives, from few row groups."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from locusweave.operators.eqtl import eqtl_lookup
from locusweave.plans import workflows
from locusweave.sources import lookup_store


@pytest.fixture
def table(spark):
    """Even IDs only, two cell types, one ID with a third of the rows, and rows without an ID."""
    plain = spark.range(0, 60_000, 2).select(F.format_string("rs%08d", "id").alias("rsid"), F.col("id").alias("n"))
    hot = spark.range(15_000).select(F.lit("rs00001000").alias("rsid"), F.col("id").alias("n"))
    lost = spark.range(3).select(F.lit(None).cast("string").alias("rsid"), F.col("id").alias("n"))
    return plain.union(hot).union(lost).select(
        "rsid", F.lit("chr1").alias("chromosome"), F.col("n").alias("position_hg38"), F.concat(F.lit("G"), F.col("n") % 7).alias("gene"),
        F.lit(1e-9).alias("pval"), F.col("n").cast("double").alias("slope"),
        F.when(F.col("n") % 4 == 0, "NK").otherwise("CD8_T").alias("cell_type"))


def scanned(df):
    """Rows that the scan hands on: those of the row groups it did not skip."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert len(found) == 1
    return found[0]


@pytest.mark.parametrize("listed", [lookup_store.LISTED_IDS, 2])
def test_lookup_equals_the_join(spark, tmp_path, table, listed):
    lookup_store.land_eqtls(table, str(tmp_path / "e"))
    ids = spark.createDataFrame([("rs00000004",), ("rs00000004",), ("rs00001000",), ("rs00000005",), (None,), ("",)], "rsid string")
    got = lookup_store.look_up(spark, str(tmp_path / "e"), ids, listed)
    assert rows(got) == rows(eqtl_lookup(table, ids)) and got.count() == 15_002
    assert lookup_store.look_up(spark, str(tmp_path / "e"), ids.limit(0), listed).count() == 0


def test_row_groups_are_skipped(spark, tmp_path, table, conf):
    conf(spark__sql__adaptive__enabled="false")
    lookup_store.land_eqtls(table, str(tmp_path / "e"), row_group_bytes=64 << 10)
    whole = table.count()

    def ask(*ids):
        return lookup_store.look_up(spark, str(tmp_path / "e"), spark.createDataFrame([(i,) for i in ids], "rsid string"))

    assert 1 <= scanned(ask("rs00040004")) < whole / 3
    # An odd ID lies inside the range of a row group; its bloom filter alone can tell that it is not there.
    assert sum(scanned(ask(f"rs{n:08d}")) == 0 for n in range(20_001, 20_041, 4)) >= 8
    many = [f"rs{n:08d}" for n in range(20_001, 20_041, 2)]  # more than are compared one by one
    assert scanned(ask(*many)) < whole / 3


def test_workflow_reads_the_store(spark, tmp_path):
    head = ("Variant_ID", "Variant_CHR", "Variant_position_start", "Gene_name", "Forward_nominal_P", "Forward_slope")
    (tmp_path / "e").mkdir()
    lines = [head, ("rs1", "chr10", "5", "G1", "1e-9", "0.5"), ("rs2", "chr2", "7", "G2", "1e-8", "0.1"), ("rs3", "chr2", "9", "G2", "1e-8", "0.1")]
    (tmp_path / "e" / "CD8_T_a_b_c.txt").write_text("\n".join("\t".join(line) for line in lines) + "\n")
    ids = tmp_path / "ids.txt"
    ids.write_text("rs1\nrs2")
    store = workflows.land_references(spark, str(tmp_path / "landed"), eqtls=str(tmp_path / "e"))["eqtls"]
    plain = workflows.look_up_eqtls(spark, str(tmp_path / "e"), str(ids), str(tmp_path / "plain"))
    fast = workflows.look_up_eqtls(spark, store, str(ids), str(tmp_path / "fast"), landed=True)
    read = lambda path: spark.read.option("sep", "\t").option("header", True).csv(path)
    assert rows(read(fast)) == rows(read(plain)) and read(fast).count() == 2
