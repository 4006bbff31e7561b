import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from locusweave import schemas
from locusweave.operators import hits, regions, tf_binding
from locusweave.plans import catalog
from locusweave.plans.fixtures import Tables
from locusweave.sources import files, sinks


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_variant_info_columns_in_any_order(spark, tmp_path):
    path = _write(tmp_path / "vi.txt", "Extra\tID\tMarker\tEA\tOA\tInfo\tEAF\nz\trs1\tchr1:5\tG\tA\t0.9\t0.1\n")
    assert rows(files.read_variant_info(spark, path)) == [("rs1", "chr1:5", "A", "G", 0.1, 0.9)]
    short = _write(tmp_path / "short.txt", "ID\tMarker\nrs1\tchr1:5\n")
    with pytest.raises(ValueError, match="OA"):
        files.read_variant_info(spark, short)


def test_result_directory_plain_and_gzipped(spark, tmp_path):
    folder = tmp_path / "res"
    _write(folder / "a_b_c_d_CD4_naive_x_y_z.res", "rs1 0.5 31.5\nrs2 -0.25 1e1\n")
    _write(folder / "a_b_c_d_NK_x_y_z.res.gz", "rs1 0.75 2\n")
    _write(folder / "notes.md", "rs9 1 1\n")
    assert rows(files.read_gwas_results(spark, str(folder))) == [
        ("rs1", 0.5, 31.5, "CD4_naive"), ("rs1", 0.75, 2.0, "NK"), ("rs2", -0.25, 10.0, "CD4_naive")]


@pytest.mark.parametrize("name, phenotype", [("1_2_3_4_p_q_7_8_9.res", "p_q"), ("1_2_3_4_7_8_9.res", ""), ("1_2_3.res", "")])
def test_phenotype_part_of_file_names(spark, name, phenotype):
    assert spark.range(1).select(files.phenotype_from_filename(F.lit(name))).first()[0] == phenotype


def test_chromosome_from_path(spark):
    df = spark.createDataFrame([("/d/chr12.bgen",), ("/d/other.bgen",)], "p string")
    assert [r[0] for r in df.select(files.chromosome_from_path(F.col("p"))).collect()] == [12, None]


def test_alias_lines(spark, tmp_path):
    path = _write(tmp_path / "alias.csv", "p 1,Lineage A\np2\n\np3,B \n")
    assert rows(files.read_alias_map(spark, path)) == [("p1", "Lineage A"), ("p2", "Other"), ("p3", "B")]
    bad = _write(tmp_path / "bad.csv", "a,b,c\n")
    with pytest.raises(Exception, match="two entries"):
        files.read_alias_map(spark, bad).collect()


def test_value_list(spark, tmp_path):
    path = _write(tmp_path / "ids.txt", "rs1 \n\nrs2")
    assert rows(files.read_value_list(spark, path, "rsid")) == [("rs1",), ("rs2",)]


def test_annotation_and_peaks(spark, tmp_path):
    gtf = _write(tmp_path / "a.gtf", '##head\nchr1\tx\tgene\t5\t9\t.\t+\t.\tgene_id "E"; gene_type "t"; gene_name "G1";\n'
                                     'chr1\tx\texon\t5\t9\t.\t+\t.\tgene_name "G1";\n')
    assert rows(regions.gene_table(files.read_annotation(spark, gtf))) == [(1, 5, 9, "G1")]
    bed = _write(tmp_path / "p.bed.gz", "chrX\t10\t20\tS1.TF.bio\t7\t.\t14\t15\t0,0,0\n")
    assert rows(tf_binding.peak_table(files.read_peaks(spark, bed))) == [(23, 10, 20, "S1.TF.bio", 14, 15)]


def test_eqtl_directory_with_cell_type_from_name(spark, tmp_path):
    head = "Gene_name\tVariant_ID\tVariant_CHR\tVariant_position_start\tForward_nominal_P\tForward_slope\n"
    _write(tmp_path / "e" / "CD8_T_a_b_c.txt", head + "G1\trs1\tchr2\t77\t1e-9\t-0.5\n")
    _write(tmp_path / "e" / "NK_a_b_c.txt", head + "G2\trs1\tchr2\t77\t1e-5\t0.5\n")
    assert rows(files.read_eqtl_directory(spark, str(tmp_path / "e"))) == [
        ("rs1", "chr2", 77, "G1", 1e-9, -0.5, "CD8_T"), ("rs1", "chr2", 77, "G2", 1e-5, 0.5, "NK")]


def test_motif_table_has_fourteen_columns_or_fails(spark, tmp_path):
    row = "chr1:5G>T.1\tTFA\tm1\tdb\t0.5\t0.6\t-11\t3\t-13\t1\tminus\tplus\tgain\t0.02*\n"
    good = files.read_motif_effects(spark, _write(tmp_path / "m.tsv", row))
    assert good.columns == schemas.MOTIF_EFFECT.fieldNames()
    assert rows(good, "variant", "start_wt", "score") == [("chr1:5G>T.1", -11, "0.02*")]
    for text in (row.rstrip("\n") + "\textra\n", "a\tb\n"):
        with pytest.raises(Exception, match="14 columns"):
            files.read_motif_effects(spark, _write(tmp_path / "bad.tsv", text)).collect()


def test_motif_matrix_with_unnamed_first_column(spark, tmp_path):
    path = _write(tmp_path / "w.tsv", "\tchr1:5G>T.1\tchr2:7A>AT.2\nTFA\t0.0000*\t-0.3\nTFB\t\t0.1\n")
    assert rows(files.read_motif_matrix(spark, path), "TF", "variant", "score") == [
        ("TFA", "chr1:5G>T.1", "0.0000*"), ("TFA", "chr2:7A>AT.2", "-0.3"), ("TFB", "chr1:5G>T.1", None), ("TFB", "chr2:7A>AT.2", "0.1")]
    with pytest.raises(Exception, match="3 columns, found 2"):
        files.read_motif_matrix(spark, _write(tmp_path / "bad.tsv", "\ta\tb\nTFA\t1\n")).collect()
    with pytest.raises(ValueError, match="empty"):
        files.read_motif_matrix(spark, _write(tmp_path / "none.tsv", ""))


@pytest.mark.parametrize("columns", [1, 4_096, 4_097, 9_000])
def test_motif_matrix_names_are_not_broadcast_on_a_guess(spark, tmp_path, monkeypatch, columns):
    text = "\t".join(["", *(f"v{i}" for i in range(columns))]) + "\n" + "\t".join(["TFA", *(f"{i}" for i in range(columns))]) + "\n"
    path = _write(tmp_path / "wide.tsv", text)
    want = sorted((f"v{i}", "TFA", f"{i}") for i in range(columns))
    assert rows(files.read_motif_matrix(spark, path)) == want
    monkeypatch.setattr(files, "fits_broadcast", lambda *a, **k: False)
    cells = files.read_motif_matrix(spark, path)
    assert rows(cells) == want
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_lines_meet_the_header_of_their_matrix(spark):
    header = spark.createDataFrame([(1, "\ta\tb"), (2, "\tc")], "m int, value string")
    lines = spark.createDataFrame([(1, "T\t1\t2"), (2, "T\t3"), (2, "U\t")], "m int, value string")
    assert rows(files.motif_matrix_cells(header, lines, "m")) == [
        ("a", "T", "1"), ("b", "T", "2"), ("c", "T", "3"), ("c", "U", None)]
    odd = spark.createDataFrame([(2, "U\t1\t2")], "m int, value string")
    with pytest.raises(Exception, match="2 columns, found 3"):
        files.motif_matrix_cells(header, odd, "m").collect()


def test_no_header_line_grows_with_the_variants(spark, monkeypatch):
    seen = {}

    def spy(header, lines, matrix=None):
        seen["widths"] = [len(r.value.split("\t")) - 1 for r in header.select("value").collect()]
        return files.motif_matrix_cells(header, lines, matrix)

    monkeypatch.setattr(catalog, "MATRIX_VARIANTS", 20)
    monkeypatch.setattr(catalog, "motif_matrix_cells", spy)
    tables = Tables(spark, "/root/testdata/sf0.001")
    cells = catalog._matrix_cells(tables)
    variants = tables.matrix_cells.select("variant").distinct().count()
    assert sum(seen["widths"]) == variants and max(seen["widths"]) < 60 < variants
    assert cells.count() == variants * catalog.FACTORS
    assert rows(cells.filter("score IS NOT NULL"), "TF", "variant", "score") == rows(tables.matrix_cells, "TF", "variant", "score")


def test_motif_matrix_of_many_variants_has_a_small_plan(spark, tmp_path):
    variants = [f"chr{1 + i % 22}:{i}G>T.{i % 3 + 1}" for i in range(20_000)]
    lines = ["\t".join(["", *variants])]
    lines += ["\t".join([f"TF{f}", *(f"{((i * 7 + f) % 19 - 9) / 10}" for i in range(len(variants)))]) for f in range(6)]
    cells = files.read_motif_matrix(spark, _write(tmp_path / "wide.tsv", "\n".join(lines) + "\n"))
    key_map = tf_binding.variant_key_map(spark.createDataFrame(
        [(f"v{i}", f"chr{1 + i % 22}", i, "G", "T") for i in range(0, 20_000, 2)], "ID string, Chrom string, Pos bigint, OA string, EA string"))
    effects = tf_binding.motif_matrix_effects(cells, key_map, 0.5)
    assert effects.count() == sum(abs((i * 7 + f) % 19 - 9) >= 5 for i in range(0, 20_000, 2) for f in range(6))
    assert cells.count() == 120_000
    assert len(effects._jdf.queryExecution().optimizedPlan().toString()) < 5_000


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4, 5], [5, 3, 1, 0, 2, 4]])
def test_tables_with_columns_in_another_order_give_equal_rows(spark, tmp_path, order):
    names = ["Variant_ID", "Variant_CHR", "Variant_position_start", "Gene_name", "Forward_nominal_P", "Forward_slope"]
    row = ["rs1", "chr2", "77", "G1", "1e-9", "-0.5"]
    first = "\t".join(names) + "\n" + "\t".join(row) + "\n"
    picked = ["Extra", *[names[i] for i in order]], ["x", *[row[i] for i in order]]
    _write(tmp_path / "e" / "CD8, memory_a_b_c.txt", first)
    _write(tmp_path / "e" / "NK_a_b_c.txt", "".join("\t".join(p) + "\n" for p in picked))
    _write(tmp_path / "e" / "B_a_b_c.txt", "\t".join(names) + "\n")
    want = ("rs1", "chr2", 77, "G1", 1e-9, -0.5)
    assert rows(files.read_eqtl_directory(spark, str(tmp_path / "e"))) == [(*want, "CD8, memory"), (*want, "NK")]


def test_hit_tables_are_read_by_column_name(spark, tmp_path):
    columns = schemas.SUMSTATS_COLUMNS
    values = dict(zip(columns, ["rs1", "0.5", "40", "1e-9", "chr1:5", "1", "5", "A", "G", "0.1", "0.9", "t"]))
    for name, order in (("a.tsv", columns), ("b.txt", columns[::-1])):
        _write(tmp_path / "h" / name, "\t".join(order) + "\n" + "\t".join(values[c] for c in order) + "\n")
    got = rows(files.read_sumstats(spark, str(tmp_path / "h")))
    assert got == [("rs1", 0.5, 40.0, 1e-9, "chr1:5", 1, 5, "A", "G", 0.1, 0.9, "t")] * 2
    _write(tmp_path / "h" / "c.txt", "\t".join(columns[:-1]) + "\n")
    with pytest.raises(ValueError, match="c.txt lacks column.*phenotype"):
        files.read_sumstats(spark, str(tmp_path / "h"))
    with pytest.raises(ValueError, match="holds no"):
        (tmp_path / "none").mkdir()
        files.read_sumstats(spark, str(tmp_path / "none"))


def test_peak_hits_take_their_position_from_the_name(spark, tmp_path):
    head = "study_accession\ttranscription_factor\tbiotype\tdistance_to_peak\n"
    _write(tmp_path / "h" / "peaks_at_1:500.txt", head + "S1\tTF\tbio\t61\nS2\tTF\tbio\t77\n")
    _write(tmp_path / "h" / "peaks_at_X:9.txt", head)
    assert rows(files.read_peak_hits(spark, str(tmp_path / "h"))) == [
        (1, 500, "S1", "TF", "bio", 61), (1, 500, "S2", "TF", "bio", 77)]


def test_sample_tables(spark, tmp_path):
    samples = files.read_samples(spark, _write(tmp_path / "s.sample", "ID_1 ID_2 missing sex\n0 0 0 D\ns1 s1 0 1\n"))
    assert rows(samples, "sample_id", "sex") == [("s1", "1")]
    pheno = files.read_sample_values(spark, _write(tmp_path / "p.tsv", "Sample_ID\tA b\ty\ns1\t1.5\t\ns2\t\t2\n"))
    assert rows(pheno, "sample_id", "A b", "y") == [("s1", 1.5, None), ("s2", None, 2.0)]
    with pytest.raises(ValueError, match="Sample_ID"):
        files.read_sample_values(spark, _write(tmp_path / "q.tsv", "x\ty\n1\t2\n"))
    with pytest.raises(ValueError, match="columns"):
        files.read_sample_values(spark, _write(tmp_path / "r.tsv", "Sample_ID\tsex\tz\n"), "sex covariate", width=2)


def _sumstats(spark):
    data = [(f"rs{i}", 0.1, 30.0 + i, 1e-9, f"chr{1 + i % 2}:{90 - i}", 1 + i % 2, 90 - i, "A", "G", 0.1, 0.9,
             "CD4/CD8: ratio." if i % 3 else "b") for i in range(30)]
    return spark.createDataFrame(data, schemas.SUMSTATS)


def test_hits_round_trip_by_phenotype(spark, tmp_path):
    table, path = _sumstats(spark), str(tmp_path / "out")
    sinks.write_by_phenotype(table, path)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["phenotype_name=CD4CD8ratio", "phenotype_name=b"]
    back = spark.read.schema(schemas.SUMSTATS).option("sep", "\t").option("header", True).csv(path + "/phenotype_name=b")
    assert rows(back) == rows(table.filter("phenotype = 'b'"))


def test_sumstats_directory_skips_header_only_files(spark, tmp_path):
    head = "\t".join(schemas.SUMSTATS_COLUMNS) + "\n"
    _write(tmp_path / "d" / "a.txt", head)
    _write(tmp_path / "d" / "b.tsv", head + "rs1\t0.1\t30.5\t1e-9\tchr1:5\t1\t5\tA\tG\t0.1\t0.9\tb\n")
    _write(tmp_path / "d" / "c.log", "x\n")
    assert rows(files.read_sumstats(spark, str(tmp_path / "d")), "ID", "position", "phenotype") == [("rs1", 5, "b")]


def test_regions_and_members_round_trip(spark, tmp_path):
    table = regions.hit_regions(_sumstats(spark), window_buffer=3)
    sinks.write_regions(table, str(tmp_path / "regions"))
    back = files.read_regions(spark, str(tmp_path / "regions"))
    assert rows(back) == rows(table)
    sinks.write_by_region(regions.region_hits(back, _sumstats(spark)), str(tmp_path / "members"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "members")).count() == 30


def test_vcf_chunks_are_single_sorted_files(spark, tmp_path):
    variants = spark.createDataFrame([(f"v{i}", "chr1", 500 - i, "A", "C") for i in range(25)], schemas.VARIANT_LIST)
    sinks.write_vcf_chunks(tf_binding.vcf_projection(variants, 10), str(tmp_path / "vcf"))
    for chunk, size in ((1, 10), (2, 10), (3, 5)):
        [part] = (tmp_path / "vcf" / f"chunk={chunk}").glob("*.csv")
        lines = part.read_text().splitlines()
        assert lines[0].split("\t") == tf_binding.VCF_COLUMNS
        positions = [int(line.split("\t")[1]) for line in lines[1:]]
        assert len(positions) == size and positions == sorted(positions)


def test_landed_results_prune_by_phenotype(spark, tmp_path):
    results = _sumstats(spark).select("ID", "beta", "chi2", "phenotype")
    sinks.land_results(results, str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    info = _sumstats(spark).select("ID", "Marker", "OA", "EA", "EAF", "Info").distinct()
    one = hits.full_sumstats(landed, info, "b")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(phenotype" in plan
    assert one.count() == 10


def test_landed_tables_join_without_an_exchange(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    table = _sumstats(spark)
    results = table.select("ID", "beta", "chi2", "phenotype")
    info = table.select("ID", "Marker", "OA", "EA", "EAF", "Info").dropDuplicates(["ID"])
    for _ in range(2):  # landed again over what is there
        landed = sinks.land_results(results, str(tmp_path / "results"), 4, "overwrite")
        known = sinks.land_variant_info(info, str(tmp_path / "info"), 4, "overwrite")
    joined = hits.full_sumstats(landed, known, "b")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "PartitionFilters: [isnotnull(phenotype" in plan
    shared = ["ID", "chi2", "Marker", "position", "EAF", "phenotype"]
    assert rows(joined, *shared) == rows(table.filter("phenotype = 'b'"), *shared)
    assert rows(landed.select(*results.columns)) == rows(results)
    with pytest.raises(Exception, match="exist|empty"):
        sinks.land_results(results, str(tmp_path / "results"), 4)


def test_hot_bucket_is_landed_by_many_tasks(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20000")
    n = F.col("id")
    results = spark.range(0, 60_000, 1, 8).select(
        F.when(n % 3 > 0, "hot").otherwise(F.concat(F.lit("rs"), n)).alias("ID"), (n * 0.5).alias("beta"), n.cast("double").alias("chi2"),
        F.lit("t").alias("phenotype"))
    landed = sinks.land_results(results, str(tmp_path / "hot"), 4)
    assert landed.count() == 60_000 and landed.filter("ID = 'hot'").count() == 40_000
    assert landed.filter("ID = 'hot'").select(F.input_file_name().alias("f")).distinct().count() > 4


def test_safe_names(spark):
    df = spark.createDataFrame([(' a<b>c:"d"/e\\f|g?h*i. ',), (".x.",)], "n string")
    assert [r[0] for r in df.select(sinks.safe_name(F.col("n"))).collect()] == ["abcdefghi", "x"]
