"""The analyses end to end, from written files to written files."""

import numpy as np
import pytest

from conftest import rows
from locusweave.plans import workflows


def _write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join("\t".join(str(v) for v in line) for line in lines) + "\n")
    return str(path)


def _read(spark, path):
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def test_gwas_post_processing(spark, tmp_path):
    info = _write(tmp_path / "vi.txt", [
        ("ID", "Marker", "OA", "EA", "EAF", "Info"), ("rs1", "chr1:1000", "A", "G", 0.1, 0.9),
        ("rs2", "chr1:1500", "C", "G", 0.1, 0.9), ("rs3", "chrX:900", "T", "G", 0.1, 0.9)])
    for trait, lines in {"p_one": [("rs1", 0.1, 40), ("rs2", 0.1, 50), ("rs3", 0.1, 2)],
                         "two": [("rs1", 0.2, 60), ("rs3", 0.2, 31), ("rs8", 0.2, 33)]}.items():
        path = tmp_path / "res" / f"a_b_c_d_{trait}_x_y_z.res"
        path.parent.mkdir(exist_ok=True)
        path.write_text("".join(f"{i} {b} {c}\n" for i, b, c in lines))
    gtf = _write(tmp_path / "genes.gtf", [
        ("chr1", "x", "gene", 1600, 2000, ".", "+", ".", 'gene_id "E1"; gene_name "NEAR";'),
        ("chrX", "x", "gene", 5_000_000, 5_000_100, ".", "+", ".", 'gene_id "E2"; gene_name "FAR";')])
    alias = tmp_path / "alias.csv"
    alias.write_text("p_one,Lineage 1\n")

    out = workflows.post_process_gwas(
        spark, info, str(tmp_path / "res"), str(tmp_path / "out"), "run", 6, 300, aliases=str(alias), annotation=gtf)
    assert out["hits_table"].endswith("run_hits_only_10E6_one_pheno_only_per_variant")
    assert rows(_read(spark, out["hits_table"]), "ID", "phenotype") == [("rs1", "two"), ("rs2", "p_one"), ("rs3", "two"), ("rs8", "two")]
    assert rows(_read(spark, out["unmatched"])) == [("two", "1")]
    assert rows(spark.read.parquet(out["combined"]), "ID", "phenotype", "alias") == [
        ("rs1", "p_one", "<no data>"), ("rs1", "two", "<no data>"), ("rs2", "p_one", "<no data>"),
        ("rs3", "p_one", "<no data>"), ("rs3", "two", "<no data>"), ("rs8", "two", "<no data>")]
    assert rows(_read(spark, out["regions"]), "chrom", "chromStart", "leadSnp_pos", "leadSnp_closest_gene", "phenotypes") == [
        ("1", "700", "1000", "NEAR", "p_one,two"), ("23", "600", "900", "NA", "two")]
    assert rows(_read(spark, out["members"]), "region", "position", "position2", "phenotype") == [
        ("region_1_chr1:700-1800", "1000", "1000", "p_one"), ("region_1_chr1:700-1800", "1000", "1000", "two"),
        ("region_1_chr1:700-1800", "1500", "1500", "p_one"), ("region_2_chr23:600-1200", "900", "900", "two")]
    store = workflows.land_references(spark, str(tmp_path / "store"), annotation=gtf)["genes"]
    pruned = workflows.post_process_gwas(
        spark, info, str(tmp_path / "res"), str(tmp_path / "out2"), "run", 6, 300, aliases=str(alias), annotation=store, landed_genes=True)
    assert rows(_read(spark, pruned["regions"])) == rows(_read(spark, out["regions"]))
    assert _read(spark, out["points"]).filter("x IS NOT NULL").count() == 5
    assert _read(spark, out["unparsed"]).count() == 0


def test_malformed_rows_fail_or_are_reported(spark, tmp_path):
    info = _write(tmp_path / "vi.txt", [
        ("ID", "Marker", "OA", "EA", "EAF", "Info"), ("rs1", "chrY:1000", "A", "G", 0.1, 0.9), ("rs2", "chr1-7", "A", "G", 0.1, 0.9)])
    for trait, text in {"IL2, free": "rs1 0.1 40\nrs3 bad\nrs4 0.1 50 9\n", "b": "rs2 0.1 60\n"}.items():
        path = tmp_path / "res" / f"a_b_c_d_{trait}_x_y_z.res"
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    args = (spark, info, str(tmp_path / "res"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED|malformed"):
        workflows.post_process_gwas(*args, str(tmp_path / "strict"), "run", 6, 300)
    out = workflows.post_process_gwas(*args, str(tmp_path / "out"), "run", 6, 300, strict=False)
    assert rows(_read(spark, out["malformed"])) == [("IL2, free", "2")]
    assert rows(_read(spark, out["unparsed"])) == [("b", "1")]
    assert rows(_read(spark, out["members"]), "chromosome", "phenotype") == [("24", "IL2, free")]


def test_reports_without_rows_read_nothing(spark, tmp_path, monkeypatch):
    from locusweave.operators import quality
    from locusweave.sources import sinks

    info = _write(tmp_path / "vi.txt", [("ID", "Marker", "OA", "EA", "EAF", "Info")] + [(f"rs{i}", f"chr1:{i + 1}", "A", "G", 0.1, 0.9) for i in range(50)])
    path = tmp_path / "res" / "a_b_c_d_t_x_y_z.res"
    path.parent.mkdir()
    path.write_text("".join(f"rs{i} 0.1 {30 + i}\n" for i in range(50)))
    watched, written = [], {}
    watch, write = quality.watch, sinks.write_tsv
    monkeypatch.setattr(quality, "watch", lambda *a, **k: watched.append(watch(*a, **k)) or watched[-1])
    monkeypatch.setattr(sinks, "write_tsv", lambda df, path, *a: written.update({path: df}) or write(df, path, *a))
    out = workflows.post_process_gwas(spark, info, str(tmp_path / "res"), str(tmp_path / "out"), "run", 6, 300, strict=False)
    # Every row is counted once, in the pass that writes it.
    assert [seen.get for _, seen in watched] == [{"num_malformed": 0}, {"num_unmatched": 0, "num_unparsed": 0}]
    for name in ("malformed", "unmatched", "unparsed"):
        assert "FileScan" not in written[out[name]]._jdf.queryExecution().executedPlan().toString()
        assert _read(spark, out[name]).count() == 0
    assert len(rows(spark.read.parquet(out["hits"]))) == 50


def test_empty_inputs_fail(spark, tmp_path):
    lines = [("ID", "Marker", "OA", "EA", "EAF", "Info"), ("rs1", "chr1:1000", "A", "G", 0.1, 0.9)]
    path = tmp_path / "res" / "a_b_c_d_t_x_y_z.res"
    path.parent.mkdir()
    path.write_text("")
    full, bare = _write(tmp_path / "vi.txt", lines), _write(tmp_path / "bare.txt", lines[:1])
    with pytest.raises(ValueError, match="result directory holds no rows"):
        workflows.post_process_gwas(spark, full, str(tmp_path / "res"), str(tmp_path / "a"), "run")
    path.write_text("rs1 0.1 40\n")
    with pytest.raises(ValueError, match="variant info holds no rows"):
        workflows.post_process_gwas(spark, bare, str(tmp_path / "res"), str(tmp_path / "b"), "run")
    path.write_text("rs1 0.1 2\n")  # no hits is a result
    out = workflows.post_process_gwas(spark, full, str(tmp_path / "res"), str(tmp_path / "c"), "run")
    assert _read(spark, out["hits_table"]).count() == _read(spark, out["unmatched"]).count() == 0


def test_sinks_compute_their_rows_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from locusweave.sources import sinks

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        seen.add(1)
        return n

    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 3).cast("string").alias("phenotype"), (F.col("id") % 5).alias("chromosome"), counted("id").alias("position"))
    sinks.write_partitioned(df, str(tmp_path / "a"), "phenotype", ["chromosome", "position"])
    assert seen.value == 4000
    sinks.write_tsv(df, str(tmp_path / "b"), order=["chromosome", "position"])
    assert seen.value == 8000
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4000


def test_eqtl_lookup(spark, tmp_path):
    head = ("Variant_ID", "Variant_CHR", "Variant_position_start", "Gene_name", "Forward_nominal_P", "Forward_slope")
    _write(tmp_path / "e" / "CD8_T_a_b_c.txt", [head, ("rs1", "chr10", 5, "G1", 1e-9, 0.5), ("rs2", "chr2", 7, "G2", 1e-8, 0.1)])
    _write(tmp_path / "e" / "NK_a_b_c.txt", [head, ("rs1", "chr10", 5, "G0", 1e-9, 0.5), ("rs7", "chr2", 7, "G2", 1e-8, 0.1)])
    ids = tmp_path / "ids.txt"
    ids.write_text("rs1\nrs2")
    out = workflows.look_up_eqtls(spark, str(tmp_path / "e"), str(ids), str(tmp_path / "out"))
    assert [tuple(r) for r in _read(spark, out).select("rsid", "gene", "cell_type").collect()] == [
        ("rs2", "G2", "CD8_T"), ("rs1", "G0", "NK"), ("rs1", "G1", "CD8_T")]


def test_candidate_genes(spark, tmp_path):
    variants = _write(tmp_path / "v.tsv", [
        ("ID", "beta", "chi2", "pval", "Marker", "chromosome", "position", "OA", "EA", "EAF", "Info", "phenotype"),
        ("rs1", 0.1, 40, 1e-9, "chr1:5", 1, 5, "A", "G", 0.1, 0.9, "t"), ("rs2", 0.1, 40, 1e-9, "chr23:6", 23, 6, "C", "T", 0.1, 0.9, "t")])
    a = _write(tmp_path / "a.tsv", [tuple(workflows.COLLECTION_A), ("chr1", 5, "A", "G", 5, "GA", 1e-4, "T"), ("chrX", 6, "C", "T", 6, "GX", 1e-5, "B")])
    b = _write(tmp_path / "b.tsv", [tuple(workflows.COLLECTION_B), ("chrX", 6, "C", "T", "HB", "lung"), ("chr1", 5, "G", "A", "HB", "lung")])
    out = workflows.find_candidate_genes(spark, variants, a, b, str(tmp_path / "out"))
    both = _read(spark, out["both"])
    assert both.columns == ["#Chrom", "Pos", "Variant_position_end", *workflows.GENOMIC_COLUMNS, "gene_a", "pval_a",
                            "celltype_a", "gene_b", "celltype_b"]
    assert rows(both, "#Chrom", "Pos", "gene_a", "gene_b") == [("chrX", "6", "GX", "HB")]
    assert rows(_read(spark, out["ranking"]), "gene", "gene_rank") == [("GA", "1"), ("GX", "1")]


def test_bound_factors(spark, tmp_path):
    variants = _write(tmp_path / "v.tsv", [("ID", "Chrom", "Pos", "OA", "EA"), ("v1", "chr1", 500, "G", "T"), ("v2", "chr2", 7, "A", "AT")])
    prepared = workflows.prepare_motif_input(spark, variants, str(tmp_path / "in"), 1)
    assert sorted(p.name for p in (tmp_path / "in" / "vcf").glob("chunk=*")) == ["chunk=1", "chunk=2"]
    assert rows(_read(spark, prepared["key_map"]), "Chrom:PosOA>EA") == [("chr1:500G>T",), ("chr2:7A>AT",)]
    peaks = _write(tmp_path / "p.bed", [("chr1", 490, 510, "S1.TFA.K-562", 1, ".", 495, 496, "0,0,0"), ("chr1", 490, 510, "S2.TFB.HEK", 1, ".", 400, 401, "0")])
    effects = _write(tmp_path / "e.tsv", [("chr1:500G>T.1", t, "m", "db", 0.1, 0.2, 1, 2, 3, 4, "plus", "plus", "gain", s) for t, s in (("TFA", "0.4*"), ("TFB", "0.1"), ("TFC", "0.9"))])
    matrix = _write(tmp_path / "m.tsv", [("", "chr1:500G>T.1"), ("TFA", "0.1"), ("TFB", "-0.3")])
    biotypes = tmp_path / "b.txt"
    biotypes.write_text("HEK")
    out = workflows.find_bound_factors(spark, variants, peaks, effects, str(tmp_path / "out"), matrix, str(biotypes))
    assert rows(_read(spark, out["peaks"]), "transcription_factor", "distance_to_peak") == [("TFA", "5"), ("TFB", "100")]
    assert rows(_read(spark, out["peaks_filtered"]), "transcription_factor") == [("TFB",)]
    assert rows(_read(spark, out["factors"])) == [("v1", "1", "500", "G", "T", "TFA", "0.4", "gain")]
    store = workflows.land_references(spark, str(tmp_path / "store"), peaks=peaks)["peaks"]
    pruned = workflows.find_bound_factors(spark, variants, store, effects, str(tmp_path / "out3"), landed_peaks=True)
    for name in ("peaks", "factors"):
        assert rows(_read(spark, pruned[name])) == rows(_read(spark, out[name]))
    averaged = workflows.find_bound_factors(
        spark, variants, peaks, effects, str(tmp_path / "out2"), matrix, from_matrix=True)
    assert rows(_read(spark, averaged["factors"]), "transcription_factor", "effect") == [("TFB", "loss")]


def test_gwas_from_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    calls = rng.integers(0, 3, (6, 40))
    spark.createDataFrame(
        [(f"v{i}", f"s{s}", int(calls[i][s])) for i in range(6) for s in range(40)], "ID string, sample_id string, n_alt int"
    ).write.parquet(str(tmp_path / "geno"))
    spark.createDataFrame(
        [(f"v{i}", 1, 10 * i, "A", "G") for i in range(6)], "ID string, chromosome int, position bigint, OA string, EA string"
    ).write.parquet(str(tmp_path / "variants"))
    samples = tmp_path / "c.sample"
    samples.write_text("ID_1 ID_2 missing sex\n0 0 0 D\n" + "".join(f"s{s} s{s} 0 1\n" for s in range(40)))
    pheno = _write(tmp_path / "p.tsv", [("Sample_ID", "height", "weight")] + [(f"s{s}", calls[1][s] + rng.normal(0, 0.1), rng.normal()) for s in range(40)])
    sex = _write(tmp_path / "sex.tsv", [("Sample_ID", "sex")] + [(f"s{s}", s % 2) for s in range(40)])
    axes = _write(tmp_path / "pca.tsv", [("Sample_ID", "PC1", "PC2")] + [(f"s{s}", rng.normal(), rng.normal()) for s in range(40)])
    out = workflows.run_gwas(spark, str(tmp_path / "geno"), str(tmp_path / "variants"), str(samples), pheno, str(tmp_path / "out"), sex, axes, min_p_hwe=1e-12)
    table = spark.read.parquet(out["results"])
    assert table.count() == 12 and set(table.columns) >= {"rsid", "chromosome", "position", "OA", "EA", "EAF", "pval", "beta", "tstat", "n"}
    best = table.filter("phenotype = 'height'").orderBy("pval").first()
    assert best.rsid == "v1" and best.beta == pytest.approx(1, abs=0.1) and best.n == 40 and best.pval < 1e-20
    assert {r.phenotype for r in _read(spark, out["inflation"]).collect()} == {"height", "weight"}
    stranger = _write(tmp_path / "other.tsv", [("Sample_ID", "y"), ("nobody", 1.0)])
    with pytest.raises(ValueError, match="shared"):
        workflows.run_gwas(spark, str(tmp_path / "geno"), str(tmp_path / "variants"), str(samples), stranger, str(tmp_path / "o3"))
