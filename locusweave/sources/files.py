"""File sources: explicit schemas, whole directories in one read, file names as columns."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusweave import schemas
from locusweave.functions.loci import chrom_number
from locusweave.functions.traits import decode_traits
from locusweave.operators.hits import OTHER_ALIAS
from locusweave.session import fits_broadcast

PIECE_CELLS = 4_096  # cells of a motif matrix line that are handled as one row
HEADER_BYTES = 32 * 1024 * 1024  # names of a motif matrix that may pass through the driver


def _name_parts(file_name: Column, skip: int, drop: int) -> Column:
    parts = F.split(file_name, "_")
    return F.array_join(F.slice(parts, F.lit(skip + 1), F.greatest(F.lit(0), F.size(parts) - skip - drop)), "_")


def phenotype_from_filename(file_name: Column) -> Column:
    """Phenotype of a result file: the name without its first four and last three ``_`` parts."""
    return _name_parts(file_name, 4, 3)


def cell_type_from_filename(file_name: Column) -> Column:
    """Cell type of an eQTL file: the name without its last three ``_`` parts."""
    return _name_parts(file_name, 0, 3)


def chromosome_from_path(path: Column) -> Column:
    """Chromosome number in ``...chr<n>.bgen``-style paths, null without one."""
    return F.regexp_extract(path, r"chr(\d+)\.", 1).try_cast("int")


def _csv(spark: SparkSession, schema: T.StructType, header: bool, sep: str = "\t", glob: str | None = None, **options):
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", "")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**options)


def _file_name() -> Column:
    return F.url_decode(F.col("_metadata.file_name"))


def header_columns(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names of a delimited file, from its first line only."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return first[0].split(sep)


def read_header_table(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", what: str = "input",
    header_from: str | None = None,
) -> DataFrame:
    """Columns of ``schema`` by name from a file with a header that may hold more of them.

    All columns are read as text and only the wanted ones cast, so column order
    and extra columns do not matter and the reader prunes what is not used.
    """
    names = header_columns(spark, header_from or path, sep)
    absent = [c for c in schema.fieldNames() if c not in names]
    if absent:
        raise ValueError(f"{what} lacks column(s) {', '.join(absent)}; it has {', '.join(names)}")
    text = T.StructType([T.StructField(n or "TF", T.StringType()) for n in names])
    rows = _csv(spark, text, True, sep, enforceSchema="true").csv(path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_variant_info(spark: SparkSession, path: str) -> DataFrame:
    return read_header_table(spark, path, schemas.VARIANT_INFO, what="variant info")


def read_gwas_results(spark: SparkSession, directory: str, strict: bool = True) -> DataFrame:
    """All headerless result files (plain or gzipped) of a directory, phenotype from the file name.

    A row without exactly an ID and two numbers fails the job. With ``strict``
    off it gives nulls, and ``is_malformed`` marks it.
    """
    named = phenotype_from_filename(_file_name()).alias("phenotype")
    if strict:
        return _csv(spark, schemas.GWAS_RESULT, False, " ", "*.res*", mode="FAILFAST").csv(directory).select("*", named)
    schema = T.StructType([*schemas.GWAS_RESULT.fields, T.StructField("_line", T.StringType())])
    rows = _csv(spark, schema, False, " ", "*.res*", mode="PERMISSIVE", columnNameOfCorruptRecord="_line").csv(directory)
    broken = F.col("_line").isNotNull() | F.col("beta").isNull() | F.col("chi2").isNull()
    return rows.select(*schemas.GWAS_RESULT.fieldNames(), named, broken.alias("is_malformed"))


def result_phenotypes(spark: SparkSession, directory: str) -> list[str]:
    """Phenotypes of a result directory in alphabetical order, from the names of its files alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.res*").load(directory).select(
        phenotype_from_filename(F.url_decode(F.element_at(F.split("path", "/"), -1))).alias("phenotype"))
    return [r.phenotype for r in listed.distinct().orderBy("phenotype").collect()]


def _tables_by_header(spark: SparkSession, directory: str, glob: str, what: str, wanted: list[str]) -> DataFrame:
    """Text columns ``wanted`` and ``_metadata`` of all tables of a directory, whatever the order of their columns.

    Only the first line of each file is looked at here. Files with the same header
    are one read, so the plan has a branch per distinct header.
    """
    files = [unquote(f) for f in spark.read.option("pathGlobFilter", glob).text(directory).inputFiles()]
    if not files:
        raise ValueError(f"{directory} holds no {what}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(files):
        names = tuple(header_columns(spark, file))
        absent = [c for c in wanted if c not in names]
        if absent:
            raise ValueError(f"{what} {file} lacks column(s) {', '.join(absent)}")
        by_header.setdefault(names, []).append(file)
    tables = []
    for names, paths in by_header.items():
        rows = _csv(spark, T.StructType([T.StructField(n, T.StringType()) for n in names]), True, enforceSchema="true").csv(paths)
        tables.append(rows.select(*[F.col(f"`{c}`") for c in wanted], _file_name().alias("file_name")))
    return reduce(DataFrame.unionByName, tables)


def read_sumstats(spark: SparkSession, directory: str) -> DataFrame:
    """All 12-column hit tables (``.txt``, ``.tsv``) of a directory, columns by name; header-only files add no rows."""
    rows = _tables_by_header(spark, directory, "*.{txt,tsv}", "hit table", schemas.SUMSTATS_COLUMNS)
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.SUMSTATS.fields])


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region table with its trait lists as arrays."""
    return _csv(spark, schemas.REGION, True).csv(path).withColumn("phenotypes", decode_traits(F.col("phenotypes")))


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """``phenotype,alias`` lines; a lone phenotype gets the catch-all alias, more than two fields fail the read."""
    fields = F.split("value", ",")
    checked = F.when(F.size(fields) > 2, F.raise_error(F.lit("alias lines may have two entries at most"))).otherwise(
        F.replace(fields[0], F.lit(" "), F.lit("")))
    alias = F.when(F.size(fields) == 2, F.rtrim(F.get(fields, F.lit(1)))).otherwise(OTHER_ALIAS)
    return (
        spark.read.text(path).filter(F.trim("value") != "")
        .select(checked.alias("phenotype"), alias.alias("alias"))
    )


def read_value_list(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One trimmed value per line, empty lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias(name)).filter(F.col(name) != "")


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """GTF rows; comment lines are skipped."""
    return _csv(spark, schemas.ANNOTATION, False, comment="#").csv(path)


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, schemas.PEAK, False).csv(path)


def read_variant_list(spark: SparkSession, path: str) -> DataFrame:
    return read_header_table(spark, path, schemas.VARIANT_LIST, what="variant list")


def read_eqtl_directory(spark: SparkSession, directory: str, columns: dict[str, str] | None = None) -> DataFrame:
    """All eQTL tables of a directory as ``rsid, chromosome, position_hg38, gene, pval, slope, cell_type``.

    ``columns`` maps source names to these. Columns are found by name in each file,
    so files may have them in any order and among others.
    """
    columns = columns or {
        "Variant_ID": "rsid", "Variant_CHR": "chromosome", "Variant_position_start": "position_hg38",
        "Gene_name": "gene", "Forward_nominal_P": "pval", "Forward_slope": "slope",
    }
    kinds = {"position_hg38": T.LongType(), "pval": T.DoubleType(), "slope": T.DoubleType()}
    rows = _tables_by_header(spark, directory, "*.txt", "eQTL table", list(columns))
    return rows.select(
        *[F.col(f"`{old}`").try_cast(kinds.get(new, T.StringType())).alias(new) for old, new in columns.items()],
        cell_type_from_filename(F.col("file_name")).alias("cell_type"))


def read_motif_effects(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 14-column motif table; a row of any other width fails the read.

    Every line is split as text first, because a reader with a fixed schema pads
    short rows and cuts long ones without a word.
    """
    width = len(schemas.MOTIF_EFFECT)
    fields = F.split("value", "\t")
    checked = F.when(F.size(fields) == width, fields).otherwise(
        F.raise_error(F.concat(F.lit(f"motif tables should have {width} columns, found "), F.size(fields))))
    rows = spark.read.text(path).select(checked.alias("fields"))
    return rows.select(*[
        F.col("fields")[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schemas.MOTIF_EFFECT.fields)
    ])


def _cell_pieces(fields: str) -> Column:
    """All but the first of a line's fields as arrays of ``PIECE_CELLS``, one array at least."""
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(fields) - 2) / PIECE_CELLS).cast("int")))
    return F.transform(pieces, lambda k: F.slice(fields, k * PIECE_CELLS + 2, PIECE_CELLS))


def motif_matrix_cells(header: DataFrame, lines: DataFrame, matrix: str | None = None) -> DataFrame:
    """``variant, TF, score`` of a matrix given as text: one header line and one line per factor, in column ``value``.

    With ``matrix``, a column of both, there are many matrices, each with its header.
    Lines are cut into pieces of ``PIECE_CELLS`` cells, which get their variants from
    the same piece of the header by a join before they are taken apart, so the plan is the
    same for any number of variants and what is shuffled is a row per piece. The
    pieces of the headers are broadcast by their measured size or merged, never
    broadcast because the planner takes a header for one short row. An empty cell
    is null; a line of another width than the header fails the read.
    """
    of = [matrix] if matrix else []
    fields = F.split("value", "\t")
    names = (
        header.select(*of, fields.alias("_fields"))
        .select(*of, F.size("_fields").alias("_width"), F.posexplode_outer(_cell_pieces("_fields")).alias("_piece", "variant"))
    )
    text_bytes = F.octet_length(F.array_join("variant", "")) + 16 * F.size("variant")
    names = F.broadcast(names) if fits_broadcast(names, HEADER_BYTES, text_bytes) else names.hint("merge")
    cells = (
        lines.select(*of, fields.alias("_fields"))
        .select(*of, F.col("_fields")[0].alias("TF"), F.size("_fields").alias("_found"),
                F.posexplode_outer(_cell_pieces("_fields")).alias("_piece", "score"))
    )
    checked = F.when(F.col("_found") == F.col("_width"), F.arrays_zip("variant", "score")).otherwise(
        F.raise_error(F.concat(F.lit("motif matrix should have "), "_width", F.lit(" columns, found "), "_found")))
    return (
        cells.join(names, [*of, "_piece"]).select("TF", F.inline(checked))
        .select("variant", "TF", F.nullif("score", F.lit("")).alias("score"))
    )


def read_motif_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Cells ``variant, TF, score`` of a motif matrix with a column per variant; its first column is unnamed."""
    text = spark.read.text(path)
    header = text.limit(1)
    first = header.select(F.xxhash64("value").alias("mark")).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return motif_matrix_cells(header, text.filter(F.xxhash64("value") != first.mark).filter("value != ''"))


def read_peak_hits(spark: SparkSession, directory: str) -> DataFrame:
    """Per-position peak tables ``<prefix>_<chr>:<pos>.txt`` with the position taken from the file name.

    The checksum layer over local files cannot open names with a colon, so local
    paths are read without it; other file systems ignore the two options.
    """
    raw_local = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    rows = _csv(spark, schemas.PEAK_HIT, True, glob="*.txt", **raw_local).csv(directory)
    locus = F.regexp_extract(_file_name(), r"([^_]+:\d+)\.txt$", 1)
    return rows.select(
        chrom_number(F.split_part(locus, F.lit(":"), F.lit(1))).alias("chr"),
        F.split_part(locus, F.lit(":"), F.lit(2)).try_cast("bigint").alias("pos"), "*")


def read_genomic_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated genomic table with ``#Chrom`` and ``Pos`` and the columns of ``schema`` among others."""
    return read_header_table(spark, path, schema, what="genomic table")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated sample table; the type row under the header, all zeros and letters, is kept out."""
    rows = read_header_table(spark, path, schemas.SAMPLE, sep=" ", what="sample table")
    return rows.filter(~((F.col("ID_1") == "0") & (F.col("ID_2") == "0"))).withColumn("sample_id", F.col("ID_1"))


def read_sample_values(spark: SparkSession, path: str, what: str = "phenotype table", width: int | None = None) -> DataFrame:
    """Tab-separated table with ``Sample_ID`` and one numeric column per phenotype or covariate, empty = missing."""
    names = header_columns(spark, path)
    if "Sample_ID" not in names:
        raise ValueError(f"{what} lacks column Sample_ID; it has {', '.join(names)}")
    if len(names) < 2 or (width is not None and len(names) != width):
        raise ValueError(f"{what} has {len(names)} columns")
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = _csv(spark, text, True, nullValue="").csv(path)
    values = [F.col(f"`{n}`").try_cast("double").alias(n) for n in names if n != "Sample_ID"]
    return rows.select(F.col("Sample_ID").alias("sample_id"), *values)


def read_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """Long genotype table in Parquet: ``ID, sample_id, n_alt``."""
    return schemas.require_columns(spark.read.parquet(path), ["ID", "sample_id", "n_alt"], "genotypes")
