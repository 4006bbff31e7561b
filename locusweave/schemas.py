"""Canonical relations. File sources are always read with one of these."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


VARIANT_INFO = _schema(ID=_S, Marker=_S, OA=_S, EA=_S, EAF=_D, Info=_D)
GWAS_RESULT = _schema(ID=_S, beta=_D, chi2=_D)
SUMSTATS = _schema(
    ID=_S, beta=_D, chi2=_D, pval=_D, Marker=_S, chromosome=_I, position=_L,
    OA=_S, EA=_S, EAF=_D, Info=_D, phenotype=_S,
)
REGION = _schema(
    chrom=_I, chromStart=_L, chromEnd=_L, leadSnp_pos=_L, leadSnp_pval=_D, leadSnp_closest_gene=_S,
    num_included_variants=_L, num_phenotypes=_L, phenotypes=_S,
)
ANNOTATION = _schema(
    seqname=_S, source=_S, feature=_S, start=_L, end=_L, score=_S, strand=_S, frame=_S, attributes=_S,
)
PEAK = _schema(
    chrom=_S, start=_L, end=_L, name=_S, score=_D, strand=_S, thickStart=_L, thickEnd=_L, itemRgb=_S,
)
PEAK_HIT = _schema(study_accession=_S, transcription_factor=_S, biotype=_S, distance_to_peak=_L)
VARIANT_LIST = _schema(ID=_S, Chrom=_S, Pos=_L, OA=_S, EA=_S)
MOTIF_EFFECT = _schema(
    variant=_S, tf=_S, model_id=_S, database=_S, wt_score=_D, mt_score=_D, start_wt=_I, end_wt=_I,
    start_mt=_I, end_mt=_I, strand_wt=_S, strand_mt=_S, prediction=_S, score=_S,
)
SAMPLE = _schema(ID_1=_S, ID_2=_S, missing=_S, sex=_S)

SUMSTATS_COLUMNS = SUMSTATS.fieldNames()
REGION_COLUMNS = REGION.fieldNames()
VARIANT_LIST_COLUMNS = VARIANT_LIST.fieldNames()


def text_columns(names: list[str]) -> StructType:
    return StructType([StructField(name, _S) for name in names])


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> DataFrame:
    """Fail on the driver, before any job, when a needed column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks column(s) {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df


def require_width(df: DataFrame, width: int, what: str = "input") -> DataFrame:
    """Fail when a positional source does not have exactly ``width`` columns."""
    if len(df.columns) != width:
        raise ValueError(f"{what} should have {width} columns but has {len(df.columns)}")
    return df
