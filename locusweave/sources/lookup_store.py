"""Expression tables landed for lookups by variant ID.

Rows lie sorted by ID, so row groups hold short ranges of IDs, and every row group
has a bloom filter on the ID, which tells most of the IDs inside its range that it
does not hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.operators.eqtl import eqtl_lookup
from locusweave.session import settle

SCHEMA = "rsid string, chromosome string, position_hg38 bigint, gene string, pval double, slope double, cell_type string"
LISTED_IDS = 10_000  # IDs that go into the scan's filter; longer lists are joined only
ROW_GROUP_BYTES = 16 << 20
_IDS_PER_GROUP = 200_000


def land_eqtls(df: DataFrame, path: str, mode: str = "errorifexists", row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Writes ``SCHEMA`` rows for :func:`look_up`. An ID with very many rows is cut by its other columns."""
    keys = ["rsid", *[c for c in df.columns if c != "rsid"]]
    settled = settle(df)
    settled.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).options(**{
        "parquet.block.size": row_group_bytes, "parquet.bloom.filter.enabled#rsid": "true",
        "parquet.bloom.filter.expected.ndv#rsid": _IDS_PER_GROUP}).parquet(path)
    settled.unpersist()


def look_up(spark: SparkSession, path: str, rsids: DataFrame, listed: int = LISTED_IDS) -> DataFrame:
    """Landed rows of the listed IDs, from the row groups that may hold them.

    At most ``listed`` distinct IDs go into the scan's filter. A longer list, such as
    all hits of a study, is a semi join over the whole table. Null IDs match nothing.
    """
    landed = spark.read.schema(SCHEMA).parquet(path)
    wanted = rsids.select("rsid").where(F.col("rsid").isNotNull()).distinct()
    few = [r["rsid"] for r in wanted.limit(listed + 1).collect()]
    return landed.where(F.col("rsid").isin(few)) if len(few) <= listed else eqtl_lookup(landed, wanted)
