"""Session settings and size checks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Adaptive execution splits a shuffle partition that one hot key made too large,
# on either side of an inner join and on the kept side of outer and semi joins.
# The forced variant keeps the split even where it costs one more exchange later.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffles start out fine and are coalesced by their bytes, so what a task sorts or
    # aggregates has a bounded size and does not grow with the input over a fixed number.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

BROADCAST_BYTES = 256 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings every operator here relies on."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def row_bytes(schema: T.StructType) -> int:
    """Generous width of one row, used to bound a broadcast before asking for it."""
    fixed = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8}
    return 16 + sum(fixed.get(type(f.dataType), 64) + 8 for f in schema.fields)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, more: Column | None = None) -> bool:
    """Whether counted rows times row width stay below ``max_bytes``.

    Counting stops just past the limit. Meant for dimension tables read from
    storage, where counting is cheap next to shuffling the fact side. ``more`` gives
    bytes that a row has besides, for arrays of any length; then all rows are counted.
    """
    if more is not None:
        return (df.agg(F.sum(more + row_bytes(df.schema))).first()[0] or 0) <= max_bytes
    limit = max(1, max_bytes // row_bytes(df.schema))
    return df.select(F.lit(1)).limit(limit + 1).count() <= limit


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several readers.

    Where the cluster names a shared folder in ``spark.checkpoint.dir``, the rows
    are written there and the lineage ends, so lost executors cost nothing.
    Elsewhere they are cached and recomputed from lineage when lost.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        return df.persist()
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def measured(df: DataFrame) -> DataFrame:
    """Cache a small summary so that the planner sees its true size.

    With exact statistics Spark broadcasts it when it fits the session's
    threshold and shuffles otherwise; lost blocks are recomputed from lineage.
    """
    df = df.persist()
    df.count()
    return df
