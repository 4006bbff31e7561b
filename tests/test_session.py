from pyspark.sql import functions as F

from locusweave import session


def test_settled_rows_are_written_and_lineage_ends(spark):
    df = session.settle(spark.range(100).withColumn("v", F.rand()))
    assert df.collect() == df.collect()
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_without_a_shared_folder_rows_are_cached(spark, monkeypatch):
    df = spark.range(10)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: None)
    cached = session.settle(df)
    assert cached.is_cached
    cached.unpersist()


def test_broadcast_only_below_the_counted_size(spark):
    df = spark.range(1000)
    assert session.fits_broadcast(df, 1000 * session.row_bytes(df.schema))
    assert not session.fits_broadcast(df, 999 * session.row_bytes(df.schema))


def test_adaptive_skew_settings_are_on(spark):
    session.tune(spark)
    assert all(spark.conf.get(k) == v for k, v in session.ADAPTIVE_SETTINGS.items())


def test_tasks_are_cut_by_bytes_not_by_a_fixed_number(spark, conf):
    """Eight shuffle partitions are set, and the rows of an aggregate still go to more tasks once they are larger than these should be."""
    session.tune(spark)
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="16k", spark__sql__adaptive__coalescePartitions__minPartitionSize="16k")
    groups = spark.range(200_000).withColumn("id", F.xxhash64("id")).groupBy("id").count()
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 8 and groups.rdd.getNumPartitions() > 50
