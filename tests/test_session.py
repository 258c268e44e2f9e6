"""Session settings, scratch folder, shuffle sizing."""

import pytest
from pyspark.sql import functions as F

from rollmill import files
from rollmill.session import own_session, scratch_path, shared_dir, shuffle_partitions, size_shuffles, stage, tidy


def test_shared_dir_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared_dir(spark)}/rollmill/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cluster_without_shared_dir_is_refused():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077", "spark.sql.warehouse.dir": "file:/tmp/wh"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


@pytest.mark.parametrize("master, warehouse", [("local[2]", "file:/tmp/wh"), ("yarn", "hdfs://store/wh")])
def test_without_the_setting_the_warehouse_is_the_shared_place(master, warehouse):
    settings = {"spark.master": master, "spark.sql.warehouse.dir": warehouse}

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: settings.get(key, default))

    assert shared_dir(Session) == f"{warehouse}/_scratch"


def test_shuffle_sizing(spark):
    assert shuffle_partitions(0, 200) == 200
    assert shuffle_partitions(10**14, 200) == 2_235_175  # 256 MiB each, at any size
    assert shuffle_partitions(10**11, 200) == 2236
    child = own_session(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert child.conf.get("spark.sql.shuffle.partitions") == before
    size_shuffles(child, child.range(10**9).select(F.col("id")))
    assert int(child.conf.get("spark.sql.shuffle.partitions")) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert child.conf.get("spark.sql.session.timeZone") == "UTC"


def test_tidy(spark):
    path = scratch_path(spark, "tidy")
    stage(spark.range(3), path)
    kept = scratch_path(spark, "never-written")
    tidy(spark)
    assert not files.exists(spark, path) and not files.exists(spark, kept)


def test_stage(spark):
    path = scratch_path(spark, "stage")
    df = spark.range(5).select("id", F.lit("x").alias("s"))
    again = stage(df, path)
    assert again.dtypes == df.dtypes
    assert sorted(r[0] for r in again.collect()) == list(range(5))
    files.delete(spark, path)
    assert not files.exists(spark, path)
