"""Tables replaced by a commit: failed writes, readers in between, reading and replacing at once, old versions."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestrata.plans.layers import refine_dimension
from lakestrata.sinks import drop_old_versions, publish_refined, read_current, replace_committed, write_parquet
from lakestrata.sinks.committed import current_version, resolve
from lakestrata.sources import LakeLayout, read_parquet


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_failed_write_leaves_the_old_rows(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    assert replace_committed(spark.range(5), path) == 5
    before = current_version(spark, path)
    with pytest.raises(PySparkException):
        replace_committed(spark.range(0, 90, 1, 9).select(F.when(F.col("id") < 80, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id")), path)
    assert current_version(spark, path) == before and _ids(read_parquet(spark, path)) == [0, 1, 2, 3, 4]
    assert replace_committed(spark.range(2), path) == 2 and _ids(read_current(spark, path)) == [0, 1]


def test_first_write_that_fails_leaves_no_table(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    with pytest.raises(PySparkException):
        replace_committed(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert current_version(spark, path) is None and resolve(spark, path) == path
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)


def test_readers_keep_their_version_and_a_table_replaces_itself(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    replace_committed(spark.range(4), path)
    old = read_parquet(spark, path)
    assert replace_committed(old.where("id % 2 = 1").withColumn("more", F.lit("x")), path) == 2  # another schema too
    assert _ids(old) == [0, 1, 2, 3] and _ids(read_parquet(spark, path)) == [1, 3] and read_parquet(spark, path).columns == ["id", "more"]
    assert replace_committed(spark.range(0), path) == 0 and read_parquet(spark, path).count() == 0


def test_old_versions_are_emptied(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    for n in range(1, 5):
        replace_committed(spark.range(n), path, max_records_per_file=2)
    versions = [r.version for r in spark.read.json(f"{path}/commits").orderBy("seq").collect()]
    assert drop_old_versions(spark, path, keep=2) == versions[1::-1]
    assert [spark.read.parquet(f"{path}/versions/{v}").count() for v in versions] == [0, 0, 3, 4]
    assert drop_old_versions(spark, f"{tmp_dir}/none") == [] and drop_old_versions(spark, path, keep=0) and _ids(read_parquet(spark, path)) == [0, 1, 2, 3]


def test_plain_tables_are_read_as_before(spark, tmp_dir):
    write_parquet(spark.range(3), f"{tmp_dir}/p/day=1")
    assert read_parquet(spark, f"{tmp_dir}/p").count() == 3 and read_parquet(spark, f"{tmp_dir}/p/*").count() == 3
    assert resolve(spark, f"{tmp_dir}/p") == f"{tmp_dir}/p"


def test_refined_tables_by_commit(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    write_parquet(spark.createDataFrame([("10", " secad ")], "IdUnidade string, Sigla string"), lake.standardized("a", "units", "20240131"))
    path = refine_dimension(spark, lake, "a", "units", "dim_units", load_ts="2024-02-01 00:00:00", committed=True)
    assert read_parquet(spark, path).first().Sigla == " secad "
    assert publish_refined(read_parquet(spark, path).where("false"), path, committed=True) == 0 and read_parquet(spark, path).count() == 0
