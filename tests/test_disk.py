"""What the lake's steps leave on disk and move in shuffles."""

import os
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata import catalog
from lakestrata.operators import dedupe_keep_first, integrity_check
from lakestrata.plans.layers import extract_responses, land_raw, refine_dimension, standardize
from lakestrata.session import FREE_SHUFFLES, checkpoint_root, copies_removed, local_path, shuffles_freed, staged
from lakestrata.sinks import write_json
from lakestrata.sources import LakeLayout


def _shuffles(spark) -> dict[str, int]:
    """Shuffle files of the session and their sizes."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = {}
    for p in (p for d in dirs for p in Path(d).rglob("shuffle_*.data")):
        try:
            found[str(p)] = p.stat().st_size
        except FileNotFoundError:  # freed meanwhile
            pass
    return found


def _files(folder: str) -> set[str]:
    return {os.path.join(r, f) for r, _, names in os.walk(local_path(folder)) for f in names}


@pytest.fixture()
def shuffle_joins(spark):
    """Planned as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("again", [0, 3])
def test_integrity_check_moves_hashes_and_only_rows_that_may_repeat(spark, tmp_dir, shuffle_joins, again):
    wide = spark.range(4000).selectExpr("id", "concat(sha2(cast(id AS string), 512), sha2(cast(-id AS string), 512)) AS text")
    wide.unionByName(wide.where(F.col("id") < again)).write.parquet(f"{tmp_dir}/t")
    df, before = spark.read.parquet(f"{tmp_dir}/t"), _shuffles(spark)
    report = integrity_check(df)
    assert tuple(report.collect()[0]) == (4000 + again, 4000, again, not again)
    moved = sum(n for f, n in _shuffles(spark).items() if f not in before)
    assert 0 < moved < 250_000  # all rows were moved once more: over 1 MB


def test_written_tables_leave_no_shuffle_files(spark, tmp_dir):
    rows = spark.range(20_000).withColumn("n", F.row_number().over(Window.partitionBy(F.col("id") % 100).orderBy("id")))
    for name, write in (("json", lambda: write_json(rows, f"{tmp_dir}/j")), ("copy", lambda: staged(rows, "x"))):
        before = _shuffles(spark)
        write()
        until = time.time() + 10
        while (left := set(_shuffles(spark)) - set(before)) and time.time() < until:
            time.sleep(0.1)
        assert not left, name
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    assert spark.read.json(f"{tmp_dir}/j").where("n = 200").count() == 100


def test_shuffles_freed_in_threads_and_by_the_sessions_own_setting(spark):
    inside, leave = threading.Event(), threading.Event()

    def other():
        with shuffles_freed(spark):
            inside.set()
            leave.wait(10)

    t = threading.Thread(target=other)
    t.start()
    inside.wait(10)
    with shuffles_freed(spark):
        pass
    assert spark.conf.get(FREE_SHUFFLES) == "true"  # the other thread still writes
    leave.set()
    t.join()
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    spark.conf.set(FREE_SHUFFLES, "false")
    try:
        with shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "false"
        assert spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES)


def test_standardize_removes_its_staged_lines(spark, tmp_dir):
    lake, copies = LakeLayout(f"{tmp_dir}/lake"), f"{checkpoint_root(spark)}/lakestrata/staged"
    rows = spark.range(30).selectExpr("id", "if(id = 3, null, 'x') t")
    land_raw(rows.unionByName(rows.where("id = 5")).coalesce(1), lake, "a", "e", "20240131")
    before = _files(copies)
    status = standardize(spark, lake, "json", "20240131").first()
    assert (status.n_rows, status.n_duplicates, status.n_corrupt, status.ok) == (31, 1, 0, False)
    assert _files(copies) <= before
    assert spark.read.parquet(status.standardized_path).count() == 31


def test_standardize_leaves_no_large_shuffle(spark, tmp_dir):
    lake = LakeLayout(f"{tmp_dir}/lake")
    land_raw(spark.range(20_000), lake, "a", "e", "20240131")
    before = _shuffles(spark)
    assert standardize(spark, lake, "json", "20240131").first().ok
    until = time.time() + 10
    left = lambda: sum(n for f, n in _shuffles(spark).items() if f not in before)
    while left() > 50_000 and time.time() < until:  # a hash for each row is over 150,000
        time.sleep(0.1)
    assert left() < 50_000


def test_copies_of_other_blocks_stay(spark):
    kept = staged(spark.range(3), "x")
    with pytest.raises(ValueError), copies_removed(spark):
        gone = staged(spark.range(4), "x")
        raise ValueError
    assert kept.count() == 3 and not _files(gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://"))


def test_layers_are_compressed_well(spark, tmp_dir):
    lake = LakeLayout(f"{tmp_dir}/lake")
    land_raw(spark.range(50), lake, "a", "e", "20240131", max_records_per_file=20, compression=catalog.CODEC)
    raw = _files(lake.raw("a", "e", "20240131", "json"))
    assert any(f.endswith(".json.gz") for f in raw)
    status = standardize(spark, lake, "json", "20240131").first()
    refined = refine_dimension(spark, lake, "a", "e", "dim_e")
    for folder in (status.standardized_path, refined):
        assert all(f.endswith(".zstd.parquet") for f in _files(folder) if f.endswith(".parquet"))
    assert status.ok and spark.read.parquet(refined).count() == 50


def test_responses_move_no_hash_of_the_row(spark, tmp_dir):
    path = local_path(f"{tmp_dir}/r")
    os.makedirs(path)
    for name, text in (("b", "<e><item><Id>1</Id><v>late</v></item></e>"), ("a", "<e><item><Id>1</Id><v>x</v></item><item><Id>1</Id><v>y</v></item></e>")):
        Path(f"{path}/{name}.xml").write_text(text)
    rows = extract_responses(spark, f"{tmp_dir}/r", "item", "Id")["rows"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" not in plan and [r.v for r in rows.collect()] == ["x"]
    ties = dedupe_keep_first(spark.range(5).selectExpr("1 AS k", "0 AS seq", "id"), "k", "seq")
    assert "xxhash64" in ties._jdf.queryExecution().executedPlan().toString()
