"""State kept day by day, snapshot index, bucketed stars, and the key bit map below the facts' aggregate."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestrata.operators.relational import might_match
from lakestrata.plans.facts import StarSpec, _only_eligible, latest_movements, stalled_detail
from lakestrata.plans.incremental_facts import merge_day, merge_stream, read_state
from lakestrata.plans.layers import standardize
from lakestrata.session import local_path
from lakestrata.sinks import write_parquet
from lakestrata.sinks.bucketed import join_bucketed, write_bucketed
from lakestrata.sources import LakeLayout, latest_snapshot_date, read_latest_snapshot
from lakestrata.sources.snapshots import newest_indexed_day, record_snapshot

SPEC = StarSpec(move_case="c", move_unit="u", move_task="k", move_time="t", unit_key="id", unit_name="name", case_code="code", case_type="type",
                type_key="tid", type_name="tname", task_codes=("2",), excluded_unit="X", case_types=("A",))
SCHEMA = "c string, u string, k string, t string"


def _moves(seed, n=300):
    rng = random.Random(seed)
    time = lambda: rng.choice(["99/99/2024 00:00:00", None, *[f"{d:02}/0{m}/2024 00:00:00" for d in (1, 2) for m in (1, 2)]])
    return [(rng.choice(["a", "b", "c", None]), rng.choice(["1", "2", None]), rng.choice(["2", "3"]), time()) for _ in range(n)]


def _rows(df):
    return sorted((tuple(r) for r in df.select("__unit", "__case", "__ts", "__n").collect()), key=str)


def test_state_equals_the_full_recomputation_after_each_day(spark, tmp_dir):
    days = {f"2024010{k}": _moves(k) for k in (1, 2, 3)}
    seen = {}
    for day in ("20240101", "20240102", "20240102", "20240103", "20240101"):
        seen[day] = days[day] if day != "20240101" or "20240103" not in seen else _moves(9)  # the first day comes again, changed
        state = merge_day(spark.createDataFrame(seen[day], SCHEMA), tmp_dir, day, SPEC)
        every = spark.createDataFrame([r for rows in seen.values() for r in rows], SCHEMA)
        assert _rows(state) == _rows(latest_movements(every, SPEC))


def test_a_run_that_stops_midway_is_repeated_safely(spark, tmp_dir):
    first, second = spark.createDataFrame(_moves(1), SCHEMA), spark.createDataFrame(_moves(2), SCHEMA)
    merge_day(first, tmp_dir, "20240101", SPEC)
    with pytest.raises(PySparkException):
        merge_day(second.withColumn("t", F.when(F.col("t").isNull(), F.raise_error(F.lit("no"))).otherwise(F.col("t"))), tmp_dir, "20240102", SPEC)
    assert _rows(read_state(spark, tmp_dir)) == _rows(latest_movements(first, SPEC))
    assert _rows(merge_day(second, tmp_dir, "20240102", SPEC)) == _rows(latest_movements(first.unionByName(second), SPEC))


def test_stream_takes_each_landed_day_whole(spark, tmp_dir):
    landed, state = f"{tmp_dir}/landed", f"{tmp_dir}/state-of"
    put = lambda day, rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{landed}/{day}")
    read = lambda day: spark.read.parquet(f"{landed}/{day}")
    run = lambda: merge_stream(spark, f"{landed}/*/*", spark.createDataFrame([], SCHEMA).schema, read, state, SPEC).awaitTermination()
    put("20240101", _moves(1))
    put("20240102", _moves(2))
    run()
    put("20240102", _moves(3, 40))  # late files of a day
    put("20240103", [("a", "1", "2", "01/01/2025 00:00:00")] * 3)
    run()
    run()  # nothing new
    assert _rows(read_state(spark, state)) == _rows(latest_movements(spark.read.parquet(f"{landed}/*"), SPEC))


def test_snapshot_index(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    root = lake.standardized_table("a", "t")
    for day, n in (("20240101", 1), ("20240102", 2)):
        write_parquet(spark.range(n), lake.standardized("a", "t", day))
    assert latest_snapshot_date(spark, root) == "20240102" and newest_indexed_day(spark, root) is None  # by listing
    record_snapshot(spark, root, "20240101", earlier=["20240101", "20240102"])
    write_parquet(spark.range(9), lake.standardized("a", "t", "20240103"))
    assert latest_snapshot_date(spark, root) == "20240102"  # the third day isn't noted as whole
    record_snapshot(spark, root, "20240103", n_rows=9)
    assert latest_snapshot_date(spark, root) == "20240103" and read_latest_snapshot(spark, root).count() == 9
    assert newest_indexed_day(spark, root, "delta") is None


def test_standardize_enters_its_days(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    write_parquet(spark.range(2), lake.standardized("a", "e", "20240301"))  # from before the index
    for day in ("20240131", "20240201"):
        p = local_path(lake.raw("a", "e", day, "csv"))
        os.makedirs(os.path.dirname(p))
        with open(p, "w") as f:
            f.write("id\n1\n")
        assert standardize(spark, lake, "csv", day).first().ok
    assert latest_snapshot_date(spark, lake.standardized_table("a", "e")) == "20240301"


# --- bucketed star --------------------------------------------------------------------------

def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_star_moves_no_movement(spark, tmp_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mv = write_bucketed(spark.range(3000).selectExpr("id", "id % 211 AS c"), f"{tmp_dir}/m", "c", 8, hot_factor=None)
        cs = write_bucketed(spark.range(200).selectExpr("id AS code", "id * 2 AS v"), f"{tmp_dir}/c", "code", 8, hot_factor=None)
        out = join_bucketed(spark, mv, cs)
        plan = _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert out.count() == 3000 and out.where("v IS NULL").count() == 3000 - sum(1 for i in range(3000) if i % 211 < 200)
    assert out.where("v <> 2 * c").isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_and_null_keys_lie_beside_the_buckets(spark, tmp_dir, how):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 500).cast("long").alias("c"))
    mv = write_bucketed(df, f"{tmp_dir}/m", "c", 16)
    cs = write_bucketed(spark.range(0, 400, 2).unionByName(spark.createDataFrame([(7,)], "id long")).selectExpr("id AS code", "id * 2 AS v"), f"{tmp_dir}/c", "code", 16, hot_factor=None)
    assert [r["__key"] for r in mv.hot_keys.collect()] == [7] and spark.table(mv.name).where("c = 7 OR c IS NULL").isEmpty()
    assert mv.rows(spark).exceptAll(df).isEmpty() and mv.rows(spark).count() == 4000
    want = df.join(cs.rows(spark), F.col("c") == F.col("code"), how)
    got = join_bucketed(spark, mv, cs, how)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_bucketed_edges(spark, tmp_dir):
    empty = write_bucketed(spark.range(0).selectExpr("id", "id AS c"), f"{tmp_dir}/e", "c", 4)
    cs = write_bucketed(spark.range(3).selectExpr("id AS code"), f"{tmp_dir}/c", "code", 4, hot_factor=None)
    assert join_bucketed(spark, empty, cs).count() == 0
    for how, dim in (("full", cs), ("left", empty)):
        with pytest.raises(ValueError):
            join_bucketed(spark, empty, dim, how)


# --- key bit map ----------------------------------------------------------------------------

def test_might_match_keeps_every_wanted_row(spark):
    df = spark.range(20_000).selectExpr("id", "concat('k', id % 5000) AS k").unionByName(spark.createDataFrame([(1, None)], "id long, k string"))
    keys = spark.range(100).selectExpr("concat('k', id) AS key").unionByName(spark.createDataFrame([(None,)], "key string"))
    got = might_match(df, "k", keys)
    assert got.columns == df.columns and got.join(keys, F.col("k") == F.col("key"), "left_semi").count() == 400 and got.count() <= 420
    assert might_match(df, "k", keys.limit(0)).count() == 0
    assert 400 <= might_match(df, "k", keys, bits=8).count() < 20_000  # small maps let more through
    assert might_match(df, "k", keys, max_keys=10) is df and might_match(df, "id", keys) is df


def test_rows_of_other_keys_go_before_the_shuffle(spark):
    moves = spark.range(10_000).selectExpr("cast(id % 1000 AS string) AS c", "cast(id % 50 AS string) AS u", "'2' AS k", "'01/02/2024 00:00:00' AS t")
    units = spark.range(50).selectExpr("cast(id AS string) AS id", "if(id < 25, 'X', concat('n', id)) AS name")
    cases = spark.range(1000).selectExpr("cast(id AS string) AS code", "cast(id % 4 AS string) AS type")
    types = spark.createDataFrame([("0", "A"), ("1", "B"), ("2", "B"), ("3", "B")], "tid string, tname string")
    entering = _only_eligible(moves, units, cases, types, SPEC).count()
    exact = moves.where("c % 4 = 0 AND u >= 25").count()
    assert exact <= entering <= exact * 1.05 + 20
    both = [stalled_detail(moves, units, cases, types, SPEC, prefilter=p) for p in (True, False)]
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty() and both[0].count() > 0
    lines = both[0]._jdf.queryExecution().sparkPlan().toString().splitlines()
    first = max(i for i, x in enumerate(lines) if "HashAggregate" in x and "__unit" in x)  # the lowest aggregate
    assert any("BroadcastHashJoin" in x and "__word" in x for x in lines[first:])
