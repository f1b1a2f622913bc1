import random

from pyspark.sql import functions as F

from lakestrata.operators import (
    anti_join,
    broadcast_if_bounded,
    dedupe_keep_first,
    distinct_rows,
    exclude_values,
    latest_per_group,
    latest_per_group_join_back,
    max_by_group,
    preview_topn,
    semi_join,
    sql_over_frames,
    union_by_name,
    union_positional,
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_keep_first_null_keys_equal(spark):
    df = spark.createDataFrame(
        [("a", 1, "first"), ("a", 2, "second"), (None, 3, "n1"), (None, 4, "n2"), ("b", 5, "only")],
        "k string, seq int, v string")
    got = {(r.k, r.v) for r in dedupe_keep_first(df, "k", "seq").collect()}
    assert got == {("a", "first"), (None, "n1"), ("b", "only")}


def test_dedupe_limits_before_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = _plan(dedupe_keep_first(df, "k", "seq"))
    assert "WindowGroupLimit" in plan


def test_latest_per_group_keeps_ties_drops_nulls(spark):
    rows = [("u1", "c1", 3), ("u1", "c1", 3), ("u1", "c1", 1), ("u2", "c1", 2), (None, "c1", 9),
            ("u3", "c2", None), ("u3", "c2", 1)]
    df = spark.createDataFrame(rows, "u string, c string, t int")
    got = sorted(tuple(r) for r in latest_per_group(df, ["u", "c"], "t").collect())
    assert got == [("u1", "c1", 3), ("u1", "c1", 3), ("u2", "c1", 2), ("u3", "c2", 1)]
    one = latest_per_group(df, ["u", "c"], "t", keep_ties=False).where("u = 'u1'").count()
    assert one == 1


def test_window_form_equals_join_back_form(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 20), rnd.choice([None] + list(range(6))))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "u string, c int, t int")
    w = sorted(map(tuple, latest_per_group(df, ["u", "c"], "t").collect()), key=str)
    j = sorted(map(tuple, latest_per_group_join_back(df, ["u", "c"], "t").collect()), key=str)
    assert w == j and len(w) > 0


def test_latest_plan_has_partial_limit_before_exchange(spark):
    df = spark.range(0, 100).select((F.col("id") % 5).alias("u"), (F.col("id") % 7).alias("c"), "id")
    for salts in (16, 1):
        plan = _plan(latest_per_group(df, ["u", "c"], "id", salts=salts))
        lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
        assert any("Partial" in line for line in lines) and any("Final" in line for line in lines)
    plan = _plan(latest_per_group(df, ["u", "c"], "id"))
    assert "Join" in plan and "partial_max" in plan  # only local winners meet their key's maximum


def test_semi_anti_and_exclude(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [r.k for r in semi_join(df, keys, "k").collect()] == ["a"]
    assert sorted(str(r.k) for r in anti_join(df, keys, "k").collect()) == ["None", "b"]
    assert sorted(str(r.k) for r in exclude_values(df, "k", ["a"]).collect()) == ["None", "b"]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    c = spark.createDataFrame([(3, "z", 1.0)], "id int, v string, extra double")
    byname = union_by_name(a, b, c).orderBy("id").collect()
    assert [tuple(r) for r in byname] == [(1, "x", None), (2, "y", None), (3, "z", 1.0)]
    pos = union_positional(a, a).collect()
    assert len(pos) == 2
    assert distinct_rows(union_positional(a, a)).count() == 1


def test_max_by_group_and_topn(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, max_by_group(df, "k", "v", "m").collect())) == [("a", 5), ("b", 2)]
    top = preview_topn(df, 2, [F.col("v").desc()]).collect()
    assert [r.v for r in top] == [5, 2]


def test_broadcast_only_when_bounded(spark):
    small = spark.range(10)
    big = spark.range(10_000)
    fact = spark.range(100).withColumnRenamed("id", "k")
    hinted = fact.join(broadcast_if_bounded(small, 100), fact.k == small.id)
    assert "BroadcastHashJoin" in _plan(hinted)
    unhinted = broadcast_if_bounded(big, 100)
    assert unhinted is big


def test_sql_over_frames_binds_frames_and_params(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    out = sql_over_frames(spark, "SELECT v FROM {t} WHERE id > :lo", {"lo": 1}, t=df)
    assert [r.v for r in out.collect()] == ["b"]


def test_replicate_rows_chunks_and_ids(spark):
    from lakestrata.operators.relational import replicate_rows

    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 0)], "k string, n long")
    out = replicate_rows(df, "n", chunk=3, spread_by=["k"], row_id="rid").collect()
    assert sorted((r.k, r.rid) for r in out) == [("a", i) for i in range(7)] + [("b", 0)]


def test_latest_per_group_keeps_copies(spark):
    rows = [("g", 5, "x")] * 500 + [("g", 4, "y"), ("h", 1, "z"), ("h", 1, "z")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    plain = sorted(map(tuple, latest_per_group(df, "k", "t").collect()))
    collapsed = sorted(map(tuple, latest_per_group(df, "k", "t", salts=1).collect()))
    assert plain == collapsed == sorted([("g", 5, "x")] * 500 + [("h", 1, "z")] * 2)


def test_replicate_rows_small_counts_need_no_shuffle(spark):
    from lakestrata.operators.relational import replicate_rows

    df = spark.createDataFrame([("a", 3), ("b", 2)], "k string, n long")
    out = replicate_rows(df, "n", spread_by=["k"])
    assert out.count() == 5


def test_latest_per_group_with_map_column(spark):
    df = spark.createDataFrame([("g", 2, {"a": 1}), ("g", 2, {"a": 1}), ("g", 1, {"b": 2})],
                               "k string, t int, m map<string,int>")
    assert latest_per_group(df, "k", "t").count() == 2


def test_dedupe_ties_are_deterministic(spark):
    rows = [("k", 1, f"v{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    picks = {dedupe_keep_first(df.repartition(n), "k", "seq").first().v for n in (1, 3, 7)}
    assert len(picks) == 1


def test_distinct_rows_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (2, {"a": 1})],
                               "x int, m map<string,int>")
    out = distinct_rows(df)
    assert out.columns == ["x", "m"] and out.count() == 2
