from lakestrata.operators import integrity_check, null_profile, observe_rows, table_profile


def test_integrity_check_counts_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (2, None), (2, None)], "x int, y string")
    r = integrity_check(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates, r.ok) == (6, 3, 3, False)
    clean = integrity_check(spark.createDataFrame([(1,), (2,)], "x int")).first()
    assert clean.ok and clean.n_duplicates == 0
    empty = integrity_check(spark.createDataFrame([], "x int")).first()
    assert (empty.n_rows, empty.n_duplicates, empty.ok) == (0, 0, True)


def test_null_profile_one_job_semantics(spark):
    rows = [(None, 1.0, "ok"), ("", 2.0, "ok"), ("None", None, "ok"), ("xNone", 3.0, "ok"),
            ("NULL", 4.0, "ok"), ("NONEXISTENT", 5.0, "ok")]
    df = spark.createDataFrame(rows, "s string, x double, fine string")
    got = {r.column_name: r.n_null_like for r in null_profile(df).collect()}
    assert got == {"s": 5, "x": 1}
    full = {r.column_name: r.n_null_like for r in null_profile(df, only_positive=False).collect()}
    assert full["fine"] == 0


def test_table_profile_and_observe(spark):
    df = spark.range(42)
    r = table_profile(df).first()
    assert (r.n_rows, r.n_columns) == (42, 1)
    observed, obs = observe_rows(df)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["n_rows"] == 42


def test_integrity_check_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (2, {"a": 1})], "x int, m map<string,int>")
    r = integrity_check(df).first()
    assert (r.n_rows, r.n_duplicates) == (3, 1)


def test_reports_with_awkward_column_names(spark):
    df = spark.createDataFrame([(None, "x"), ("", "y")], "`a.b` string, `c``d` string")
    got = {r.column_name: r.n_null_like for r in null_profile(df).collect()}
    assert got == {"a.b": 2}
    assert integrity_check(df).first().n_rows == 2


def test_duplicate_check_compares_rows_with_equal_hashes_in_full(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lakestrata.operators import duplicate_files, quality

    df = spark.createDataFrame([("f", 1, None), ("f", None, 1), ("f", 1, None), ("g", 1, None), ("g", 2, 2), ("h", 3, 3), ("h", 3, 3), ("h", 3, 3)], "file string, a int, b int")
    want = [("f", 3, 2, 1), ("h", 3, 1, 2)]
    assert sorted(tuple(r) for r in duplicate_files(df, "file").collect()) == want
    assert tuple(integrity_check(df.drop("file")).first()) == (8, 4, 4, False)
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(7).cast("long"))  # all rows share their hashes
    assert sorted(tuple(r) for r in duplicate_files(df, "file").collect()) == want
    assert tuple(integrity_check(df.drop("file")).first()) == (8, 4, 4, False)


def test_duplicate_files_with_clashing_names_and_none(spark):
    from lakestrata.operators import duplicate_files

    df = spark.createDataFrame([("x", "f", 1), ("x", "f", 1), (None, "g", 1), (None, "g", 1)], "`src` string, `file` string, n_rows int")
    assert sorted((str(r.file), r.n_rows, r.n_duplicates) for r in duplicate_files(df, "src").collect()) == [("x", 2, 1)]
    assert duplicate_files(df.limit(0), "src").count() == 0


def test_integrity_shuffles_hashes_only(spark):
    wide = spark.range(10).selectExpr("id", "repeat('x', 500) AS text", "id AS more")
    plan = integrity_check(wide)._jdf.queryExecution().sparkPlan().toString()
    first = [x for x in plan.splitlines() if "HashAggregate(keys=[__h1" in x and "partial_count" in x]
    assert first and not any("text" in x.split("functions")[0] for x in first[:1])


def test_rows_in_two_files_are_no_duplicates(spark, tmp_dir):
    import os

    from lakestrata.plans.layers import duplicate_raw_files, standardize
    from lakestrata.session import local_path
    from lakestrata.sources import LakeLayout

    lake = LakeLayout(tmp_dir)
    folder = local_path(lake.raw("a", "e", "20240131", "csv").rsplit("/", 1)[0])
    os.makedirs(folder)
    for name, text in (("one", "id,v\n1,2\n3,4\n"), ("two", "v,id\n2,1\n")):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    r = standardize(spark, lake, "csv", "20240131").first()
    assert (r.n_rows, r.n_duplicates, r.ok) == (3, 0, True) and duplicate_raw_files(spark, lake, "csv", "20240131").count() == 0
    with open(f"{folder}/two.csv", "a") as f:
        f.write("2,1\n")
    r = standardize(spark, lake, "csv", "20240131").first()
    assert (r.n_rows, r.n_duplicates, r.ok) == (4, 1, False)
    assert [(x.file, x.n_rows, x.n_duplicates) for x in duplicate_raw_files(spark, lake, "csv", "20240131").collect()] == [("a/operacional/e/20240131/two.csv", 2, 1)]
