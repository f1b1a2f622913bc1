import datetime as dt

from pyspark.sql import functions as F

from lakestrata.fixed import NOT_INFORMED
from lakestrata.functions import (
    clean_string,
    date_key,
    days_since,
    file_extension,
    map_values,
    null_like,
    parse_date_key,
    parse_event_time,
    path_part,
    swap_extension,
)


def test_parse_event_time_null_on_bad_text_with_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("05/03/2024 10:11:12",), ("31/02/2024 00:00:00",), ("garbage",), (None,)], "t string")
    got = [r.ts for r in df.select(parse_event_time("t").alias("ts")).collect()]
    assert got[0] == dt.datetime(2024, 3, 5, 10, 11, 12)
    assert got[1:] == [None, None, None]


def test_days_since_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59),), (dt.datetime(2024, 1, 1, 0, 0),)], "ts timestamp")
    got = [r.d for r in df.select(days_since("ts", "2024-01-10").alias("d")).collect()]
    assert got == [10, 9]


def test_clean_string_rules(spark):
    rows = [(" ab ",), ("",), ("  ",), (None,), ("\tx ",), ("ação",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.c for r in df.select(clean_string("s").alias("c")).collect()]
    assert got == ["AB", NOT_INFORMED, NOT_INFORMED, NOT_INFORMED, "\tX", "AÇÃO"]


def test_clean_string_on_number_becomes_text(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    out = df.select(clean_string("n").alias("c"))
    assert out.schema["c"].dataType.simpleString() == "string"
    assert [r.c for r in out.collect()] == ["1", NOT_INFORMED]


def test_null_like(spark):
    vals = [None, "", "None", "xNone", "NULL", "NONEXISTENT", "null", "ok"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.b for r in df.select(null_like("s").alias("b")).collect()]
    assert got == [True, True, True, True, True, False, False, False]
    nums = spark.createDataFrame([(1.5,), (None,)], "x double")
    assert [r.b for r in nums.select(null_like("x").alias("b")).collect()] == [False, True]


def test_map_values_cascade_and_types(spark):
    df = spark.createDataFrame([(3, "3"), (1, "1"), (2, "a"), (None, None)], "n int, s string")
    out = df.select(map_values("n", {3: 1, 1: 5}, "int").alias("n"),
                    map_values("s", [(3, "three"), ("a", "b")], "string").alias("s"))
    assert out.schema["n"].dataType.simpleString() == "int"
    assert [tuple(r) for r in out.collect()] == [(5, "three"), (5, "1"), (2, "b"), (None, None)]


def test_date_key_and_paths(spark):
    df = spark.createDataFrame([("a/b/c/20240131/x_20240131.json",)], "p string")
    r = df.select(
        date_key(F.lit(dt.date(2024, 1, 31))).alias("k"),
        parse_date_key(F.lit("20240131")).alias("d"),
        parse_date_key(F.lit("2024-01-31")).alias("bad"),
        path_part("p", 4).alias("day"),
        file_extension("p").alias("ext"),
        swap_extension("p", "json", "parquet").alias("swapped"),
    ).first()
    assert r.k == "20240131" and r.d == dt.date(2024, 1, 31) and r.bad is None
    assert r.day == "20240131" and r.ext == "json"
    assert r.swapped == "a/b/c/20240131/x_20240131.parquet"


def test_parse_is_zone_free_in_a_dst_gap(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 1999-10-03 00:00 does not exist in Sao Paulo (clocks jumped to 01:00)
        df = spark.createDataFrame([("03/10/1999 00:00:00",)], "t string")
        r = df.select(parse_event_time("t").alias("ts")).first()
        assert r.ts == dt.datetime(1999, 10, 3, 0, 0, 0)
        assert df.select(parse_event_time("t").alias("ts")).schema["ts"].dataType.simpleString() == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_time_text(spark):
    from lakestrata.functions import local_time_text

    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 10, 11, 12),)], "ts timestamp_ntz")
    r = df.select(*[local_time_text("ts", f).alias(f"f{i}") for i, f in enumerate(
        ["dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd", "01/MM/yyyy 00:00:00"])]).first()
    assert tuple(r) == ("05/03/2024 10:11:12", "2024-03-05 10:11:12", "2024-03-05", "20240305", "01/03/2024 00:00:00")


def test_event_times_are_parsed_once_and_as_before(spark):
    import itertools

    from pyspark.sql import functions as F

    from lakestrata.functions.expressions import parse_event_time

    texts = ["01/02/2024 03:04:05", "31/02/2024 00:00:00", "29/02/2024 23:59:59", "1/2/2024 3:4:5", " 01/02/2024 03:04:05", "01/02/2024 03:04:05 ", "01/02/2024 24:00:00",
             "01-02-2024 03:04:05", "01/02/2024T03:04:05", "", None, "NaN", "01/13/2024 00:00:00", "00/01/2024 00:00:00", "01/01/0001 00:00:00", "aa/bb/cccc dd:ee:ff", "01/02/2024 03:60:05",
             "01/02/2024 03:04:05\n", "31/12/9999 23:59:59", "10/03/2024 02:30:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.when(F.try_to_timestamp("t", F.lit("dd/MM/yyyy HH:mm:ss")).isNotNull(), F.to_timestamp_ntz("t", F.lit("dd/MM/yyyy HH:mm:ss")))
    for r in df.select("t", parse_event_time("t").alias("fast"), slow.alias("slow")).collect():
        assert r.fast == r.slow, r
    # other orders of the parts, and formats that take the general path
    forms = {"yyyyMMdd HHmmss": "20240201 030405", "ss:mm:HH yyyy.MM.dd": "05:04:03 2024.02.01", "yyyy-MM-dd'T'HH:mm:ss": "2024-02-01T03:04:05"}
    for (fmt, text), (_, other) in itertools.product(forms.items(), forms.items()):
        got = spark.createDataFrame([(other,)], "t string").select(parse_event_time("t", fmt).alias("x")).first().x
        assert (got is not None) == (text == other)
    plan = df.select(parse_event_time("t").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower() and "to_timestamp" not in plan.lower()
