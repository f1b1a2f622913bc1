"""Raw CSV and JSON in one scan: headers, forms, types, corrupt rows."""

import json
import os
import time

import pytest
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from lakestrata.plans.layers import standardize
from lakestrata.session import local_path
from lakestrata.sources import LakeLayout
from lakestrata.sources.raw_files import landed_lines, read_raw_csv, read_raw_json


def _write(path, text):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- CSV ---------------------------------------------------------------------------------

def test_headers_of_many_forms(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "\n\nid,Name , note\n1,\"x, \"\"y\"\"\",\n2\n\n3,z,n,extra\n")
    _write(f"{tmp_dir}/b.csv", "﻿NOTE,id\nb,4\nNOTE,id\n")  # the second header line is a row
    _write(f"{tmp_dir}/c.csv", "id,id,\n5,6,7\n")
    _write(f"{tmp_dir}/d.csv", "")
    _write(f"{tmp_dir}/e.csv", "id\n")
    df = read_raw_csv(spark, tmp_dir)
    assert df.columns == ["NOTE", "id", "Name", "id0", "id1", "_c2", "_corrupt_record", "__source_file"]
    got = {(r.id, r.Name, r.NOTE, r.id0, r.id1, r._c2): r._corrupt_record for r in df.collect()}
    assert set(got) >= {("2", None, None, None, None, None), ("3", "z", "n", None, None, None), ("4", None, "b", None, None, None),
                        ("id", None, "NOTE", None, None, None), (None, None, None, 5, 6, 7)}
    assert len(got) == 6 and [k[0] for k, v in got.items() if v] == ["3"] and got[("3", "z", "n", None, None, None)] == "3,z,n,extra"


def test_types_from_all_values(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "i,l,f,d,t,s,none,mixed,code\n1,1,1,2024-01-02,2024-01-02,x,,1,007\n-2,99999999999,2.5,2024-01-03,2024-01-03 04:05:06,1,,2024-01-01,8\n")
    assert dict(read_raw_csv(spark, tmp_dir).drop("__source_file").dtypes) == {
        "i": "int", "l": "bigint", "f": "double", "d": "date", "t": "timestamp", "s": "string", "none": "string", "mixed": "string", "code": "int", "_corrupt_record": "string"}


def test_declared_csv_schema_counts_what_it_cannot_hold(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "d,v,unused\n2024-01-02,1.5,u\nsoon,x,u\n")
    schema = StructType([StructField("V", DoubleType()), StructField("d", DateType()), StructField("new", LongType())])
    rows = read_raw_csv(spark, tmp_dir, schema).collect()
    assert [(r.V, str(r.d), r.new, bool(r._corrupt_record)) for r in rows] == [(1.5, "2024-01-02", None, False), (None, "None", None, True)]


def test_many_headers_cost_as_much_as_few(spark, tmp_dir):
    took = {}
    for n in (5, 40):
        for i in range(40):
            names = [f"c{(j + i % n) % 40}" for j in range(6)]
            _write(f"{tmp_dir}/{n}/f{i}.csv", ",".join(names) + "\n" + "\n".join(",".join(f"{c[1:]}" for c in names) for _ in range(50)) + "\n")
        start = time.time()
        df = read_raw_csv(spark, f"{tmp_dir}/{n}")
        rows = df.collect()
        took[n] = time.time() - start
        assert len(rows) == 2000 and all(r[c] in (None, int(c[1:])) for r in rows for c in df.columns[:-2])
        assert sum(v is not None for r in rows for v in r[:-1]) == 2000 * 6
    assert took[40] < 4 * took[5] + 2


def test_text_is_scanned_once(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "a,b\n1,2\n")
    plan = read_raw_csv(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "FileScan text" not in plan
    assert landed_lines(spark, f"{tmp_dir}/a.csv").count() == 2


# --- JSON --------------------------------------------------------------------------------

def test_forms_of_json(spark, tmp_dir):
    records = [{"k": i, "u": "NaN", "z": float("nan"), "o": {"a": i, "b": [1, 2]}} for i in range(30)]
    _write(f"{tmp_dir}/one.json", json.dumps(records[:10]))  # one line
    _write(f"{tmp_dir}/two.json", json.dumps(records[10:20], indent=1))  # records over lines
    _write(f"{tmp_dir}/three.json", "﻿[\n" + ",\n".join(map(json.dumps, records[20:25])) + "\n]\n")
    _write(f"{tmp_dir}/four.json", "[" + "\n,".join(map(json.dumps, records[25:])) + "]")
    _write(f"{tmp_dir}/five.json", "\n\n" + "\n".join(json.dumps({"k": 100 + i, "w": i / 2}) for i in range(5)) + "\n{broken\n")
    _write(f"{tmp_dir}/six.json", "[{\"k\": 7},\n")  # cut off
    _write(f"{tmp_dir}/seven.json", "[]")
    _write(f"{tmp_dir}/eight.json", "")
    df = read_raw_json(spark, tmp_dir)
    good = df.where("_corrupt_record IS NULL").collect()
    assert sorted(r.k for r in good) == [*range(30), *range(100, 105)]
    assert all(r.u is None and r.z is None for r in good) and {r.w for r in good if r.k >= 100} == {0.0, 0.5, 1.0, 1.5, 2.0}
    assert all(tuple(r.o) == (r.k, [1, 2]) for r in good if r.k < 100)
    assert sorted(r._corrupt_record.strip() for r in df.where("_corrupt_record IS NOT NULL").collect()) == ['[{"k": 7},', "{broken"]


def test_types_of_json(spark, tmp_dir):
    _write(f"{tmp_dir}/a.json", '{"m": 1, "n": null, "f": 1.50, "b": true, "x": {"y": 1}, "e": {}, "l": [], "odd name": "q", "big": 99999999999}\n{"m": "t", "x": {"z": "w"}, "l": [1.5]}\n')
    df = read_raw_json(spark, tmp_dir)
    assert dict(df.drop("__source_file").dtypes) == {"b": "boolean", "big": "bigint", "e": "string", "f": "double", "l": "array<double>", "m": "string", "n": "string", "odd name": "string",
                               "x": "struct<y:bigint,z:string>", "_corrupt_record": "string"}
    first = df.where("f IS NOT NULL").first()
    assert (first.m, first.f, first.x.y, first["odd name"], first.big) == ("1", 1.5, 1, "q", 99999999999)


def test_declared_json_schema(spark, tmp_dir):
    _write(f"{tmp_dir}/a.json", '{"k": 1, "s": 2.50}\n{"k": "x", "s": "y"}\n{bad\n')
    df = read_raw_json(spark, tmp_dir, StructType([StructField("k", LongType()), StructField("s", StringType())]))
    assert _rows(df.select("k", "s", df._corrupt_record.isNotNull())) == sorted([(1, "2.5", False), (None, "y", True), (None, None, True)], key=str)


# --- standardize ---------------------------------------------------------------------------

@pytest.mark.parametrize("options", [{}, {"check_integrity": False}, {"json_array": False}, {"schemas": {"e": StructType([StructField("k", LongType())])}}])
def test_corrupt_records_are_always_counted(spark, tmp_dir, options):
    lake = LakeLayout(tmp_dir)
    _write(lake.raw("a", "e", "20240131", "json"), '{"k": 1}\n{bad\n{"k": 2}\n')
    r = standardize(spark, lake, "json", "20240131", **options).first()
    out = spark.read.parquet(r.standardized_path)
    assert (r.n_corrupt, r.ok, r.error, out.count()) == (1, False, None, 2) and "_corrupt_record" not in out.columns


@pytest.mark.parametrize("check", [True, False])
def test_csv_rows_are_all_kept(spark, tmp_dir, check):
    lake = LakeLayout(tmp_dir)
    _write(lake.raw("a", "e", "20240131", "csv"), "id,v\n1,2\n3\n4,5,6\n7,8,9\n")
    r = standardize(spark, lake, "csv", "20240131", check_integrity=check).first()
    assert _rows(spark.read.parquet(r.standardized_path).select("id", "v")) == [(1, 2), (3, None), (4, 5), (7, 8)]
    assert (r.n_corrupt, r.ok, r.error) == (2, False, None)


def test_files_without_any_row(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    _write(lake.raw("a", "e", "20240131", "csv"), "\n \n")
    _write(lake.raw("b", "h", "20240131", "csv"), "id,v\n")
    status = {r.endpoint: r for r in standardize(spark, lake, "csv", "20240131").collect()}
    assert status["h"].n_rows == 0 and status["h"].ok and status["e"].n_corrupt in (0, None)
    _write(lake.raw("a", "j", "20240131", "json"), "[]")
    r = standardize(spark, lake, "json", "20240131").first()
    assert (r.n_rows, r.n_corrupt, r.error) == (0, 0, None)
