import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from lakestrata.fixed import DECLARED_SCHEMAS, NOT_INFORMED
from lakestrata.operators import (
    ConformSpec,
    add_audit_columns,
    add_surrogate_key,
    cast_columns,
    clean_string_columns,
    conform,
    conform_to_schema,
    drop_columns,
    map_column_values,
    rename_columns,
)


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(
        [("1", " ana ", "3", "x"), ("2", None, "1", "y"), ("3", "", "bad", "z")],
        "cd_setor string, dsc_nome string, nk string, dsc_cpf string")


def test_rename_drop_ignore_missing(people):
    out = drop_columns(rename_columns(people, {"cd_setor": "nk_setor", "absent": "x"}), ["dsc_cpf", "absent"])
    assert out.columns == ["nk_setor", "dsc_nome", "nk"]


def test_cast_bad_value_is_null_under_ansi(people):
    out = cast_columns(people, {"nk": "int"})
    assert [r.nk for r in out.collect()] == [3, 1, None]
    with pytest.raises(Exception):
        cast_columns(people, {"nk": "int"}, strict=True).collect()


def test_map_values_keeps_type_and_cascades(people):
    out = map_column_values(cast_columns(people, {"nk": "int"}), {"nk": {3: 1, 1: 5}})
    assert out.schema["nk"].dataType == IntegerType()
    assert [r.nk for r in out.collect()] == [5, 5, None]


def test_number_mapped_in_text_column(people):
    out = map_column_values(people, {"cd_setor": {3: "three", 1: "one"}})
    assert out.schema["cd_setor"].dataType == StringType()
    assert [r.cd_setor for r in out.collect()] == ["one", "2", "three"]


def test_clean_string_columns(people):
    out = clean_string_columns(people, ["dsc_nome"])
    assert [r.dsc_nome for r in out.collect()] == ["ANA", NOT_INFORMED, NOT_INFORMED]


def test_conform_chain_order_uses_new_names(people):
    spec = ConformSpec(rename={"cd_setor": "nk_setor"}, cast={"nk_setor": "int"}, drop=["dsc_cpf"],
                       map_values={"nk_setor": {3: 1}}, clean_strings=["dsc_nome"],
                       surrogate_key="sk_setor", surrogate_order=["nk_setor"])
    out = conform(people, spec)
    assert out.columns == ["nk_setor", "dsc_nome", "nk", "sk_setor"]
    rows = {r.nk: r.asDict() for r in out.collect()}
    # 3 -> 1 after the cast; the key follows nk_setor order (1, 1, 2)
    assert rows["3"]["nk_setor"] == 1 and rows["3"]["dsc_nome"] == "ANA"
    assert rows["bad"]["nk_setor"] == 1 and rows["bad"]["dsc_nome"] == NOT_INFORMED
    assert rows["1"] == {"nk_setor": 2, "dsc_nome": NOT_INFORMED, "nk": "1", "sk_setor": 3}
    assert {rows["3"]["sk_setor"], rows["bad"]["sk_setor"]} == {1, 2}


def test_audit_columns_overwrite_and_fixed_values(spark, people):
    ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    once = add_audit_columns(people, ts)
    twice = add_audit_columns(once.withColumn("etl_versao", F.lit(7)), ts)
    assert twice.columns == people.columns + ["dt_carga", "etl_versao", "etl_dt_inicio", "etl_dt_fim"]
    r = twice.first()
    assert r.dt_carga == ts and r.etl_versao == 1
    assert r.etl_dt_inicio == dt.datetime(1900, 1, 1) and r.etl_dt_fim == dt.datetime(2200, 1, 1)
    now = add_audit_columns(people).select("dt_carga").distinct().collect()
    assert len(now) == 1 and now[0].dt_carga is not None


@pytest.mark.parametrize("materialize", [True, False])
def test_surrogate_key_contiguous_over_many_partitions(spark, materialize):
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = add_surrogate_key(df, "sk", ["k"], num_partitions=5, materialize=materialize)
    rows = out.collect()
    assert sorted(r.sk for r in rows) == list(range(1, 5001))
    assert all(r.sk == r.k + 1 for r in rows)  # follows the key order


def test_surrogate_key_without_order_and_ties(spark):
    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") % 3).alias("g"))
    unordered = add_surrogate_key(df, "sk")
    assert sorted(r.sk for r in unordered.collect()) == list(range(1, 1001))
    tied = add_surrogate_key(df, "sk", ["g"], num_partitions=3)
    rows = tied.collect()
    assert sorted(r.sk for r in rows) == list(range(1, 1001))
    by_group = {}
    for r in rows:
        by_group.setdefault(r.g, []).append(r.sk)
    assert max(by_group[0]) < min(by_group[1]) and max(by_group[1]) < min(by_group[2])


def test_conform_to_schema(spark):
    df = spark.createDataFrame([("1", "2.5", "x", "extra")], "saldo string, salario_mensal string, uf string, z string")
    schema = DECLARED_SCHEMAS["GovCaged"]
    out = conform_to_schema(df, schema)
    assert out.schema == StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    r = out.first()
    assert r.saldo == 1 and r.salario_mensal == 2.5 and r.uf == "x" and r.idade is None
    assert len(DECLARED_SCHEMAS["GovCaged"].fields) == 39 and len(DECLARED_SCHEMAS["GovCagedDW"].fields) == 40
    assert DECLARED_SCHEMAS["GovCagedDW"]["horas_contratuais"].dataType == IntegerType()
    assert DECLARED_SCHEMAS["GovCaged"]["horas_contratuais"].dataType == DoubleType()


def test_surrogate_key_hot_order_value_is_spread(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = add_surrogate_key(df, "sk", ["k"], num_partitions=6, materialize=True)
    per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_part) < 2000  # the hot value (1000 rows) is not alone in one task
    rows = out.collect()
    assert sorted(r.sk for r in rows) == list(range(1, 3001))
    hot = sorted(r.sk for r in rows if r.k == 0)
    assert hot == list(range(1, 1001))  # ties still come first, numbered contiguously


def test_names_with_dots_and_codes_to_names(spark):
    from lakestrata.operators.transforms import cast_columns, clean_string_columns, map_column_values

    df = spark.createDataFrame([(1, " a ")], "`a.b` int, `c.d` string")
    out = map_column_values(cast_columns(df, {"a.b": "bigint"}), {"a.b": {1: "Male", "x": "Other"}})
    assert clean_string_columns(out, ["c.d"]).first() == ("Male", "A")
    schema = StructType([StructField("a.b", LongType())]) if "LongType" in globals() else None
    assert schema is None or conform_to_schema(df, schema).first()[0] == 1


def test_surrogate_key_by_ranges_makes_no_copy(spark, tmp_dir):
    from pyspark.sql import functions as F

    spark.range(0, 9000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id",
                                                 F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), "id")).alias("s")).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    out = add_surrogate_key(df, "sk", ["k"], num_partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan  # no checkpoint
    rows = out.collect()
    assert sorted(r.sk for r in rows) == list(range(1, 9001)) and out.columns == ["k", "id", "s", "sk"]
    assert [r.k for r in sorted(rows, key=lambda r: r.sk)] == sorted(r.k for r in rows)
    assert {r.id: r.sk for r in rows} == {r.id: r.sk for r in add_surrogate_key(df.repartition(3), "sk", ["k"], num_partitions=8).collect()}
    hot = add_surrogate_key(df, "sk", ["k"], num_partitions=8).where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) > 1  # its 3000 rows are cut over several ranges
    by_text = add_surrogate_key(df, "sk", ["s"], num_partitions=4).collect()
    assert [r.s for r in sorted(by_text, key=lambda r: r.sk)] == sorted((r.s for r in rows), key=lambda x: (x is not None, x or ""))


def test_surrogate_key_of_other_inputs(spark):
    from pyspark.sql import functions as F

    assert add_surrogate_key(spark.range(0), "sk", ["id"]).count() == 0
    df = spark.range(50)
    assert [r.sk for r in add_surrogate_key(df, "sk", [F.col("id").desc()]).orderBy("id").collect()] == list(range(50, 0, -1))
    assert sorted(r.sk for r in add_surrogate_key(df.withColumn("m", F.create_map(F.lit("a"), "id")), "sk").collect()) == list(range(1, 51))
    assert [r.sk for r in add_surrogate_key(df.select((-F.col("id")).alias("a.b")), "sk", [F.col("`a.b`")]).orderBy("`a.b`").collect()] == list(range(1, 51))
