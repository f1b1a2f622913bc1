import json
import os

import pytest
from pyspark.sql import functions as F

from lakestrata import catalog
from lakestrata.plans.layers import extract_responses, ingest_responses, land_raw, nested_entity, read_responses, restrict_requests, standardize
from lakestrata.session import local_path
from lakestrata.sinks import qualify_table, write_delta, write_json, write_parquet
from lakestrata.sinks.writers import write_xml
from lakestrata.sources import (
    LakeLayout,
    jdbc_options,
    latest_snapshot_date,
    read_latest_snapshot,
    read_xml,
    select_raw_files,
)


def _write_text(path, text):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)


def test_layout_paths():
    lake = LakeLayout("s3a://lake")
    assert lake.raw("case_movements", "movements", "20240131") == \
        "s3a://lake/raw/case_movements/operacional/movements/20240131/movements_20240131.json"
    assert lake.standardized("a", "t", "20240131") == \
        "s3a://lake/standardized/a/operacional/t/20240131/t_20240131.parquet"
    assert lake.refined("case_units", "dim_case_units") == \
        "s3a://lake/refined/case_units/operacional/dim_case_units.parquet"


@pytest.fixture()
def raw_lake(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    rows = [{"IdAndamento": "1", "DataHora": "01/01/2024 00:00:00"},
            {"IdAndamento": "1", "DataHora": "01/01/2024 00:00:00"},
            {"IdAndamento": "2", "DataHora": None}]
    # the extractor's form: one JSON array file
    _write_text(lake.raw("case_movements", "movements", "20240131"), json.dumps(rows, ensure_ascii=False))
    # Spark's form: a folder of JSON Lines part files
    land_raw(spark.createDataFrame([("10", "SECAD")], "IdUnidade string, Sigla string"),
             lake, "case_units", "units", "20240131")
    land_raw(spark.createDataFrame([("10", "OLD")], "IdUnidade string, Sigla string"),
             lake, "case_units", "units", "20240130")
    _write_text(lake.raw("budget", "lines", "20240131", ext="csv"), "id,amount\n1,2.5\n1,2.5\n")
    _write_text(f"{lake.raw_root}/area_x/too_shallow/20240131.json", "[]")
    _write_text(f"{lake.raw_root}/json_area/operacional/t/20240131/t_20240131.txt", "x")
    return lake


def test_select_raw_files_rules(spark, raw_lake):
    got = select_raw_files(spark, raw_lake.raw_root, "json", "20240131").select(
        "business_area", "endpoint", "date_extraction").distinct().collect()
    assert sorted(tuple(r) for r in got) == [("case_movements", "movements", "20240131"),
                                              ("case_units", "units", "20240131")]
    one = select_raw_files(spark, raw_lake.raw_root, "json", "20240131", business_area="case_units")
    assert {r.endpoint for r in one.collect()} == {"units"}
    with pytest.raises(ValueError):
        select_raw_files(spark, raw_lake.raw_root, "xlsx", "20240131")
    with pytest.raises(FileNotFoundError):
        select_raw_files(spark, raw_lake.raw_root, "json", "20990101")


def test_standardize_json_and_csv(spark, raw_lake):
    status = {r.endpoint: r for r in standardize(spark, raw_lake, "json", "20240131",
                                                 load_ts="2024-01-31 12:00:00").collect()}
    assert set(status) == {"movements", "units"}
    assert status["movements"].ok is False and status["movements"].n_duplicates == 1
    assert status["units"].ok is True and status["units"].error is None
    moves = spark.read.parquet(raw_lake.standardized("case_movements", "movements", "20240131"))
    assert moves.count() == 3  # duplicates are reported, not removed
    assert {"dt_carga", "etl_versao", "etl_dt_inicio", "etl_dt_fim"} <= set(moves.columns)
    csv = standardize(spark, raw_lake, "csv", "20240131").collect()
    assert [(r.endpoint, r.n_rows, r.n_duplicates) for r in csv] == [("lines", 2, 1)]
    lines = spark.read.parquet(raw_lake.standardized("budget", "lines", "20240131"))
    assert dict(lines.dtypes)["amount"] == "double"


def test_latest_snapshot(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    for day, v in [("20240101", 1), ("20240315", 3), ("20240202", 2)]:
        write_parquet(spark.createDataFrame([(v,)], "v int"), lake.standardized("a", "t", day))
    root = lake.standardized_table("a", "t")
    assert latest_snapshot_date(spark, root) == "20240315"
    assert [r.v for r in read_latest_snapshot(spark, root).collect()] == [3]
    with pytest.raises(FileNotFoundError):
        latest_snapshot_date(spark, lake.standardized_table("a", "missing"))


SOAP = """<?xml version="1.0" encoding="UTF-8"?>
<soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/"><soap:Body><resp><parametros>
<item><IdAndamento>1</IdAndamento><DataHora>01/01/2024 10:00:00</DataHora>
  <Unidade><IdUnidade>10</IdUnidade><Sigla>SECAD</Sigla></Unidade><Usuario><IdUsuario>u1</IdUsuario></Usuario></item>
<item><IdAndamento>2</IdAndamento><DataHora></DataHora>
  <Unidade><Sigla>SEFIN</Sigla></Unidade><Usuario><IdUsuario>u2</IdUsuario></Usuario></item>
<item><IdAndamento>1</IdAndamento><DataHora>dup</DataHora>
  <Unidade><IdUnidade>10</IdUnidade><Sigla>SECAD</Sigla></Unidade><Usuario><IdUsuario>u1</IdUsuario></Usuario></item>
</parametros></resp></soap:Body></soap:Envelope>
"""


def test_xml_responses_flatten_lift_dedupe(spark, tmp_dir):
    _write_text(f"{tmp_dir}/resp/C-001.xml", SOAP)
    _write_text(f"{tmp_dir}/resp/C-002.xml", SOAP.replace("<IdAndamento>2<", "<IdAndamento>3<"))
    raw = read_xml(spark, f"{tmp_dir}/resp", "item")
    assert raw.count() == 6
    out = ingest_responses(spark, f"{tmp_dir}/resp", "item", "IdAndamento",
                           request_key=("IdProcedimentoFormatado", r"/([^/]+)\.xml$"))
    rows = {r.IdAndamento: r for r in out.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].DataHora == "01/01/2024 10:00:00"  # first seen wins over the later copy
    assert rows["1"].IdProcedimentoFormatado == "C-001"
    assert rows["3"].IdProcedimentoFormatado == "C-002"
    assert rows["2"].Unidade is None and rows["2"].DataHora is None  # missing id child, empty element
    assert rows["1"].Unidade == "10" and rows["1"].Usuario == "u1"
    units = nested_entity(spark, f"{tmp_dir}/resp", "item", "Unidade")
    assert sorted((str(r.IdUnidade), r.Sigla) for r in units.collect()) == [("10", "SECAD"), ("None", "SEFIN")]


def test_file_roundtrip_overwrite_append(spark, tmp_dir):
    df = spark.range(5)
    write_json(df, f"{tmp_dir}/j")
    write_json(df, f"{tmp_dir}/j")
    assert spark.read.json(f"{tmp_dir}/j").count() == 5
    write_parquet(df, f"{tmp_dir}/p", mode="append")
    write_parquet(df, f"{tmp_dir}/p", mode="append")
    assert spark.read.parquet(f"{tmp_dir}/p").count() == 10
    write_parquet(df.withColumn("d", F.lit("20240101")), f"{tmp_dir}/q", partition_by=["d"])
    write_parquet(df.withColumn("d", F.lit("20240102")), f"{tmp_dir}/q", partition_by=["d"], partition_overwrite=True)
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 10


def test_delta_write_needs_package(spark, tmp_dir):
    with pytest.raises(RuntimeError):
        write_delta(spark.range(1), f"{tmp_dir}/delta")


def test_jdbc_options_and_names():
    o = jdbc_options("jdbc:example://h/db", table="dw.t", properties={"user": "u"},
                     partition_column="id", lower_bound=1, upper_bound=100, num_partitions=8)
    assert o["dbtable"] == "dw.t" and o["numPartitions"] == "8" and o["user"] == "u"
    q = jdbc_options("jdbc:x", query="SELECT processo FROM dw.t")
    assert q["query"] == "SELECT processo FROM dw.t" and "dbtable" not in q
    qp = jdbc_options("jdbc:x", query="SELECT id FROM t", partition_column="id", lower_bound=0,
                      upper_bound=9, num_partitions=2)
    assert qp["dbtable"] == "(SELECT id FROM t) AS q"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id")
    assert qualify_table("public.processos", "dw") == "dw.processos"
    assert qualify_table("processos", "dw") == "dw.processos"


def test_ingest_without_key_keeps_all_rows(spark, tmp_dir):
    _write_text(f"{tmp_dir}/cities/c.xml", SOAP)
    out = ingest_responses(spark, f"{tmp_dir}/cities", "item", None)
    assert out.count() == 3


def test_standardize_delta_output_reports_failure(spark, raw_lake):
    status = standardize(spark, raw_lake, "csv", "20240131", output_format="delta").collect()
    assert len(status) == 1 and status[0].ok is False and "Delta" in status[0].error
    with pytest.raises(ValueError):
        standardize(spark, raw_lake, "csv", "20240131", output_format="orc")


def test_extract_responses_parses_once(spark, tmp_dir):
    from lakestrata.plans import extract_responses

    _write_text(f"{tmp_dir}/resp2/C-001.xml", SOAP)
    out = extract_responses(spark, f"{tmp_dir}/resp2", "item", "IdAndamento",
                            entities={"Unidade": None, "Usuario": "IdUsuario"})
    assert set(out) == {"rows", "Unidade", "Usuario"}
    assert out["rows"].count() == 2
    assert sorted(r.IdUsuario for r in out["Usuario"].collect()) == ["u1", "u2"]
    assert sorted(str(r.IdUnidade) for r in out["Unidade"].collect()) == ["10", "None"]


def test_relative_path_any_scheme(spark):
    from lakestrata.sources import relative_path

    df = spark.createDataFrame([("s3a://bucket/lake/raw/a/s/e/20240131/e_20240131.json/part-0.json",),
                                ("file:/tmp/lake/raw/a/s/e/20240131/x.csv",)], "path string")
    got = [r.rel for r in df.select(relative_path("path", "s3a://bucket/lake/raw").alias("rel")).collect()]
    assert got[0] == "a/s/e/20240131/e_20240131.json/part-0.json"
    got = [r.rel for r in df.select(relative_path("path", "/tmp/lake/raw").alias("rel")).collect()]
    assert got[1] == "a/s/e/20240131/x.csv"


def test_listing_is_narrowed_to_the_day(spark, raw_lake):
    from lakestrata.sources import layout_files

    day = layout_files(spark, raw_lake.raw_root, "20240130").collect()
    assert {r.date_extraction for r in day} == {"20240130"}
    with pytest.raises(ValueError):
        layout_files(spark, raw_lake.raw_root, "2024*")


def test_publish_refined_counts_rows_in_the_write(spark, tmp_dir):
    from lakestrata.sinks import publish_refined

    n = publish_refined(spark.range(7), f"{tmp_dir}/refined/t.parquet", load_ts="2024-01-01 00:00:00")
    assert n == 7
    assert spark.read.parquet(f"{tmp_dir}/refined/t.parquet").count() == 7


CASES_XML = """<Envelope><Body><resp><parametros>
<IdProcedimento>p1</IdProcedimento><ProcedimentoFormatado>C1</ProcedimentoFormatado>
<TipoProcedimento><IdTipoProcedimento>T1</IdTipoProcedimento><Nome>Contrato</Nome></TipoProcedimento>
</parametros></resp></Body></Envelope>
"""


def test_case_responses_lift_type_and_type_dim(spark, tmp_dir):
    from lakestrata.fixed import CASE_NESTED_ID_CHILDREN, BLOCKED_CASES
    from lakestrata.plans import extract_responses

    _write_text(f"{tmp_dir}/cases/C1.xml", CASES_XML)
    _write_text(f"{tmp_dir}/cases/{BLOCKED_CASES[0]}.xml", CASES_XML.replace("p1", "p9").replace(">C1<", ">CX<"))
    out = extract_responses(spark, f"{tmp_dir}/cases", "parametros", "IdProcedimento",
                            entities={"TipoProcedimento": None}, children=CASE_NESTED_ID_CHILDREN,
                            request_key=("request", r"/([^/]+)\.xml$"))
    rows = out["rows"].collect()
    assert {(r.IdProcedimento, r.TipoProcedimento) for r in rows} == {("p1", "T1"), ("p9", "T1")}
    types = out["TipoProcedimento"].collect()
    assert [(r.IdTipoProcedimento, r.Nome) for r in types] == [("T1", "Contrato")]
    kept = ingest_responses(spark, f"{tmp_dir}/cases", "parametros", "IdProcedimento",
                            children=CASE_NESTED_ID_CHILDREN, request_key=("request", r"/([^/]+)\.xml$"),
                            blocked=list(BLOCKED_CASES)).collect()
    assert [r.IdProcedimento for r in kept] == ["p1"]


def test_max_records_per_file_bounds_files(spark, tmp_dir):
    import glob as _glob

    write_parquet(spark.range(0, 20, numPartitions=1), f"{tmp_dir}/bounded", max_records_per_file=6)
    files = _glob.glob(f"{local_path(tmp_dir)}/bounded/*.parquet")
    assert len(files) == 4  # 6 + 6 + 6 + 2 rows, no repartition shuffle
    assert spark.read.parquet(f"{tmp_dir}/bounded").count() == 20


def test_refine_dimensions_batch(spark, tmp_dir):
    from lakestrata.operators import ConformSpec
    from lakestrata.plans import refine_dimensions

    lake = LakeLayout(tmp_dir)
    write_parquet(spark.createDataFrame([("10", " secad ")], "IdUnidade string, Sigla string"),
                  lake.standardized("units_area", "units", "20240131"))
    write_parquet(spark.createDataFrame([("u1",)], "IdUsuario string"),
                  lake.standardized("users_area", "users", "20240131"))
    status = refine_dimensions(spark, lake, [
        ("units_area", "units", "dim_units", ConformSpec(clean_strings=["Sigla"])),
        ("users_area", "users", "dim_users", None),
        ("missing_area", "missing", "dim_missing", None),
    ], load_ts="2024-02-01 00:00:00").collect()
    by_table = {r.table_name: r for r in status}
    assert by_table["dim_units"].n_rows == 1 and by_table["dim_users"].error is None
    assert by_table["dim_missing"].error.startswith("FileNotFoundError")
    assert spark.read.parquet(by_table["dim_units"].refined_path).first().Sigla == "SECAD"


def test_standardize_with_declared_json_form(spark, raw_lake):
    status = standardize(spark, raw_lake, "json", "20240131", business_area="case_units",
                         json_array=False).collect()
    assert [(r.endpoint, r.n_rows, r.ok) for r in status] == [("units", 1, True)]


def _write_text(path, text):
    import os

    from lakestrata.session import local_path

    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


def test_each_raw_file_is_read_by_its_own_form(spark, tmp_dir):
    import json

    lake = LakeLayout(tmp_dir)
    folder = lake.raw("a", "e", "20240131", "json").rsplit("/", 1)[0]
    _write_text(f"{folder}/one.json", json.dumps([{"k": i, "u": "NaN", "z": float("nan")} for i in range(500)], indent=1))
    _write_text(f"{folder}/two.json", "\n".join(json.dumps({"k": 1000 + i, "w": i}) for i in range(100)) + "\n{broken\n")
    r = standardize(spark, lake, "json", "20240131").first()
    out = spark.read.parquet(r.standardized_path)
    assert (r.n_rows, r.n_corrupt, r.ok, r.error) == (600, 1, False, None)
    assert out.select("k").distinct().count() == 600 and out.where("u IS NOT NULL OR z IS NOT NULL").count() == 0


def test_each_csv_file_has_its_own_header(spark, tmp_dir):
    lake = LakeLayout(tmp_dir)
    folder = lake.raw("a", "e", "20240131", "csv").rsplit("/", 1)[0]
    _write_text(f"{folder}/one.csv", "id,v\n1,2\n")
    _write_text(f"{folder}/two.csv", "v,id,extra\n9,8,7\n9,8,7,6\n")
    r = standardize(spark, lake, "csv", "20240131").first()
    rows = {(x.id, x.v, x.extra) for x in spark.read.parquet(r.standardized_path).collect()}
    assert rows == {(1, 2, None), (8, 9, 7)} and (r.n_corrupt, r.ok) == (1, False)


def test_xml_attributes_and_encoded_key(spark, tmp_dir):
    from lakestrata.plans.layers import read_responses

    _write_text(f"{tmp_dir}/C 001+x.xml", '<e xmlns:xsi="http://x"><item xsi:type="q"><Id xsi:type="xsd:string">10</Id></item></e>')
    r = read_responses(spark, f"{tmp_dir}/*.xml", "item", request_key=("req", r"([^/]*)\.xml$")).first()
    assert (r.Id, r.req) == ("10", "C 001+x")


def test_latest_snapshot_skips_days_without_the_table(spark, tmp_dir):
    from lakestrata.sources import latest_snapshot_path

    spark.range(3).write.parquet(f"{tmp_dir}/t/20240101/t_20240101.parquet")
    _write_text(f"{tmp_dir}/t/20240102/other.txt", "x")
    assert latest_snapshot_path(spark, f"{tmp_dir}/t").endswith("20240101/t_20240101.parquet")


def test_xml_written_compressed_in_bounded_files(spark, tmp_dir):
    rows = spark.range(100).selectExpr("cast(id as string) Id", "cast(id % 3 as string) request")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_xml(rows.coalesce(1), f"{tmp_dir}/x", "item", "items", partition_by=["request"], max_records_per_file=10, compression="lz4")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_dir}/x").select("path").collect()
    assert len(files) == 12 and all(r.path.endswith(".xml.lz4") for r in files)
    got = read_responses(spark, f"{tmp_dir}/x", "item").select("Id", "request").collect()
    assert sorted((int(r.Id), str(r.request)) for r in got) == [(i, str(i % 3)) for i in range(100)]


def test_landed_responses_take_no_shuffle_and_little_disk(spark):
    """One pass writes the responses; they take a fraction of their text (they were plain text after a shuffle)."""
    d = "/root/testdata/sf0.001"
    path = catalog._write_responses(spark, d)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0]
    text = spark.read.option("lineSep", "/item>").text(path).agg(F.sum(F.length("value"))).first()[0]
    assert files * 3 < text
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    got = read_responses(spark, path, "item", catalog.RESPONSE_SCHEMA).groupBy("request").count().collect()
    want = {r.l_returnflag: r["count"] for r in li.groupBy("l_returnflag").count().collect()}
    assert {r.request: r["count"] for r in got} == {**want, "Z": li.where("l_linenumber = 1").count()}


def test_short_key_list_is_broadcast(spark):
    """A request with most of the rows isn't shuffled to one task, whatever table the key list comes from."""
    rows = spark.range(1000).selectExpr("id", "if(id % 10 = 0, 'a', if(id % 10 = 1, null, 'b')) req")
    wanted = spark.range(100_000).selectExpr("if(id % 2 = 0, 'b', null) k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")  # below the size of the key list's own table
    try:
        out = restrict_requests(rows, "req", wanted)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.count() == 800 and {r.req for r in out.collect()} == {"b"}


def test_entities_from_one_columnar_copy(spark, tmp_dir):
    _write_text(f"{tmp_dir}/r/C1.xml", "<e><item><Id>1</Id><U><IdU>u1</IdU></U></item><item><Id>1</Id><U><IdU>u2</IdU></U></item></e>")
    out = extract_responses(spark, f"{tmp_dir}/r", "item", "Id", entities={"U": None}, children={"U": "IdU"})
    assert "parquet" in out["U"]._jdf.queryExecution().executedPlan().toString().lower()  # it was a checkpoint of whole rows
    assert sorted(r.IdU for r in out["U"].collect()) == ["u1", "u2"] and [r.U for r in out["rows"].collect()] == ["u1"]


def test_raw_json_landed_compressed(spark, tmp_dir):
    lake = LakeLayout(f"{tmp_dir}/lake")
    path = land_raw(spark.range(50).selectExpr("id", "if(id = 3, null, 'x') t").coalesce(1), lake, "a", "e", "20240131", max_records_per_file=20, compression="lz4")
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files) == 3 and all(f.endswith(".json.lz4") for f in files)
    status = standardize(spark, lake, "json", "20240131").first()
    assert status.ok and status.n_rows == 50
    assert spark.read.parquet(status.standardized_path).where("t IS NULL").select("id").collect()[0].id == 3
