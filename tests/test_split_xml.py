"""XML by splits: rows, corrupt elements, schemas, and many tasks over one file."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lakestrata.plans.layers import ingest_responses, read_responses
from lakestrata.session import local_path
from lakestrata.sources.files import read_xml
from lakestrata.sources.split_xml import element_paths, read_xml_split


def _write(path, text, mode="w"):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, mode, **({} if "b" in mode else {"encoding": "utf-8"})) as f:
        f.write(text)


ODD = """<?xml version="1.0"?><e xmlns:xsi="q"><item xsi:type="t > u"><Id>007</Id><U><IdU>1</IdU><S/></U><R>x</R><R>y</R></item>
<item/><!-- <item> old --><item><Id>2 &amp; 3</Id><D></D><C><![CDATA[<b>]]></C></item><items><Id>no row</Id></items>
<item><Id>5</Id><broken></item><item><Id>6</Id><item><Id>7</Id></item></item><item><Id>8</Id></item></e>"""


def test_rows_and_corrupt_elements(spark, tmp_dir):
    _write(f"{tmp_dir}/a.xml", ODD)
    _write(f"{tmp_dir}/b.xml", "<e><item><Id>é9</Id></item><item><Id>10</Id>")
    df = read_xml_split(spark, tmp_dir, "item")
    rows = df.orderBy("__source_file", "__source_pos").collect()
    assert [r.Id for r in rows if not r._corrupt_record] == ["007", None, "2 & 3", "8", "é9"]
    assert [r._corrupt_record for r in rows if r._corrupt_record] == [
        "<item><Id>5</Id><broken></item>", "<item><Id>6</Id><item><Id>7</Id></item>", "</item>", "<item><Id>10</Id>"]
    assert (rows[0].U.IdU, rows[0].U.S, rows[0].R, rows[2].C, rows[2].D) == ("1", None, ["x", "y"], "<b>", None)
    assert df.schema["R"].dataType == ArrayType(StringType()) and df.schema["U"].dataType.fieldNames() == ["IdU", "S"]


def test_corrupt_elements_fail_or_are_counted(spark, tmp_dir):
    _write(f"{tmp_dir}/a.xml", ODD)
    schema = StructType([StructField("Id", StringType())])
    with pytest.raises(PySparkException, match="cannot parse"):
        read_responses(spark, tmp_dir, "item", schema).collect()
    bad = Observation("bad")
    assert {r.Id for r in read_responses(spark, tmp_dir, "item", schema, corrupt=bad).collect()} == {"007", "2 & 3", "8", None}
    assert bad.get["n_corrupt"] == 3


def test_one_file_spreads_over_tasks(spark, tmp_dir):
    rng = random.Random(4)
    n = 60_000
    body = "\n".join(f"<item><Id>{i}</Id><U><IdU>{rng.randrange(9)}</IdU></U><T>{'é' * rng.randrange(90)}</T></item>" for i in range(n))
    _write(f"{tmp_dir}/big.xml", f"<e><parametros>{body}</parametros></e>")
    assert os.path.getsize(local_path(f"{tmp_dir}/big.xml")) > 8 << 20
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = read_xml_split(spark, tmp_dir, "item", "Id string, U struct<IdU: string>, T string")
        got = df.select("Id", "_corrupt_record", F.spark_partition_id().alias("p"), "__source_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r.p for r in got}) >= 8 and not any(r._corrupt_record for r in got)
    assert [int(r.Id) for r in sorted(got, key=lambda r: r["__source_pos"])] == list(range(n))


def test_same_rows_as_the_file_reader(spark, tmp_dir):
    spark.range(500).selectExpr("cast(id as string) Id", "named_struct('a', concat('x & <', id), 'b', if(id % 3 = 0, null, 'y')) U").repartition(3) \
        .write.format("xml").option("rowTag", "item").option("rootTag", "all").save(f"{tmp_dir}/x")
    ours = read_xml_split(spark, f"{tmp_dir}/x", "item").select("Id", "U.a", "U.b")
    theirs = read_xml(spark, f"{tmp_dir}/x", "item").select("Id", "U.a", "U.b")
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_empty_files_and_other_tags(spark, tmp_dir):
    _write(f"{tmp_dir}/e.xml", "")
    _write(f"{tmp_dir}/f.xml", "<e><other><Id>1</Id></other></e>")
    assert read_xml_split(spark, tmp_dir, "item", "Id string").count() == 0
    assert read_xml_split(spark, tmp_dir, "item").columns == ["_corrupt_record", "__source_file", "__source_pos"]
    assert ingest_responses(spark, tmp_dir, "item", "Id", schema=StructType([StructField("Id", StringType())])).count() == 0


def test_element_paths():
    assert element_paths("<item><a><b/><b>1</b></a><ns:c x='>'>t</ns:c></item>") >= {("a", False), ("a/b", True)}
    assert element_paths("<item><a></item>") == set() and element_paths("<item/>") == set() and element_paths("<item><a/></item><x/>") == set()
    assert element_paths("<item><!-- <z> --><![CDATA[<q>]]><a>1</a></item>") == {("a", False)}


def test_shapes_after_the_first_rows_are_found(spark, tmp_dir):
    """Rows like the first ones stay in the JVM; another shape anywhere still adds its elements."""
    plain = "".join(f"<item><Id>{i}</Id></item>" for i in range(200))
    _write(f"{tmp_dir}/a.xml", f"<e>{plain}<item><Id>200</Id><U><a>1</a><a>2</a></U></item><item x='>'><Id>201</Id><T>t</T></item><itemX><Id>9</Id></itemX></e>")
    df = read_xml_split(spark, tmp_dir, "item")
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields[:3]} == {"Id": "string", "T": "string", "U": "struct<a:array<string>>"}
    got = {r.Id: r for r in df.collect()}
    assert len(got) == 202 and got["200"].U.a == ["1", "2"] and got["201"].T == "t"


def test_plain_pieces_need_no_pattern(spark, tmp_dir):
    _write(f"{tmp_dir}/a.xml", "<e><item><Id>1</Id></item></e>")
    plan = read_xml_split(spark, tmp_dir, "item", "Id string")._jdf.queryExecution().optimizedPlan().toString()
    assert "locate(" not in plan and "split(value" in plan  # one cut in place of searches by character
