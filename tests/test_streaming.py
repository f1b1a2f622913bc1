import os

from lakestrata.session import local_path
from lakestrata.streaming import standardize_stream


def _land(path, lines):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_processes_each_file_once(spark, tmp_dir):
    schema = "IdAndamento string, DataHora string"
    raw = f"{tmp_dir}/raw"
    target, ckpt = f"{tmp_dir}/std", f"{tmp_dir}/ckpt"
    _land(f"{raw}/20240101/a.json", ['{"IdAndamento": "1", "DataHora": "x"}', '{"IdAndamento": "2"}'])
    q = standardize_stream(spark, f"{raw}/*/*.json", spark.createDataFrame([], schema).schema, target,
                           checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 2
    _land(f"{raw}/20240102/b.json", ['{"IdAndamento": "3"}'])
    q = standardize_stream(spark, f"{raw}/*/*.json", spark.createDataFrame([], schema).schema, target,
                           checkpoint=ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(target)
    assert out.count() == 3
    assert {"source_file", "etl_versao"} <= set(out.columns)


def test_stream_goes_on_with_default_checkpoint(spark, tmp_dir):
    schema = spark.createDataFrame([], "k string").schema
    for name in ("a", "b"):
        _land(f"{tmp_dir}/in/{name}.json", [f'{{"k": "{name}"}}'])
        standardize_stream(spark, f"{tmp_dir}/in/*.json", schema, f"{tmp_dir}/out").awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["a", "b"]
