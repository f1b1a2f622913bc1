import json

from lakestrata.__main__ import main
from lakestrata.sinks import write_parquet
from lakestrata.sources import LakeLayout


def test_cli_standardize_refine_facts(spark, tmp_dir, capsys):
    lake = LakeLayout(tmp_dir)
    moves = spark.createDataFrame(
        [("m1", "C1", "10", "2", "10/01/2024 08:00:00"), ("m2", "C1", "10", "2", "09/01/2024 08:00:00")],
        "IdAndamento string, IdProcedimentoFormatado string, Unidade string, IdTarefa string, DataHora string")
    moves.write.mode("overwrite").json(lake.raw("casework", "movements", "20240131"))
    assert main(["standardize", "--root", tmp_dir, "--type", "json", "--date", "20240131"], spark) == 0
    status = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert status[0]["endpoint"] == "movements" and status[0]["n_rows"] == 2

    spec = f"{tmp_dir.replace('file:', '')}/spec.json"
    import os
    os.makedirs(os.path.dirname(spec), exist_ok=True)
    with open(spec, "w") as fh:
        json.dump({"rename": {"IdTarefa": "IdTarefa"}}, fh)
    assert main(["refine-dim", "--root", tmp_dir, "--area", "casework", "--endpoint", "movements",
                 "--table", "dim_movements", "--spec", spec], spark) == 0
    capsys.readouterr()
    write_parquet(spark.createDataFrame([("10", "SECAD")], "IdUnidade string, Sigla string"),
                  lake.refined("casework", "dim_units"))
    write_parquet(spark.createDataFrame([("p1", "C1", "T1")],
                                        "IdProcedimento string, ProcedimentoFormatado string, TipoProcedimento string"),
                  lake.refined("casework", "dim_cases"))
    write_parquet(spark.createDataFrame([("T1", "Contrato")], "IdTipoProcedimento string, Nome string"),
                  lake.refined("casework", "dim_case_types"))
    assert main(["facts", "--root", tmp_dir, "--movements", "casework:dim_movements", "--units", "casework:dim_units",
                 "--cases", "casework:dim_cases", "--case-types", "casework:dim_case_types",
                 "--out-area", "stalled", "--as-of", "2024-01-31"], spark) == 0
    paths = json.loads(capsys.readouterr().out)
    rows = spark.read.parquet(paths["stalled_cases"]).collect()
    assert [(r.IdProcedimentoFormatado, r.Sigla, r.tipo, r.Dias_Sem_Movimentacao) for r in rows] == \
        [("C1", "SECAD", "Contrato", 21)]
