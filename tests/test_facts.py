"""Stalled-case facts on a hand-made star with the source system's column names and the
default literal filters (task '2', excluded unit, the case-type list)."""

import pytest

from lakestrata.plans import stalled_by_type, stalled_by_unit, stalled_cases
from lakestrata.plans.layers import refine_stalled_facts
from lakestrata.sinks import write_parquet
from lakestrata.sources import LakeLayout

MOVES = [
    ("m1", "C1", "10", "u", "2", "10/01/2024 08:00:00"),   # tie at the latest time
    ("m2", "C1", "10", "u", "2", "10/01/2024 08:00:00"),   # tie at the latest time
    ("m3", "C1", "10", "u", "2", "05/01/2024 08:00:00"),   # older row of the same pair
    ("m4", "C1", "20", "u", "2", "03/01/2024 09:00:00"),   # second unit for the same case
    ("m5", "C1", "20", "u", "7", "20/01/2024 09:00:00"),   # another task code
    ("m6", "C2", "10", "u", "2", "99/99/2024 00:00:00"),   # unparsable time
    ("m6b", "C2", "10", "u", "2", "01/01/2024 00:00:00"),
    ("m7", "C4", "10", "u", "2", "01/02/2024 00:00:00"),   # case missing from cases
    ("m8", "C2", None, "u", "2", "02/01/2024 00:00:00"),   # null unit
    ("m9", "C2", "30", "u", "2", "02/01/2024 00:00:00"),   # unit with a null name
    ("m10", "C2", "40", "u", "2", "02/01/2024 00:00:00"),  # the excluded unit
    ("m11", "C3", "10", "u", "2", "02/01/2024 00:00:00"),  # type outside the list
    ("m12", "C1", "30", "u", "2", "not a time"),           # a group with no valid time at all
    ("m13", "C2", "20", "u", "2", "31/02/2024 00:00:00"),  # idem, eligible unit and case
]
MOVE_SCHEMA = ("IdAndamento string, IdProcedimentoFormatado string, Unidade string, Usuario string, "
               "IdTarefa string, DataHora string")


@pytest.fixture()
def star(spark):
    movements = spark.createDataFrame(MOVES, MOVE_SCHEMA)
    units = spark.createDataFrame([("10", "SECAD"), ("20", "SEFIN"), ("30", None), ("40", "AL-SAI")],
                                  "IdUnidade string, Sigla string")
    cases = spark.createDataFrame([("p1", "C1", "T1"), ("p2", "C2", "T2"), ("p3", "C3", "T9")],
                                  "IdProcedimento string, ProcedimentoFormatado string, TipoProcedimento string")
    types = spark.createDataFrame([("T1", "Contrato"), ("T2", "Licitação"), ("T9", "Outro tipo")],
                                  "IdTipoProcedimento string, Nome string")
    return movements, units, cases, types


EXPECTED = sorted([("C1", "SECAD", "Contrato", 21), ("C1", "SECAD", "Contrato", 21),
                   ("C1", "SEFIN", "Contrato", 28), ("C2", "SECAD", "Licitação", 30)])


@pytest.mark.parametrize("method", ["window", "join_back"])
def test_stalled_cases(star, method):
    out = stalled_cases(*star, as_of="2024-01-31", method=method)
    assert out.columns == ["IdProcedimentoFormatado", "Sigla", "tipo", "Dias_Sem_Movimentacao"]
    assert sorted(map(tuple, out.collect())) == EXPECTED


def test_sorted_latest_first(star):
    out = stalled_cases(*star, as_of="2024-01-31", sort_latest_first=True).collect()
    assert [r.Dias_Sem_Movimentacao for r in out] == [21, 21, 28, 30]


def test_counts_are_rows_after_joins(star):
    by_unit = {r.Setor: r.qtd for r in stalled_by_unit(*star).collect()}
    by_type = {r.tipo: r.qtd for r in stalled_by_type(*star).collect()}
    assert by_unit == {"SECAD": 3, "SEFIN": 1}
    assert by_type == {"Contrato": 3, "Licitação": 1}


def test_duplicate_dimension_keys_fan_out(spark, star):
    movements, units, cases, types = star
    doubled = units.union(units.where("IdUnidade = '20'"))
    by_unit = {r.Setor: r.qtd for r in stalled_by_unit(movements, doubled, cases, types).collect()}
    assert by_unit == {"SECAD": 3, "SEFIN": 2}


def test_refine_facts_pipeline(spark, star, tmp_dir):
    lake = LakeLayout(tmp_dir)
    names = {"movements": "dim_andamentos", "units": "dim_unidades", "cases": "dim_procedimentos",
             "case_types": "dim_tipo_procedimentos"}
    for (role, table), df in zip(names.items(), star):
        write_parquet(df, lake.refined("casework", table))
    paths = refine_stalled_facts(spark, lake, {r: ("casework", t) for r, t in names.items()}, "stalled",
                                 as_of="2024-01-31", load_ts="2024-02-01 00:00:00")
    facts = spark.read.parquet(paths["stalled_cases"])
    assert sorted(tuple(r)[:4] for r in facts.collect()) == EXPECTED
    assert "etl_versao" in facts.columns
    assert spark.read.parquet(paths["stalled_by_unit"]).count() == 2


def test_hot_group_of_copies(spark, star):
    """One (unit, case) holding most rows, all tied: the counts stay whole and the default
    plan has no window (no task buffers the group)."""
    movements, units, cases, types = star
    hot = spark.range(3000).selectExpr(
        "concat('h', id) AS IdAndamento", "'C1' AS IdProcedimentoFormatado", "'10' AS Unidade",
        "'u' AS Usuario", "'2' AS IdTarefa", "'10/01/2024 08:00:00' AS DataHora")
    many = movements.unionByName(hot)
    by_unit = {r.Setor: r.qtd for r in stalled_by_unit(many, units, cases, types).collect()}
    assert by_unit == {"SECAD": 3003, "SEFIN": 1}
    detail = stalled_cases(many, units, cases, types, as_of="2024-01-31", sort_latest_first=True)
    assert detail.count() == 3004
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_three_plans_agree_on_random_stars(spark, seed):
    import random

    rnd = random.Random(seed)
    times = ["01/01/2024 00:00:00", "02/01/2024 00:00:00", "02/01/2024 00:00:00", "bad", None]
    moves = [(f"m{i}", rnd.choice(["C1", "C2", "C3", "C4", None]), rnd.choice(["10", "20", "30", "40", None]),
              "u", rnd.choice(["2", "2", "7"]), rnd.choice(times)) for i in range(400)]
    movements = spark.createDataFrame(moves, MOVE_SCHEMA)
    units = spark.createDataFrame([("10", "SECAD"), ("20", "SEFIN"), ("20", "SEFIN2"), ("30", None), ("40", "AL-SAI")],
                                  "IdUnidade string, Sigla string")
    cases = spark.createDataFrame([("p1", "C1", "T1"), ("p2", "C2", "T2"), ("p2b", "C2", "T1"), ("p3", "C3", "T9")],
                                  "IdProcedimento string, ProcedimentoFormatado string, TipoProcedimento string")
    types = spark.createDataFrame([("T1", "Contrato"), ("T2", "Licitação"), ("T9", "Outro tipo")],
                                  "IdTipoProcedimento string, Nome string")
    results = [sorted(map(tuple, stalled_cases(movements, units, cases, types, as_of="2024-02-01",
                                               method=m).collect()))
               for m in ("aggregate", "window", "join_back")]
    assert results[0] == results[1] == results[2] and len(results[0]) > 0


def test_sorted_copies_are_not_sorted_again(spark):
    """Ordered copies of a hot row come from small chunks that are sorted before they are expanded."""
    from pyspark.sql import functions as F

    from lakestrata.operators.relational import SORTED_CHUNK, replicate_rows

    n = 40 * SORTED_CHUNK + 7
    df = spark.createDataFrame([(1, n), (2, 3), (3, 0), (None, 2)], "k int, n bigint")
    out = replicate_rows(df, "n", sort_by=[F.col("k").desc()], row_id="rid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Sort") < plan.index("rangepartitioning")  # from the top: expanded after the sort
    assert "REPARTITION_BY_NUM" in plan
    got = out.withColumn("p", F.spark_partition_id()).collect()
    assert [(r.k, r.rid) for r in got] == [(2, i) for i in range(3)] + [(1, i) for i in range(n)] + [(None, i) for i in range(2)]
    assert len({r.p for r in got if r.k == 1}) > 1
