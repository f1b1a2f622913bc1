"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from tools.oracle_check import check

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_queries_match_oracle(spark):
    results = check(spark, SF, log=lambda *_: None)
    failing = [(n, m) for n, ok, m in results if not ok]
    assert not failing, failing
    assert len(results) >= 40


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["IdProcedimentoFormatado", "Sigla", "tipo", "Dias_Sem_Movimentacao"]
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
