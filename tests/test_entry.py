"""Driver contract and the Spark-vs-SQL oracle at the smallest scale."""

import __spark_entry__ as entry_mod
from tessera.plans import catalog

from conftest import SF_SMALL
from harness import run


def test_entry_and_registry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 60


FAST_ROWS_ONLY = {"prequential_forest", "forest_accuracy", "logistic_accuracy"}


def test_all_queries_match_oracle_small(spark):
    names = [n for n in catalog.REGISTRY if n not in FAST_ROWS_ONLY]
    res = run(spark, SF_SMALL, names)
    bad = {k: v for k, v in res.items() if not v[0]}
    assert not bad, bad
