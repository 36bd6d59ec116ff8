"""Plan lint over every registered query: no cross products, no nested-loop
joins, no Python UDF operators, and pruned scans of the fact table."""

import contextlib
import io
import re

from tessera.plans import catalog

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF")
LINEITEM_COLUMNS = 11


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_no_forbidden_operators_and_pruned_scans(spark):
    bad = {}
    for name, fn in catalog.REGISTRY.items():
        if name in ("prequential_forest", "forest_accuracy", "logistic_accuracy",
                    "logistic_language", "forest_language"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        hits = [op for op in FORBIDDEN if op in plan]
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
            fields = [f.split(":")[0] for f in schema.split(",")]
            if sum(f.startswith("l_") for f in fields) >= LINEITEM_COLUMNS:
                hits.append("full lineitem scan")
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_plans_without_part_columns_do_not_scan_part(spark):
    for name in ("demand_scalar_matrix", "demand_scalar_long", "domain_scalar_values", "accounting_totals"):
        assert "/part.parquet" not in _plan(catalog.REGISTRY[name](spark, SF_SMALL)), name
