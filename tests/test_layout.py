"""Bucketed layout: a join of two tables bucketed on the join key with the
same bucket count needs no exchange."""

import contextlib
import io

from conftest import SF_SMALL
from tessera.plans.tables import table
from tessera.sources import layout


def test_bucketed_join_has_no_exchange(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_quantity")
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey")
    layout.write_bucketed(li, "li_by_order", ["l_orderkey"], 8)
    layout.write_bucketed(o, "orders_by_order", ["o_orderkey"], 8)
    a, b = layout.read_table(spark, "li_by_order"), layout.read_table(spark, "orders_by_order")
    j = a.join(b, a.l_orderkey == b.o_orderkey).groupBy("o_custkey").sum("l_quantity")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        j.explain()
    plan = buf.getvalue()
    join_part = plan.split("SortMergeJoin")[1]
    assert "Exchange hashpartitioning(l_orderkey" not in join_part
    assert "Exchange hashpartitioning(o_orderkey" not in join_part
    assert j.count() == li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey").distinct().count()
