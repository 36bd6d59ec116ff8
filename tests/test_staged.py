"""Two-stage curtain aggregates."""

from conftest import fixture_path
from tessera.operators import staged
from tessera.sources import parsers, readers


def _curtain(spark):
    raw = readers.read_positional_csv(spark, fixture_path("curtain.csv"),
                                      ["StartedOn", "value", "face", "curtain"])
    return parsers.parse_curtain(raw)


def test_groups_always_above_inclusive(spark):
    out = {r["month"]: r["faces"] for r in
           staged.groups_always_above(_curtain(spark), 0.05).collect()}
    assert out == {2: ["N"], 3: ["S"]}


def test_single_record_keys_and_day_forms(spark):
    means = {(r["day"], r["month"], r["face"], r["curtain"]): r["mean_value"]
             for r in staged.key_means(_curtain(spark), ["day", "month", "face", "curtain"])
             .collect()}
    assert abs(means[(1, 2, "N", "up")] - 0.06) < 1e-12   # '01' and '1' are one day
    assert means[(4, 3, "S", "down")] == 0.9               # single reading


def test_two_stage_extremes_wide_and_long(spark):
    wide = {(r["month"], r["curtain"]): (r["max_mean"], r["min_mean"])
            for r in staged.two_stage_extremes(_curtain(spark)).collect()}
    assert wide[(2, "up")] == (0.06, 0.01)
    assert wide[(3, "down")] == (0.9, 0.9)
    long = staged.two_stage_extremes(_curtain(spark), long=True).collect()
    assert len(long) == 2 * len(wide)
    assert {r["kind"] for r in long} == {"max", "min"}


def test_groups_always_above_long_form(spark):
    rows = {(r["month"], r["face"]) for r in
            staged.groups_always_above(_curtain(spark), 0.05, as_list=False).collect()}
    assert rows == {(2, "N"), (3, "S")}
