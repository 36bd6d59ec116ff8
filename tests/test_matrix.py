"""Demand matrices and per-location measures."""

import random

from pyspark.sql import functions as F

from conftest import fixture_path
from tessera import schemas
from tessera.operators import matrix
from tessera.operators.matrix import Measure
from tessera.sources import parsers, readers

CITIES = ["Tel Aviv", "Jerusalem", "Haifa", "Tiberias", "Eilat"]


def _users(spark):
    return parsers.parse_users(readers.read_csv_quoted(spark, fixture_path("users.csv"),
                                                       schemas.USERS_RAW))


def _tickets(spark):
    return parsers.parse_tickets(readers.read_csv_quoted(spark, fixture_path("tickets.csv"),
                                                         schemas.TICKETS_RAW))


def _searches(spark):
    return parsers.parse_searches(readers.read_csv_quoted(spark, fixture_path("queries.csv"),
                                                          schemas.SEARCHES_RAW))


def _by_loc(df):
    return {r["user_location"]: r.asDict() for r in df.collect()}


def test_volume_both_unmatched_sides(spark):
    out = _by_loc(matrix.volume_by_location(_tickets(spark), _users(spark), units="n_tickets",
                                            fact_key="user_id"))
    assert out["Haifa"]["n_rows"] == 3 and out["Haifa"]["units"] == 3   # user 4 adds a row
    assert out["Eilat"]["units"] == 5
    assert out["Jerusalem"]["n_rows"] == 1 and out["Jerusalem"]["units"] is None
    assert out[None]["n_rows"] == 1 and out[None]["units"] == 4          # unknown user 99
    assert sum(r["n_rows"] for r in out.values()) == 6


def test_measure_matrix_zero_for_unmatched_user(spark):
    out = _by_loc(matrix.demand_matrix(_tickets(spark), _users(spark), "city", CITIES,
                                       mode="measure", measure="n_tickets", fact_key="user_id"))
    assert out["Haifa"]["Haifa"] == 2 and out["Haifa"]["Tiberias"] == 1
    assert out["Haifa"]["Eilat"] == 0
    assert out["Jerusalem"]["Jerusalem"] is None and out["Jerusalem"]["Haifa"] == 0
    assert out[None]["Tel Aviv"] == 4


def test_array_matrix_and_null_cells(spark):
    users = _users(spark).unionByName(spark.createDataFrame([(5, "Gesher")], "id int, user_location string"))
    out = _by_loc(matrix.demand_matrix(_searches(spark), users, "cities", CITIES))
    assert out["Haifa"]["Haifa"] == 1 and out["Haifa"]["Tiberias"] == 1
    assert out["Jerusalem"]["Tel Aviv"] == 1 and out["Jerusalem"]["Jerusalem"] == 1
    assert out["Gesher"]["Haifa"] is None            # location without any facts


def test_presence_rate_and_share(spark):
    out = _by_loc(matrix.presence_rate(_searches(spark), _users(spark), ["actors", "director"]))
    assert out["Haifa"]["has_actors"] == 1.0 and out["Haifa"]["has_director"] == 0.0
    assert out["Jerusalem"]["has_actors"] == 0.0 and out["Jerusalem"]["has_director"] == 1.0
    share = matrix.share_with_value(_searches(spark), "lang", "fr").first()["share"]
    assert abs(share - 1 / 3) < 1e-12


def test_domains_and_bounded_collect(spark):
    dom = matrix.array_domain(_searches(spark), "genres")
    assert matrix.collect_domain(dom) == ["Action", "Drama", "Family"]
    try:
        matrix.collect_domain(dom, max_values=2)
    except ValueError:
        pass
    else:
        raise AssertionError("domain above the bound must be refused")


def _random_facts(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rnd.random() < 0.35 else rnd.choice([None] + list(range(1, 60)))
        arr = None if rnd.random() < 0.05 else rnd.sample(["a", "b", "c", "d"], rnd.randint(0, 3))
        val = None if rnd.random() < 0.05 else float(rnd.randint(0, 9))
        rows.append((user, arr, val, rnd.choice(["p", "q", None])))
    return spark.createDataFrame(rows, "id int, arr array<string>, v double, s string")


def test_eager_aggregation_equals_row_level_join(spark):
    """Brute force: the per-user pre-aggregated plan must equal the naive
    row-level FULL OUTER join, with a hot user (35 % of rows), NULL keys,
    NULL arrays/values and a duplicated user id in the dimension."""
    facts = _random_facts(spark)
    users = spark.createDataFrame(
        [(i, f"L{i % 4}") for i in range(0, 80, 2)] + [(4, "L9")] + [(70, None)],
        "id int, user_location string")
    ms = [Measure("rows", "rows"), Measure("sum_v", "sum", F.col("v")),
          Measure("avg_v", "avg", F.col("v")),
          Measure("has_a", "sum", F.array_contains("arr", "a").cast("int")),
          Measure("p_or_zero", "sum_or_zero", F.when(F.col("s") == "p", F.col("v")).otherwise(0))]
    got = {r[0]: tuple(r[1:]) for r in
           matrix.per_location(facts, users, ms).orderBy("user_location").collect()}
    j = facts.join(users, facts.id == users.id, "full_outer")
    naive = j.groupBy("user_location").agg(
        F.count(F.lit(1)), F.sum("v"), F.avg("v"),
        F.sum(F.array_contains("arr", "a").cast("int")),
        F.sum(F.when(F.col("s") == "p", F.col("v")).otherwise(0)))
    want = {r[0]: tuple(r[1:]) for r in naive.collect()}
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(got[k], want[k]):
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, got[k], want[k])


def test_macro_average(spark):
    out = matrix.demand_profile(_searches(spark), _users(spark), "genres", ["Drama"]).first()
    # per location: Haifa 1.0 (user 4 ignored), Eilat 0.0, Jerusalem 1.0 -> mean 2/3
    assert abs(out["Drama"] - 2 / 3) < 1e-12


def test_long_form_equals_row_level_brute_force(spark):
    """demand_long (per user-and-value partials, then the join) equals a
    row-level count over distinct values per fact row."""
    facts = _random_facts(spark, seed=9).withColumn(
        "arr", F.when(F.col("arr").isNotNull(), F.concat("arr", "arr")))   # duplicates inside
    users = spark.createDataFrame([(i, f"L{i % 3}") for i in range(0, 50)],
                                  "id int, user_location string")
    got = {(r[0], r[1]): r[2] for r in matrix.demand_long(facts, users, "arr").collect()}
    rows = facts.select("id", F.explode(F.array_distinct("arr")).alias("value")) \
        .join(users, "id", "left").groupBy("user_location", "value").count().collect()
    want = {(r[0], r[1]): r[2] for r in rows}
    assert got == want


def test_two_level_numeric_sums_equal_row_level(spark):
    from tessera.operators import aggregates as agg
    facts = _random_facts(spark, seed=13).select("id", "v", F.col("id").alias("w"))
    users = spark.createDataFrame([(i, f"L{i % 4}") for i in range(0, 40)],
                                  "id int, user_location string")
    per_user = agg.sum_numeric(facts.withColumnRenamed("id", "uid"), ["uid"], prefix="")
    eager = agg.sum_numeric(per_user.join(users, F.col("uid") == F.col("id"), "left")
                            .select("user_location", "v", "w"), ["user_location"])
    naive = agg.sum_numeric(facts.join(users, "id", "left").select("user_location", "v", "w"),
                            ["user_location"])
    as_map = lambda df: {r[0]: tuple(r[1:]) for r in df.collect()}
    assert as_map(eager) == as_map(naive)
