"""Numbers, ranks and codes against plain Python sorts; growing dictionary; skew-safe outer join."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import matrix, outer, profile, ranking
from tessera.session import scratch_path
from tessera.streaming.dictionary import GrowingDictionary


def _rows(n=700, seed=1):
    """A third of the rows share one value; some are NULL or repeated."""
    rnd = random.Random(seed)
    return [(i % 650, "hot" if rnd.random() < 0.35 else rnd.choice([None, f"v{rnd.randrange(40)}"]), rnd.randrange(9))
            for i in range(n)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), "id int, v string, k int").repartition(5)


def test_numbers_follow_the_order(table):
    got = ranking.numbered(table, [F.asc_nulls_last("v"), F.desc("k")], "no", ranges=7).collect()
    assert sorted(r.no for r in got) == list(range(700))
    key = lambda r: (r[1] is None, r[1] or "", -r[2])
    assert [key(r) for r in sorted(got, key=lambda r: r.no)] == sorted(map(key, _rows()))
    assert ranking.numbered(table.limit(0), ["v"]).count() == 0


def test_a_hot_key_is_spread_over_ranges(table):
    plan = ranking.numbered(table, ["v"], "no", ranges=8)._jdf.queryExecution().toString()
    assert "Window" not in plan                                    # no window at all without weights
    dealt = table.repartitionByRange(8, "v", F.xxhash64("id", "v", "k")).select(F.spark_partition_id().alias("p"))
    assert max(Counter(r.p for r in dealt.collect()).values()) < 2 * 700 / 8


def test_ranks(table):
    got = sorted((r.v is None, r.v or "", r["rank"], r["dense_rank"]) for r in ranking.ranked(table, "v").collect())
    keys = sorted((v is None, v or "") for _, v, _ in _rows())
    dense = {k: i + 1 for i, k in enumerate(sorted(set(keys)))}
    assert got == [(*k, keys.index(k) + 1, dense[k]) for k in keys]


def test_codes_and_pages(table):
    counts = Counter(v for _, v, _ in _rows() if v is not None)
    order = sorted(counts, key=lambda v: (-counts[v], v))
    codes = ranking.value_codes(table, "v")
    assert {r.value: r.code for r in codes.collect()} == {v: i for i, v in enumerate(order)}
    coded = ranking.with_codes(table, "v", codes).collect()
    assert len(coded) == 700 and all((r.code is None) == (r.v is None) for r in coded)
    page = ranking.page(table, [F.asc("id"), F.asc("v"), F.asc("k")], 11, 5).collect()
    assert sorted(r.position for r in page) == [11, 12, 13, 14, 15]


def test_dictionary_grows_and_replays(spark):
    books = GrowingDictionary(spark, scratch_path(spark, "codes"), "v")
    batches = [spark.createDataFrame([(x,) for x in xs], "v string") for xs in
               (["b", "a", "b", None], ["c", "a"], [None], ["aa", "c", "z"])]
    for epoch, batch in enumerate(batches):
        books.extend(batch, epoch)
    want = {"a": 0, "b": 1, "c": 2, "aa": 3, "z": 4}
    assert {r.value: r.code for r in books.codes().collect()} == want
    assert books.extend(batches[1], 1) == 1 and books.extend(batches[0], 0) == 2      # a replay in any order
    assert {r.value: r.code for r in books.codes().collect()} == want
    assert {r.v: r.code for r in books.encode(batches[3], before=1).collect()} == {"aa": None, "c": None, "z": None}
    assert books.size() == 5 and books.size(before=1) == 2


def test_a_batch_of_many_blocks_numbers_as_block_by_block(spark):
    rows = spark.createDataFrame([(2, "a"), (0, "z"), (0, "m"), (1, "b"), (1, "z"), (2, None), (5, "aa"), (2, "c")],
                                 "block int, v string")
    one = GrowingDictionary(spark, scratch_path(spark, "codes"), "v")
    for epoch in range(6):
        one.extend(rows.where(F.col("block") == epoch), epoch)
    whole = GrowingDictionary(spark, scratch_path(spark, "codes"), "v")
    assert whole.extend(rows, 0, by="block") == 6
    assert sorted(whole.codes().collect()) == sorted(one.codes().collect())


def _outer(left, right):
    out = [(*a, *b) for a in left for b in right if a[0] is not None and a[0] == b[0]]
    out += [(*a, None, None) for a in left if not any(a[0] is not None and a[0] == b[0] for b in right)]
    return sorted(out + [(None, None, *b) for b in right if not any(b[0] is not None and b[0] == a[0] for a in left)], key=repr)


def test_outer_join_with_hot_and_null_keys(spark):
    rnd = random.Random(4)
    left = [(7 if rnd.random() < 0.35 else rnd.choice([None, rnd.randrange(60)]), i) for i in range(600)]
    right = [(k, f"u{k}") for k in [None, 7, 7, *range(20, 90)]]
    a, b = spark.createDataFrame(left, "k int, i int"), spark.createDataFrame(right, "u int, name string")
    assert sorted(map(tuple, outer.full_outer(a, b, "k", "u").collect()), key=repr) == _outer(left, right)
    none = a.limit(0)
    assert sorted(map(tuple, outer.full_outer(none, b, "k", "u").collect()), key=repr) == _outer([], right)
    with pytest.raises(ValueError):
        outer.full_outer(a, a, "k", "k")


def test_no_task_gets_the_hot_key(spark):
    """A third of the rows on one key: after the salt no partition of the hot join is far above the mean."""
    a = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), "id")
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)).alias("salt")
    hot = a.where("k = 7").select("k", salt).repartition(8, "k", "salt").select(F.spark_partition_id().alias("p"))
    sizes = Counter(r.p for r in hot.collect())
    assert max(sizes.values()) < 2 * sum(sizes.values()) / 8


def test_first_seen_order(spark):
    rows = spark.createDataFrame([(2, ["b", "a"]), (1, ["c", "", "b"]), (3, None)], "at int, xs array<string>")
    got = matrix.first_seen_domain(rows, "xs", ["at"]).collect()
    assert [r.value for r in sorted(got, key=lambda r: r.place)] == ["c", "b", "a"]


def test_sparse_demand_rows_of_many_values(spark):
    """5,000 values, none of them on the driver; NULL lists, unknown users and users without facts."""
    facts = spark.range(5000).select((F.col("id") % 7).alias("id"), F.array(F.col("id").cast("string"), F.lit("x")).alias("vs")) \
        .unionByName(spark.createDataFrame([(1, None), (99, ["x"])], "id long, vs array<string>"))
    users = spark.createDataFrame([(i, "north" if i < 4 else "south") for i in range(8)], "id long, user_location string")
    got = {r.user_location: r for r in matrix.demand_rows(facts, users, "vs").collect()}
    assert sum(len(r.cells) for r in got.values()) == 5000 + 3
    north = {c.value: (c.n, c.average) for c in got["north"].cells}
    facts_north = sum(1 for i in range(5000) if i % 7 < 4)
    assert north["x"] == (facts_north, facts_north / (facts_north + 1)) and got["north"].n_rows == facts_north + 1
    assert got["south"].n_rows == 5000 - facts_north + 1                  # user 7 has no facts
    assert [tuple(c) for c in got[None].cells] == [("x", 1, 1.0)]
    assert [c.value for c in got["south"].cells] == sorted(c.value for c in got["south"].cells)


def test_stored_sketches_merge(spark):
    rows = spark.range(60_000).select((F.col("id") % 5).alias("day"), (F.col("id") % 20_000).alias("u"))
    path = scratch_path(spark, "sketches")
    profile.distinct_sketches(rows, ["day"], "u", bits=12).write.parquet(path)
    n = profile.merged_distinct(spark.read.parquet(path), []).first()[0]
    assert abs(n - 20_000) < 0.03 * 20_000
