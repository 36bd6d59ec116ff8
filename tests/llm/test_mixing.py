import itertools
import random

from conftest import SF_SMALL

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import mixing, queries


def brute_targets(sizes, budget, weights, most=3):
    out, left, open_ = {}, float(budget), list(sizes)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if unit * weights[s] > most * sizes[s]]
        if not over:
            return out | {s: unit * weights[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def found_targets(spark, sizes, weights=None, budget=None):
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    return {r.source: r for r in mixing.targets(table, weights, budget=budget).collect()}


def test_targets_share_the_excess_again(spark):
    sizes, weights = {"a": 10, "b": 100, None: 1000}, {"a": 1.0, "b": 2.0, None: 3.0}
    got = found_targets(spark, sizes, weights)
    assert got["a"].target == 30 and got["b"].target == 300 and abs(got[None].target - 780) < 1e-9
    assert found_targets(spark, {"a": 0}, {"a": 1.0})["a"].target == 0.0
    order = found_targets(spark, {"b": 1, None: 1, "a": 1, "é": 1, "": 1})
    assert sorted(order, key=lambda s: order[s].number) == ["", "a", "b", "é", None]
    rng = random.Random(4)
    sizes = {f"s{i:02}": int(10 ** rng.uniform(0, 6)) for i in range(40)}
    weights = {s: float(i % 3 + 1) for i, s in enumerate(sizes)}
    got, want = found_targets(spark, sizes), brute_targets(sizes, sum(sizes.values()), weights)
    assert all(abs(got[s].target - want[s]) <= 1e-9 * want[s] for s in sizes)


def test_sources_past_the_broadcast_and_groups_of_overlaps(spark):
    """Many sources of their own beside overlapping ones, with and without broadcasts."""
    rows = [(i, [f"own{i % 700}"], "w " * (1 + i % 5)) for i in range(1400)] + \
        [(2000 + i, [f"left{i % 9}", f"right{i % 9}"] if i % 2 else [f"left{i % 9}"], "w " * 7) for i in range(90)] + \
        [(3000, [], "w w")]
    frame = spark.createDataFrame(rows, "doc_id long, source array<string>, text string")
    found = mixing.mix(frame).collect()
    assert len(found) == len(rows) and next(r.taken for r in found if r.doc_id == 3000) == 0
    sizes = {}
    for _, names, text in rows:
        for name in names:
            sizes[name] = sizes.get(name, 0) + len(text.split())
    weights = {s: float(i % 3 + 1) for i, s in enumerate(sorted(sizes))}
    goal = brute_targets(sizes, sum(len(t.split()) for _, _, t in rows), weights)
    taken = {}
    for r, (_, names, _) in zip(sorted(found, key=lambda r: r.doc_id), rows):
        assert r.repeats <= 3 and abs(r.target - sum(goal[s] for s in names)) < 1e-6
        if len(names) == 1 and names[0].startswith("own"):
            taken[names[0]] = taken.get(names[0], 0) + r.taken
    assert all(abs(taken[s] - goal[s]) <= 5 for s in taken) and len(taken) == 700
    before = mixing.MAX_BROADCAST
    mixing.MAX_BROADCAST = 3
    try:
        assert table_of(mixing.mix(frame)) == sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in found), key=repr)
    finally:
        mixing.MAX_BROADCAST = before


def brute_flow(supply, member_of, quota, most):
    """Cheapest largest flow by trying every split of small whole numbers."""
    best = None
    ranges = [itertools.product(*[range(q + 1) for q in quota]) for _ in supply]
    for split in itertools.product(*ranges):
        if any(f and s not in member_of[p] for p, row in enumerate(split) for s, f in enumerate(row)):
            continue
        given = [sum(row) for row in split]
        if any(g > most * n for g, n in zip(given, supply)):
            continue
        if any(sum(row[s] for row in split) > q for s, q in enumerate(quota)):
            continue
        cost = sum(sum(max(0, g - r * n) for r in range(1, most)) for g, n in zip(given, supply))
        key = (-sum(given), cost)
        best = key if best is None else min(best, key)
    return best


def test_flow_is_largest_and_cheapest():
    rng = random.Random(2)
    for _ in range(25):
        supply = [rng.randint(0, 2) for _ in range(3)]
        member_of = [rng.sample(range(2), rng.randint(1, 2)) for _ in range(3)]
        quota = [rng.randint(0, 3) for _ in range(2)]
        given = mixing.route(supply, member_of, quota, 3)
        cost = sum(sum(max(0, g - r * n) for r in range(1, 3)) for g, n in zip(given, supply))
        assert (-sum(given), cost) == brute_flow(supply, member_of, quota, 3)


def test_query_is_near_its_targets(spark):
    rows = queries.op5_mixing_sources(spark, SF_SMALL.replace("0.001", "0.01")).collect()
    by = {}
    for r in rows:
        assert r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"]
        by.setdefault((r.source_size, r.target), []).append(r)
    largest = max(r["size"] for r in rows)
    for (size, target), own in by.items():
        assert sum(r["size"] for r in own) % size == 0
        assert abs(sum(r.taken for r in own) - target * (sum(r["size"] for r in own) // size)) <= largest
    again = queries.op5_mixing_sources(spark, SF_SMALL.replace("0.001", "0.01"))
    assert table_of(again) == sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def test_edge_cases(spark, docs, no_docs):
    found = mixing.mix(with_clashes(docs).drop("size", "taken")).collect()
    sizes = sorted((len((r[1] or "").encode().split()) for r in edge_rows()))
    assert sorted(r["size"] for r in found) == sizes
    assert sum({(r.source_size, r.target): r.target for r in found}.values()) <= sum(sizes) + 1e-6
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = sorted(((r.doc_id, r["size"]) for r in found for _ in range(r.repeats)), key=repr)
    assert sorted(((r.doc_id, len((r.text or "").encode().split())) for r in mixed.collect()), key=repr) == want


def test_overlapping_sources(spark):
    rows = [(i, ["a"] if i % 3 else ["a", "b"], "w " * 10) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source array<string>, text string")
    found = mixing.mix(frame, weights={"a": 1.0, "b": 1.0}).collect()
    both = sum(r.taken for r in found if r.doc_id % 3 == 0)
    assert sum(r.taken for r in found) == 3000 and both >= 1490     # "b" is fed by the shared pattern alone
