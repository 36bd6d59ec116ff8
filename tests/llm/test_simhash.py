from collections import defaultdict

import pytest
import xxhash
from conftest import SF_SMALL

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import graph, queries, simhash


def brute_fingerprint(text, size=3):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows, most):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= most:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[root(f)].append(i)
    return sorted(((i, f"{f:016x}", min(least[root(f)], default=None)) for i, f in prints), key=repr)


def as_rows(df):
    return sorted(((r[0], f"{r[1] & (2 ** 64 - 1):016x}", r[2]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert table_of(queries.op1_simhash_near_duplicates(spark, SF_SMALL)) == brute_components(rows, 2)


def test_edge_cases_and_clashing_columns(spark, docs, no_docs):
    want = brute_components([r[:2] for r in edge_rows()], 2)
    assert as_rows(simhash.near_duplicates(with_clashes(docs))) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_representatives(no_docs).count() == 0


@pytest.mark.parametrize("most,limit", [(1, 32), (2, 32), (2, 2), (3, 2), (4, 4)])
def test_links_connect_all_within_the_distance(spark, most, limit):
    """Random and crowded fingerprints; a low pair limit sends crowded cells the other way."""
    import random
    rng = random.Random(most * 10 + limit)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(40)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in graph.connected_components(
        simhash.links(frame, most, limit)).collect()}
    parent = {p: p for p in signed}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= most:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {p: found.get(p, p) for p in signed} == {p: root(p) for p in signed}


def test_components_of_a_long_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (-5, -9)]
    found = {r.node: r.root for r in graph.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 200: 200, 201: 200, -5: -9, -9: -9}


def test_one_representative_per_group(spark, docs):
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute_components([r[:2] for r in edge_rows()], 2) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_different_texts_of_one_id_each_have_a_representative(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b", "c")]
    rows = [(1, texts[0], "x"), (1, texts[1], "y"), (1, texts[1], "y"), (2, texts[0], "z"), (3, texts[2], "x"),
            (1, texts[0], "w")]
    frames = [spark.createDataFrame(r, "doc_id long, text string, source string").repartition(n)
              for r, n in ((rows, 1), (rows[::-1], 4))]
    kept = [sorted(tuple(r) for r in simhash.keep_representatives(f).collect()) for f in frames]
    assert kept[0] == kept[1]
    assert sorted(t for _, t, _ in kept[0]) == sorted(texts) and [i for i, _, _ in kept[0]] == [1, 1, 3]


def test_exploded_tables_are_not_broadcast(spark, monkeypatch):
    """At Spark's own threshold a table of cells looks as small as the fingerprints it comes from."""
    plans, stored = [], simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, name: plans.append(df) or stored(df, name))
    prints = stored(spark.range(200).selectExpr("id % 100 AS fp").distinct(), "prints")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        plans.append(simhash.links(prints, 2, 3))
        told = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(told) == 2 and all("SortMergeJoin" in t and "BroadcastExchange" not in t for t in told)


def test_the_dedup_stage_broadcasts_no_cells(spark, docs, monkeypatch):
    """The stage of the pipeline, planned with Spark's own threshold."""
    plans, stored = [], simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, name: stored(df, name) if name != "cells" else
                        plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, name))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        kept = simhash.keep_representatives(docs).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert kept and len(plans) == 1 and "BroadcastExchange" not in plans[0]
