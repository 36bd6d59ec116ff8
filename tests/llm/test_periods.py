import hashlib
import random
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import periods, queries


def brute_runs(w, exponent=4, shortest=6):
    """Every maximal stretch by comparing the words with themselves at each distance."""
    found, n = [], len(w)
    for q in range(1, n // exponent + 1):
        b = 0
        while b + q < n:
            e = b
            while e + q < n and w[e] == w[e + q]:
                e += 1
            length = e + q - b
            if length >= max(shortest, exponent * q) and not any(
                    all(w[i] == w[i + p] for i in range(b, b + length - p)) for p in range(1, q)):
                found.append((b, length, q))
            b = e + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def edited(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    w = edited(doc_id, text)
    runs = brute_runs(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(brute_collapsed(w, runs)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=4))
def test_small_alphabets(texts):
    assert periods.runs_of(texts) == [brute_runs(w) for w in texts]


def planted(rng, depth):
    """Nested repetitions: a string of strings repeated, with noise between."""
    if not depth:
        return [rng.choice([b"a", b"b", b"x%d" % rng.randrange(40)]) for _ in range(rng.randrange(1, 7))]
    out = []
    for _ in range(rng.randrange(1, 4)):
        out += planted(rng, depth - 1) * rng.choice([1, 1, 2, 3, 4, 5, 9])
    return out


def test_nested_and_long_periods():
    rng = random.Random(5)
    texts = [planted(rng, rng.randrange(1, 4))[:700] for _ in range(150)]
    for p in (9, 10, 21, 22, 45, 46, 93, 94, 130):       # on both sides of each scale's periods
        unit = [b"u%d" % rng.randrange(5) for _ in range(p)]
        texts.append([b"l"] * 7 + (unit * 6)[:4 * p + rng.randrange(3)] + [b"r"])
        texts.append((unit * 4)[:4 * p - 1])
        texts.append((([b"a"] * (p - 1) + [b"b"]) * 5)[:4 * p + 1])
    want = [brute_runs(w) for w in texts]
    assert sum(map(len, want)) > 300 and max(r[2] for own in want for r in own) >= 130
    assert periods.runs_of(texts) == want
    assert [periods.collapsed(w, r) for w, r in zip(texts, want)] == [brute_collapsed(w, r) for w, r in zip(texts, want)]
    assert periods.runs_of(texts, exponent=3, shortest=1) == [brute_runs(w, 3, 1) for w in texts]


def test_synchronising_set_is_consistent_and_dense():
    rng = random.Random(1)
    w = [rng.randrange(3) for _ in range(3000)] + [7] * 100 + [rng.randrange(3) for _ in range(500)]
    ids = np.array(w + [-1], dtype=np.int64)
    h = periods._mixed(ids.view(np.uint64), ids.view(np.uint64))
    t = 1
    while t < 8:
        h, t = periods._doubled(h, t), 2 * t
    regions = [r for r in periods.regions_of(ids, [len(w)]) if 3 * r[2] <= t]
    members = set(periods.synchronising_set(h, t, periods._omitted(regions, t, len(h))).tolist())
    by_context = {}
    for i in range(len(w) - 2 * t):
        by_context.setdefault(tuple(w[i:i + 2 * t]), set()).add(i in members)
    assert all(len(v) == 1 for v in by_context.values())
    for i in range(len(w) - 3 * t):
        part = w[i:i + 3 * t - 1]
        if not any(part[p:] == part[:-p] for p in range(1, t // 3 + 1)):
            assert members & set(range(i, i + t))


def test_very_long_text_is_near_linear():
    text = [b"w%d" % (i % 1000) for i in range(300_000)] + [b"z"] * 300_000
    assert periods.runs_of([text]) == [[(0, 300_000, 1000), (300_000, 300_000, 1)]]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF_SMALL).collect()}
    assert found == {r.doc_id: expected(r.doc_id, r.text) for r in rows}
    assert sum(1 for r in found.values() if r[1]) > 10


def test_edge_cases(spark, docs, no_docs):
    rows = [r[:2] for r in edge_rows() if r[0] != 7]
    found = periods.find_runs(with_clashes(docs).filter("doc_id is null or doc_id <> 7"))
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed.encode()) for r in found.collect()]
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        runs = brute_runs(w)
        want.append((i, len(w), runs, brute_collapsed(w, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periods.find_runs(no_docs).count() == 0
    named = spark.createDataFrame([("k", "a b " * 9)], "doc_id string, text string")
    assert table_of(periods.find_runs(named).select("doc_id", "runs.period")) == [("k", [2])]
    broken = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF2061FF2061FF2061FF2061FF2061FF') AS STRING) AS text")
    assert periods.find_runs(broken).first().runs[0].length == 6
