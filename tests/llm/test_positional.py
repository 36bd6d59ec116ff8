import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given
from hypothesis import strategies as st

from llm.conftest import edge_rows, prose, with_clashes
from tessera.llm import positional, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window=10, slop=2):
    """(id, n_words, n_hit, items, near) per row, by looking at every place."""
    texts = [(i, words_of(t)) for i, t in rows]
    counts = Counter(w for _, ws in texts for w in ws)
    phrases = []
    for i, t in items:
        w = words_of(t)
        phrases += [(i, w[k:k + window]) for k in range(max(1, len(w) - window + 1)) if w]
    out = []
    for i, ws in texts:
        hit, found, near = set(), set(), set()
        for item, ph in phrases:
            starts = [k for k in range(len(ws) - len(ph) + 1) if ws[k:k + len(ph)] == ph]
            hit.update(k + o for k in starts for o in range(len(ph)))
            if starts:
                found.add(item)
            anchor = min(range(len(ph)), key=lambda o: (counts[ph[o]], o))
            for k in (at - anchor for at, w in enumerate(ws) if w == ph[anchor]):
                if all(p in ws[max(0, k + o - slop):max(0, k + o + slop + 1)] for o, p in enumerate(ph)):
                    near.add(item)
        out.append((i, len(ws), len(hit), frozenset(found), frozenset(near)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, frozenset(r["items"]), frozenset(r.near)) for r in df.collect()), key=repr)


@given(st.lists(st.integers(0, 1 << 40)))
def test_positions_round_trip(values):
    a = np.array(values, dtype=np.int64)
    data, ends = positional.encode(a)
    assert len(ends) == len(a) and (positional.decode(data) == a).all()


ITEMS = [(1, prose(14, 1)), (2, "one two"), (3, ""), (4, None), (5, "!!"), (None, prose(12, 9)),
         (1, prose(14, 1)), (1, prose(11, 21)), (6, " ".join(["b"] * 12)), (7, "Größe, NAÏVE x"), (8, prose(40, 3))]


@pytest.fixture(scope="module")
def corpus(spark):
    moved = prose(14, 1).split()
    moved[4], moved[5] = moved[5], moved[4]                 # a proximity match only
    extra = [(50, "so " + " ".join(moved) + " end"), (51, "b " * 40), (52, "B b b, b-b.b b b b b b b b"),
             (53, "größe\tnaïve x"), (54, "ONE, two one two")]
    rows = [r[:2] for r in edge_rows()] + extra
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("shard_words, max_phrases", [(1 << 19, 1_000_000), (200, 8), (1, 1)])
def test_equals_brute_force(spark, corpus, shard_words, max_phrases):
    """Also with tiny shards, and with items in many blocks."""
    rows, docs = corpus
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = positional.contamination(with_clashes(docs), with_clashes(items), shard_words=shard_words,
                                     max_phrases=max_phrases)
    want = brute(rows, ITEMS)
    assert rows_of(found) == want
    assert any(r[4] > r[3] for r in want) and any(None in r[3] for r in want)


def test_small_pieces_of_candidates(spark, corpus, monkeypatch):
    rows, docs = corpus
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(positional, "CANDIDATES", 3)
    block = positional._Block(positional.item_phrases(items).toArrow(), Counter())
    assert len(block.length) == len({p for _, p in positional.item_phrases(items).collect()})
    found = positional.contamination(docs, items, slop=0)
    assert [r[:4] for r in rows_of(found)] == [r[:4] for r in brute(rows, ITEMS, slop=0)]
    assert all(r[3] == r[4] for r in rows_of(found))


def test_index_serves_later_searches(spark, corpus):
    rows, docs = corpus
    index = positional.build_index(docs, shard_words=500)
    assert index.filter("term is null").count() == len(rows)
    total = index.filter("term is not null").groupBy().sum("n").first()[0]
    assert total == sum(len(words_of(t)) for _, t in rows)
    for window in (3, 10):
        phrases = positional.item_phrases(spark.createDataFrame([(1, "fox jumps over the lazy")], "item_id int, text string"),
                                          window=window)
        assert positional.phrase_matches(index, phrases).columns == ["shard", "ord", "hits", "items", "near"]
    with pytest.raises(ValueError):
        positional.item_phrases(docs, window=0)


def test_empty_tables(spark, corpus, no_docs):
    rows, docs = corpus
    none = spark.createDataFrame([], "item_id string, text string")
    assert positional.contamination(no_docs, none).count() == 0
    found = positional.contamination(docs, none).collect()
    assert len(found) == len(rows) and all(r.n_hit == 0 and r["items"] == [] for r in found)
    named = spark.createDataFrame([("k", "one two"), (None, None)], "doc_id string, text string")
    items = spark.createDataFrame([("x", "ONE two"), ("y", "two")], "item_id string, text string")
    assert rows_of(positional.contamination(named, items)) == brute([("k", "one two"), (None, None)],
                                                                     [("x", "ONE two"), ("y", "two")])


def test_query_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    want = [(i, n, hit, len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), hit > 0,
             len(near)) for i, n, hit, found, near in brute(rows, items)]
    assert sorted(map(tuple, queries.op12_benchmark_leaks(spark, SF_SMALL).collect()), key=repr) == sorted(want, key=repr)
    assert any(r[5] for r in want)
