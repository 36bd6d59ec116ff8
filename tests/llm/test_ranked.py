import math
import re
from collections import Counter

import pytest
from conftest import SF_SMALL

from llm.conftest import edge_rows, prose, with_clashes
from tessera.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=20):
    counts = [(i, Counter(terms_of(t))) for i, t in rows if terms_of(t)]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    merged: dict = {}
    for i, t in dict.fromkeys(items):
        merged.setdefault(i, Counter()).update(terms_of(t))
    out = []
    for item, want in merged.items():
        scored = []
        for doc, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in want.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, k, doc, -less) for k, (less, _, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, prose(14, 1)), (2, "one two ONE"), (3, ""), (4, None), (5, "absent-word"), (None, prose(12, 9)),
         (1, prose(14, 1)), (1, "fox0 extra"), (6, "line line naïve Größe"), (8, prose(400, 3))]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("max_entries, slice_cells", [(2_000_000, 4_000_000), (30, 4_000_000), (1, 7)])
def test_equals_brute_force(spark, docs, monkeypatch, max_entries, slice_cells):
    """Also with items in many blocks and slices of a single document."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(ranked, "SLICE", slice_cells)
    rows = [r[:2] for r in edge_rows()]
    for top in (20, 3):
        found = ranked.search(with_clashes(docs), with_clashes(items), top=top, max_entries=max_entries)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert rows_of(found) == brute(rows, ITEMS, top)


def test_ties_over_many_tasks(spark):
    """Equal documents by ascending id, whatever tasks they are in."""
    rows = [(i, "same words here") for i in range(500)] + [(None, "same words here"), (3, "same words here"), (900, "other")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(16)
    items = [("a", "same same"), ("b", "words other")]
    found = ranked.search(docs, spark.createDataFrame(items, "item_id string, text string"))
    assert rows_of(found) == brute(rows, items)
    assert [r[2] for r in sorted(rows_of(found)) if r[0] == "a"][:5] == [0, 1, 2, 3, 3]


def test_empty_tables_and_other_ids(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.search(docs, none).count() == 0
    assert ranked.search(no_docs, items).count() == 0
    assert ranked.search(no_docs, none).columns == ["item_id", "rank", "doc_id", "score"]
    rows = [("x", "alpha beta"), ("é", "Alpha"), (None, "alpha beta")]
    named = spark.createDataFrame(rows, "doc_id string, text string")
    assert rows_of(ranked.search(named, spark.createDataFrame([(1, "ALPHA beta")], "item_id long, text string"))) \
        == brute(rows, [(1, "ALPHA beta")])


def test_query_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    assert rows_of(queries.op13_ranked_search(spark, SF_SMALL)) == brute(rows, items)
