import math
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL

from llm.conftest import edge_rows, with_clashes
from tessera.llm import ppm, queries

END = object()


def brute(rows, order):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    raw = [bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()) for _, t in rows]
    tokens = [[*x.split(), END] for x in raw]
    counts = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    total, kinds = sum(counts.values()), len(counts)
    follow = defaultdict(Counter)
    texts = [b"\xff" * order + x + b"\xfe" for x in raw]
    for x, h in zip(texts, held):
        for i in range(order, len(x) if not h else 0):
            for j in range(order + 1):
                follow[x[i - j:i]][x[i]] += 1
    out = []
    for (i, _), h, own, x in zip(rows, held, tokens, texts):
        score = 0.0
        for at in range(order, len(x)):
            left, known = 1.0, set()
            for j in range(order, -1, -1):
                live = {a: n for a, n in follow.get(x[at - j:at], {}).items() if a not in known}
                if not live:
                    continue
                whole = sum(live.values()) + len(live)
                if x[at] in live:
                    left *= live[x[at]] / whole
                    break
                left *= len(live) / whole
                known |= set(live)
            else:
                left /= ppm.SYMBOLS - len(known)
            score += math.log10(left)
        base = sum(math.log10((counts.get(t, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)
        out.append((i, h, len(own), sum(counts.get(t, 0) > 0 for t in own), total, base, score))
    return sorted(out, key=lambda r: (repr(r[0]), r[2], r[5]))


def compare(frame, want):
    got = sorted((tuple(r) for r in frame.collect()), key=lambda r: (repr(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    compare(queries.op8_lm_scoring(spark, SF_SMALL), brute(rows, ppm.ORDER))


@pytest.mark.parametrize("options", [{"order": 2}, {"order": 3, "max_arcs": 0},
                                     {"max_arcs": 40}, {"order": 3, "max_arcs": 300}, {"order": 1, "frequent": 4}])
def test_edge_cases_and_both_ways_to_score(spark, docs, options):
    """Without arcs to send, and with few frequent words, the joins give the same result."""
    compare(ppm.score(with_clashes(docs), **options),
            brute([r[:2] for r in edge_rows()], options.get("order", ppm.ORDER)))


def test_no_documents_and_no_training(spark, no_docs):
    assert ppm.score(no_docs).count() == 0
    held = [(i, "ab") for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    compare(ppm.score(spark.createDataFrame(held, "doc_id long, text string"), order=2), brute(held, 2))


def test_the_model_learns(spark):
    """Held-out text of the corpus costs fewer bits a byte than the same bytes in reverse."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in ppm.score(docs).collect()}
    held = [r for r in docs.collect() if found[r.doc_id].held_out]
    bits = -sum(found[r.doc_id].score for r in held) / math.log10(2) / sum(len(r.text.encode()) for r in held)
    assert held and bits < 3.2
