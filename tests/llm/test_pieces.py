import math
import os
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import pieces, queries

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no tokenizer files")


def all_segmentations(vocab, text):
    """Every id sequence of a short text with its probability, by trying all pieces."""
    line = (" " + text).replace(pieces.SPACE, pieces.LITERAL).replace(" ", pieces.SPACE) if text else ""
    ids = {t: i for i, t in enumerate(vocab.text) if vocab.weight[i] < 0}

    def split(rest):
        if not rest:
            return [((), 0.0)]
        out = []
        for n in range(1, len(rest) + 1):
            if rest[:n] in ids:
                i = ids[rest[:n]]
                out += [((i, *tail), vocab.weight[i] + w) for tail, w in split(rest[n:])]
        if rest[0] not in ids:
            sign = pieces.SPACE if rest[0] == pieces.LITERAL else rest[0]
            own = tuple(int(vocab.byte_id[b]) for b in sign.encode())
            out += [((*own, *tail), vocab.byte_weight * len(own) + w) for tail, w in split(rest[1:])]
        return out

    found = split(line)
    whole = math.log(sum(math.exp(w) for _, w in found))
    return {seq: w - whole for seq, w in found}


@pytest.mark.parametrize("text", ["", "a", "the cat", "x\ny", "é▁\U0001f600", "  in  "])
def test_log_probabilities_and_whole_enumeration(text):
    """Asking for more than there are gives every segmentation once, in falling perturbed order
    (but for a tail whose mass double precision cannot tell from nothing)."""
    vocab = pieces.vocabulary()
    want = all_segmentations(vocab, text)
    k = len(want) + 3
    found = pieces.sample_texts(vocab, [b"k"], [text], k, 7)[0]
    got = {tuple(s[0].tolist()): s[1] for s in found}
    assert len(got) == len(found) and all(want[s] == pytest.approx(p, abs=1e-9) for s, p in got.items())
    assert sum(math.exp(p) for s, p in want.items() if s not in got) < 1e-11
    assert all(s[3] == 0.0 for s in found)
    values = [s[2] for s in found]
    assert values == sorted(values, reverse=True)
    assert all(vocab.decode(s[0]) == text for s in found)


def test_draws_follow_sampling_without_replacement():
    """First and second draws over many keys against their exact chances."""
    vocab = pieces.vocabulary()
    want = {s: math.exp(p) for s, p in all_segmentations(vocab, "on").items()}
    n = 20_000
    found = pieces.sample_texts(vocab, [str(i).encode() for i in range(n)], ["on"] * n, 2, 3)
    first = Counter(tuple(f[0][0].tolist()) for f in found)
    second = Counter(tuple(f[1][0].tolist()) for f in found)
    for s, p in want.items():
        assert abs(first[s] / n - p) < 4 * math.sqrt(p / n) + 1e-3
        q = sum(r * p / (1 - r) for t, r in want.items() if t != s)
        assert abs(second[s] / n - q) < 4 * math.sqrt(q / n) + 1e-3


def test_inclusion_scores_estimate_totals_without_bias():
    """Weights p / inclusion over the sample add up to 1 on average (Horvitz-Thompson)."""
    vocab = pieces.vocabulary()
    n = 6000
    found = pieces.sample_texts(vocab, [str(i).encode() for i in range(n)], ["the"] * n, 3, 5)
    sums = np.array([sum(math.exp(s[1] - s[3]) for s in f) for f in found])
    assert abs(sums.mean() - 1) < 5 * sums.std() / math.sqrt(n)


def test_result_does_not_depend_on_the_batch(monkeypatch):
    vocab = pieces.vocabulary()
    keys, texts = [str(i).encode() for i in range(30)], [r[1] or "" for r in edge_rows()][-30:]
    keys = keys[:len(texts)]
    together = pieces.sample_texts(vocab, keys, texts, 2, 1)
    alone = [pieces.sample_texts(vocab, [k], [t], 2, 1)[0] for k, t in zip(keys, texts)]
    for a, b in zip(together, alone):
        assert [s[0].tolist() for s in a] == [s[0].tolist() for s in b]
        assert [s[1:] for s in a] == [pytest.approx(s[1:], rel=1e-9) for s in b]


def test_edge_cases(spark, docs, no_docs):
    found = pieces.sample(with_clashes(docs)).collect()
    assert all(r.round_trip for r in found)
    texts = Counter((r[0], r[1] or "") for r in edge_rows())
    assert len(found) == sum(n * (2 if t else 1) for (_, t), n in texts.items())
    assert pieces.sample(no_docs).count() == 0
    pairs = {}
    for r in found:
        pairs.setdefault(r.doc_id, []).append(tuple(r.ids))
    assert all(len(set(p)) == 2 for i, p in pairs.items() if i in (1, 7, 10, None))


def test_query(spark):
    rows = queries.op9_sentencepiece_samples(spark, SF_SMALL)
    assert rows.filter("not round_trip").count() == 0
    assert rows.count() == 2 * spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert table_of(rows.filter("doc_id < 20")) == table_of(
        pieces.sample(spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("doc_id < 20").repartition(5)))


def test_decoding_and_texts_that_are_not_utf8(spark, docs):
    drawn = pieces.sample(docs.filter("doc_id <> 7 OR doc_id IS NULL"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    decoded = pieces.decode(drawn.withColumn("text", F.lit("x"))).collect()
    assert decoded and all(r.text == texts[r.doc_id] for r in decoded)
    assert pieces.decode(drawn.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert sorted((r.k, r.text) for r in pieces.decode(none).collect()) == [(1, None), (2, "")]
    broken = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF62') AS STRING) AS text")
    assert {r.text for r in pieces.decode(pieces.sample(broken)).collect()} == {"a\ufffdb"}
