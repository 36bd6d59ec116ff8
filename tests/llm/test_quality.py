import math
from collections import Counter

import xxhash
from conftest import SF_SMALL

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import quality, queries


def words_of(text):
    return (text or "").encode().split()


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in quality.SYMBOLS for c in text),
            len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def grams(text):
    hashes = [xxhash.xxh64_intdigest(w, 42) for w in words_of(text)]
    pair = lambda a, b: xxhash.xxh64_intdigest(
        b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    return [h if h < 1 << 63 else h - (1 << 64) for h in hashes + [pair(a, b) for a, b in zip(hashes, hashes[1:])]]


def brute_ratios(rows, good, buckets):
    raw, target = Counter(), Counter()
    for i, t in rows:
        own = [g % buckets for g in grams(t)]
        raw.update(own)
        if i in good:
            target.update(own)
    share = sum(target.values()) / max(1, sum(raw.values()))
    weight = {b: math.log((target[b] + quality.PSEUDO) / (raw[b] * share + quality.PSEUDO)) for b in raw}
    out = []
    for i, t in rows:
        own = [g % buckets for g in grams(t)]
        out.append((i, sum(weight[b] for b in own) / len(own) if own and target else 0.0))
    return out


def test_counts_and_ratio_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in queries.good_ids(spark, SF_SMALL).collect()}
    ratios = dict(brute_ratios(rows, good, quality.BUCKETS))
    found = {r.doc_id: r for r in queries.op4_quality_rules(spark, SF_SMALL).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(t)
        assert abs(r.ratio - ratios[i]) < 1e-9
        assert r.kept == (not r.base_failed and ratios[i] >= quality.THRESHOLD)


def test_labelled_documents_are_told_apart(spark):
    """Junk that the base rules pass is rejected; labelled clean documents stay."""
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op4_quality_rules(spark, sf).join(labels, "doc_id").filter("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.15


def test_edge_cases(spark, docs, no_docs):
    good = spark.createDataFrame([(9,), (9,), (None,), (20,)], "doc_id long")
    model = quality.ratio_model(with_clashes(docs), good, buckets=64)
    own = with_clashes(docs)
    whole = quality.measured(own, model, buckets=64, prefix="q_")
    assert whole.columns[:len(own.columns)] == own.columns
    assert whole.filter("words <> 'x' OR hashes <> 'x'").count() == 0
    found = whole.select("doc_id", "text", "q_n_words", "q_ratio",
                                                                          "q_n_repeat_words", "q_base_failed")
    want = [(i, t, brute_counts(t)[0], ratio, brute_counts(t)[4], brute_counts(t)[5]) for (i, t), (_, ratio) in zip(
        [r[:2] for r in edge_rows()], brute_ratios([r[:2] for r in edge_rows()], {9, 20}, 64))]
    assert table_of(found) == sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want), key=repr)
    none = spark.createDataFrame([], "doc_id long")
    unlabelled = quality.measured(docs, quality.ratio_model(docs, none))
    assert all(r.ratio == 0 and r.kept == (not r.base_failed) for r in unlabelled.collect())
    assert quality.filter_documents(no_docs, none).count() == 0
    kept = quality.filter_documents(with_clashes(docs), none)
    assert kept.columns == with_clashes(docs).columns
    assert kept.count() == sum(not brute_counts(r[1])[5] for r in edge_rows())


def test_target_sample_is_bounded_and_stable(spark):
    ids = spark.range(5000).select("id")
    a = {r.id for r in quality.target_sample(ids, 300).collect()}
    assert len(a) <= 300 and len(a) > 250 and a == {r.id for r in quality.target_sample(ids.repartition(7), 300).collect()}
    assert quality.target_sample(ids, 10_000).count() == 5000
