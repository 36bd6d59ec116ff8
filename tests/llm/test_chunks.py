import hashlib
import random

from conftest import SF_SMALL

from llm.conftest import edge_rows, table_of, with_clashes
from tessera.llm import chunks, queries


def brute_ends(data):
    """The cutting rule read off byte by byte."""
    ends, begin = [], 0
    while len(data) - begin > chunks.LEAST:
        end = min(begin + chunks.MOST, len(data))
        for at in range(begin + chunks.LEAST, end):
            h = 0
            for b in data[max(0, at - 16):at]:
                h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFF
            if not h & (chunks.STRICT if at - begin <= chunks.NORMAL else chunks.LOOSE):
                end = at
                break
        ends.append(end)
        begin = end
    return ends + [len(data)] * (begin < len(data))


def test_cuts_equal_the_rule():
    rng = random.Random(1)
    for n in (0, 1, 16, 17, 40, 255, 256, 300, 5000):
        data = bytes(rng.randrange(97, 123) for _ in range(n))
        assert chunks.chunk_ends(data) == brute_ends(data)
    assert chunks.chunk_ends(b"a" * 1000) == brute_ends(b"a" * 1000)


def test_an_edit_moves_only_cuts_near_it():
    rng = random.Random(2)
    data = bytes(rng.randrange(97, 123) for _ in range(40_000))
    other = data[:20_000] + b"inserted" + data[20_000:]
    assert chunks.containment(chunks.fingerprint(data), chunks.fingerprint(other)) > 0.97


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (chunks.fingerprint(x.encode()) for x in (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), chunks.written(a), chunks.written(b),
                    round(chunks.containment(a, b), 9), round(chunks.containment(a, c), 9)))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert table_of(queries.op10_document_fingerprints(spark, SF_SMALL)) == brute(rows)


def test_edge_cases_in_any_number_of_ranges(spark, docs, no_docs):
    want = brute([r[:2] for r in edge_rows()])
    for ranges in (1, 2, 7, 100):
        assert table_of(chunks.fingerprints(with_clashes(docs), ranges=ranges)) == want
    assert chunks.fingerprints(no_docs).count() == 0
    for rows in ([(5, "only one row here")], [(None, "a"), (None, None)], [(1, "b"), (1, "a"), (1, "a")]):
        assert table_of(chunks.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_ids_of_any_type_and_texts_that_are_not_utf8(spark):
    rows = [("b", "one two three " * 40), ("a", "one two three " * 40), (None, "x"), ("aa", "")]
    named = spark.createDataFrame(rows, "doc_id string, text string")
    number = {"b": 2, "aa": 1, "a": 0, None: None}
    found = {(number[r.doc_id], *r[1:]) for r in chunks.fingerprints(named).collect()}
    plain = spark.createDataFrame([(number[i], t) for i, t in rows], "doc_id long, text string")
    assert found == {tuple(r) for r in chunks.fingerprints(plain).collect()} and len(found) == 4
    broken = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF62') AS STRING) AS text")
    assert chunks.fingerprints(broken).first().n_chars == 3
