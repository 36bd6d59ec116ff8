"""The pipeline's stages against what each operator's brute-force test establishes."""

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL

from llm.test_quality import brute_counts
from llm.test_simhash import brute_components
from tessera.llm import mixing, quality, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    stage = dict(corpus_pipeline.STAGES)
    names = list(stage)
    assert len(names) == 5
    every = {r.doc_id: r for r in docs.collect()}

    good = stage[names[0]](spark, docs, SF_SMALL).cache()
    verdict = {r.doc_id: r.kept for r in queries.op4_quality_rules(spark, SF_SMALL).collect()}
    assert good.columns == COLUMNS and {r.doc_id for r in good.collect()} == {i for i, k in verdict.items() if k}
    assert all(brute_counts(every[i].text)[5] is False for i, k in verdict.items() if k)

    single = stage[names[1]](spark, good, SF_SMALL).cache()
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in good.collect()], 2)}
    assert single.columns == COLUMNS and sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = stage[names[2]](spark, single, SF_SMALL).cache()
    found = {r.doc_id: r.spans for r in queries.op3_secret_scans(spark, SF_SMALL).collect()}
    assert clean.columns == COLUMNS
    for r in clean.collect():
        assert r.n_chars == (len(r.text) if found[r.doc_id] else every[r.doc_id].n_chars)
        assert ("[SECRET]" in r.text) == bool(found[r.doc_id])

    mixed = stage[names[3]](spark, clean, SF_SMALL).cache()
    times = {r.doc_id: r.repeats for r in mixing.mix(clean).collect()}
    got = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == COLUMNS and all(got.count(i) == n for i, n in times.items())

    coded = stage[names[4]](spark, mixed, SF_SMALL)
    assert coded.filter("not round_trip").count() == 0 and coded.count() == 2 * len(got)


def test_run_and_registration(spark):
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert entry.queries()["pipeline"](spark, SF_SMALL).count() > 0
    assert quality.THRESHOLD < 0
