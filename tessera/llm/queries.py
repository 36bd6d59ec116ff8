"""The registered queries of this package (``REGISTRY``) and their SQL (``SQL``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chunks, licenses, mixing, periods, pieces, pii, positional, ppm, preference,
                         quality, ranked, secrets, simhash)
from tessera.llm.common import let, words_of
from tessera.llm.sql import LEAKS, RANKING


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(pii.scan(docs), pii.KINDS)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.scan(docs), secrets.KINDS[:3])


def good_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.ratio_model(docs, good_ids(spark, sf_dir))
    return quality.measured(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio")


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "repeats")


def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = preference.conversations(_table(spark, sf_dir, "conversations"))
    pairs = told.select("conv_id", F.col("turns").alias("chosen"),
                        preference.stale_reply(F.col("turns")).alias("rejected"))
    return preference.format_pairs(pairs, "conv_id")


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"))


def op9_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sample(_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.fingerprints(_table(spark, sf_dir, "documents"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) whose tenth by crc32 of the id repeat a stretch from some word to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def body(w):
        n = F.size(w)
        return let(F.struct((g % n).cast("int").alias("a")), lambda m: let(
            (1 + F.floor((n - m["a"]) / (3 + g % 8))).cast("int"), lambda p: F.array_join(F.transform(
                w, lambda x, i: F.when(i < m["a"], x).otherwise(F.get(w, m["a"] + (i - m["a"]) % p))), " ")))

    edited = let(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, body(w)))
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.find_runs(planted_repeats(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                       F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
                      (-F.col("top.period")).alias("period"),
                      F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def op12_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


REGISTRY = {
    "op1_simhash_near_duplicates": op1_simhash_near_duplicates,
    "op2_personal_data": op2_personal_data,
    "op3_secret_scans": op3_secret_scans,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing_sources": op5_mixing_sources,
    "op6_preference_pairs": op6_preference_pairs,
    "op7_license_scans": op7_license_scans,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_sentencepiece_samples": op9_sentencepiece_samples,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_benchmark_leaks": op12_benchmark_leaks,
    "op13_ranked_search": op13_ranked_search,
}

# The others have no SQL twin: tests/llm holds each against a brute-force version.
SQL: dict[str, str] = {"op12_benchmark_leaks": LEAKS, "op13_ranked_search": RANKING}
