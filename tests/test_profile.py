"""Sensor profiles, codes and message decoding."""

import pytest
from pyspark.sql import functions as F

from conftest import fixture_path
from tessera import schemas
from tessera.functions import scalars
from tessera.operators import profile
from tessera.sources import readers
from tessera.streaming import decode


def _sensor(spark):
    return profile.with_time_features(
        readers.read_sensor_json(spark, fixture_path("sensor.json"), schemas.SENSOR))


def test_hour_minute_from_epoch_ms(spark):
    r = _sensor(spark).where(F.col("Index") == 18).first()
    assert (r["Hour"], r["Minutes"]) == (10, 18)


def test_bad_json_line_is_a_null_row(spark):
    rows = _sensor(spark).collect()
    assert len(rows) == 4
    assert sum(1 for r in rows if r["Index"] is None) == 1


def test_codes_and_unknowns(spark):
    s = _sensor(spark).where(F.col("Index").isNotNull())
    out = {r["Index"]: r for r in s.select(
        "Index", scalars.suffix_code("Device").alias("dev"),
        scalars.code_lookup("Device", ["nexus4_1", "nexus4_2"]).alias("dev_code"),
        scalars.code_lookup("gt", ["null", "stand"]).alias("label")).collect()}
    assert out[18]["dev"] == 0 and out[19]["dev"] == 1 and out[20]["dev"] == 6
    assert out[20]["dev_code"] is None                # unknown device -> NULL, no error
    assert out[19]["label"] == 0.0                    # the *string* 'null' is a class
    assert out[20]["label"] is None                   # missing gt


def test_shares_sum_to_one_and_pivot_null_cells(spark):
    s = _sensor(spark).where(F.col("Index").isNotNull())
    total = sum(r["share"] for r in profile.shares(s, "User").collect())
    assert abs(total - 1.0) < 1e-12
    p = {r["User"]: r for r in profile.pivot_count(s, "User", "gt", ["stand", "null"]).collect()}
    assert p["g"]["stand"] == 1 and p["g"]["null"] is None
    p0 = {r["User"]: r for r in profile.pivot_count(s, "User", "gt", ["stand", "null"], fill=0)
          .collect()}
    assert p0["g"]["null"] == 0


def test_time_span_units(spark):
    s = _sensor(spark).where(F.col("Index").isNotNull())
    r = profile.time_span(s, "Arrival_Time", "ms").first()
    assert abs(r["span_hours"] - (1424696000500 - 1424686735090) / 3_600_000) < 1e-9


def test_decode_roundtrip_and_corrupt_route(spark):
    s = readers.read_sensor_json(spark, fixture_path("sensor.json"), schemas.SENSOR) \
        .where(F.col("Index").isNotNull())
    msgs = decode.encode_json_value(s)
    back = decode.decode_json_value(msgs, schemas.SENSOR)
    assert sorted(back.collect()) == sorted(s.collect())
    bad = spark.createDataFrame([(bytearray(b"bad"),)], "value binary")
    r = decode.decode_json_value(bad, schemas.SENSOR, keep_raw=True).first()
    assert r["is_corrupt"] and r["raw_text"] == "bad"
    mixed = spark.createDataFrame([(bytearray(b),) for b in (
        '{"Index": 1, "Device": "d\u00e9"}'.encode(), b'{"Index": 2, "Device": "d\xe9"}', b"{}",
        b'{"Index": 3, "Dev', b"")] + [(None,)], "value binary")
    got = [(m["Index"], m["Device"], m["is_corrupt"]) for m in
           decode.decode_json_value(mixed, schemas.SENSOR, keep_raw=True).collect()]
    assert got == [(1, "d\u00e9", False), (2, "d\ufffd", False), (None, None, False),
                   (None, None, True), (None, None, True), (None, None, True)]


def test_feature_pipelines_keep_every_row_and_category(spark):
    from tessera.operators import features as fe
    rows = spark.range(12_000).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("small"),
        F.col("id").cast("string").alias("wide"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 2).cast("string").alias("y"))
    out = fe.feature_pipeline(["small", "wide"], ["small", "wide"], ["x"], "y").fit(rows).transform(rows)
    assert out.first()["features"].size == 3 + 1 + 12_000 + 1 + 1     # however many categories there are
    assert out.count() == 12_000
    hashed = fe.hashed_feature_pipeline(["small", "wide"], ["x"], "y", hash_features=64)
    out = hashed.fit(rows).transform(rows)
    assert out.where(F.col("features").isNull()).count() == 0 and out.first()["features"].size == 65


def test_unknown_labels_and_nulls_are_scored(spark):
    from tessera.operators import features as fe
    from tessera.operators import learn
    rows = spark.createDataFrame(
        [("a", "d1", "u1", 1.0), ("b", "d1", "u2", 2.0), ("new", "d9", "u9", 3.0), (None, None, None, None)] * 5,
        "gt string, dev string, usr string, x double")
    prepared = fe.fixed_vocabulary_features(rows, "gt", ["a", "b"], {"dev": ["d1"]}, "usr", ["u1", "u2"], ["x"])
    assert prepared.count() == 20 and {r.label for r in prepared.collect()} == {0.0, 1.0, 2.0}
    known = prepared.where("label < 2")
    score = learn.accuracy(learn.random_forest(max_depth=4).fit(known).transform(prepared)).first()
    assert score["n_rows"] == 20 and score["n_correct"] <= 10          # unknown labels count, as wrong


def test_preview_helpers_and_empty_table(spark):
    from tessera.sources import preview, readers, sinks
    s = _sensor(spark)
    assert len(preview.preview(s, 2)) == 2
    assert "Arrival_Time" in preview.schema_of(s)
    pdf = preview.to_pandas_bounded(profile.counts(s, ["gt"]), max_rows=10)
    assert int(pdf["n"].sum()) == 4
    try:
        preview.to_pandas_bounded(s, max_rows=2)
    except ValueError:
        pass
    else:
        raise AssertionError("unbounded toPandas must be refused")
    empty = readers.empty_table(spark, schemas.MODEL_INPUT)
    assert empty.count() == 0 and empty.columns == ["label", "features"]
    arr = spark.createDataFrame([(1, ["a", "b"])], "id int, t array<string>")
    assert sinks.arrays_as_text(arr).first()["t"] == "[a, b]"


def test_hash_split_is_complete_disjoint_and_stable(spark):
    from tessera.operators import features as fe
    df = spark.range(5000).withColumnRenamed("id", "Index")
    tr, te = fe.hash_split(df, "Index")
    a = {r[0] for r in tr.collect()}
    b = {r[0] for r in te.collect()}
    assert not a & b and len(a | b) == 5000
    assert 0.66 < len(a) / 5000 < 0.74
    tr2, _ = fe.hash_split(df.repartition(7), "Index")
    assert {r[0] for r in tr2.collect()} == a
    m_tr, m_te = fe.hash_split(df, "Index", method="md5")
    assert m_tr.count() + m_te.count() == 5000 and 0.66 < m_tr.count() / 5000 < 0.74


@pytest.mark.parametrize("n_users", [1, 40])
def test_onehot_vectors_are_read_as_stored(spark, monkeypatch, tmp_path, n_users):
    """No row is blown up to one cell per category; short vectors are stored whole, long ones by place."""
    from pyspark.ml.functions import vector_to_array

    from tessera.plans import catalog

    def refused(*_):
        raise AssertionError("a dense array of the vector")

    monkeypatch.setattr(catalog, "vector_to_array", refused, raising=False)
    rows = spark.range(60).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_040)).alias("ts"),
        (F.col("id") % n_users).alias("user_id"), F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("event_type"),
        (F.col("id") % 4 - 1).cast("double").alias("value"), F.lit('{"k": 1}').alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    whole = catalog._model_rows(spark, str(tmp_path))
    train, _ = catalog.fe.hash_split(whole, "Index", method="md5")
    dense = catalog._batch_pipeline(train).fit(train).transform(whole).select(
        "Index", vector_to_array("features").alias("v")).collect()
    got = {r.Index: r for r in catalog.onehot_vectors(spark, str(tmp_path)).collect()}
    sizes = {r.Index: r.n_features for r in catalog.onehot_assemble(spark, str(tmp_path)).collect()}
    assert len(got) == len(sizes) == len(dense) == 60
    for index, v in dense:
        places = ",".join(f"{i}={int(x)}" for i, x in enumerate(v[:-3]) if x)
        assert (got[index].hot, [got[index].x, got[index].y, got[index].z], sizes[index]) == (places, v[-3:], len(v))


class _Seen:
    """A learner that notes how its rows are dealt."""

    def fit(self, rows):
        from tessera.operators import learn
        self.parts = rows.groupBy(F.spark_partition_id()).count().count()
        return learn.MajorityClass().fit(rows)


def test_a_forest_gets_so_many_cells_to_a_task(spark, monkeypatch, tmp_path):
    from tessera.plans import catalog
    spark.range(100).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"),
                            F.when(F.col("id") % 4 == 0, "fr").otherwise("en").alias("lang")) \
        .coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "DENSE_BYTES", 10 * 16 * 4, raising=False)
    seen = _Seen()
    got = catalog._language_accuracy(spark, str(tmp_path), seen, features=16).collect()
    assert seen.parts >= 6 and sum(r.n_rows for r in got) == 100


def test_model_rows_are_prepared_once_and_dealt_over_the_cores(spark, monkeypatch, tmp_path):
    from tessera.plans import catalog
    rows = spark.range(100).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_040)).alias("ts"),
        (F.col("id") % 5).alias("user_id"), F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit('{"k": 1}').alias("props"))
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(catalog, "FIT_ROWS", 20, raising=False)
    seen = _Seen()
    got = {r.split: r for r in catalog._fit_and_score(spark, str(tmp_path), seen).collect()}
    assert seen.parts > 1 and got["train"].n_rows + got["test"].n_rows == 100
    assert got["train"].accuracy == got["test"].accuracy == 1.0
