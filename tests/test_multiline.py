"""Multi-line CSV read by several tasks per file against the one-task read."""

import random

import pytest

from tessera import schemas
from tessera.sources import multiline, readers

from conftest import fixture_path

SCHEMA = schemas.all_strings("a", "b", "c")


def both(spark, path, schema, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = multiline.read_csv_multiline(spark, path, schema).collect()
        tasks = spark.read.text(path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = readers.read_csv_quoted(spark, path, schema, multiline=True).collect()
    key = lambda r: [str(v) for v in r]
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
    return got, tasks


def field(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return ""
    if kind == 1:
        return '5" wide'                                    # a quote inside a plain field
    if kind == 2:
        return '"' + "\n".join(rng.choice(["x,y", '""q""', "", '"",""', "end"]) for _ in range(rng.randrange(1, 9))) + '"'
    if kind == 3:
        return '"say ""hi"", twice"'
    return "w" * rng.randrange(1, 30)


@pytest.mark.parametrize("seed, split, end", [(1, "64", "\n"), (2, "200", "\n"), (3, "97", "\r\n"), (4, "1048576", "\n")])
def test_equal_to_the_one_task_read(spark, tmp_path, seed, split, end):
    rng = random.Random(seed)
    for n in range(2):
        rows = ["a,b,c"] + [",".join(["k%d" % i, field(rng), field(rng)]) for i in range(150)]
        if n:
            rows.insert(40, "")                                # an empty record
        (tmp_path / f"part{n}.csv").write_bytes((end.join(r.replace("\n", end) for r in rows) + end).encode())
    got, tasks = both(spark, str(tmp_path), SCHEMA, split)
    assert len(got) == 300 and (tasks > 20 or split == "1048576")
    assert any("\n" in (r.b or "") for r in got)


def test_a_record_longer_than_several_splits(spark, tmp_path):
    long = "\n".join(f"line {i}, \"\"quoted\"\"" for i in range(300))
    (tmp_path / "x.csv").write_text(f'a,b,c\n1,"{long}",z\n2,plain,"y\n"\n3,short\n4,too,many,fields\n')
    got, tasks = both(spark, str(tmp_path), SCHEMA, "128")
    assert tasks > 30 and [r for r in got if r.a == "1"][0].b == long.replace('""', '"')


def test_fixture_and_edge_files(spark, tmp_path):
    both(spark, fixture_path("movies.csv"), schemas.MOVIES_RAW, "100")
    (tmp_path / "only_header.csv").write_text("a,b,c\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "late.csv").write_text('\n\n"a\n",b,c\n1,2,3')
    assert [tuple(r) for r in both(spark, str(tmp_path), SCHEMA, "5")[0]] == [("1", "2", "3")]
