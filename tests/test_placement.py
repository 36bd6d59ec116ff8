"""Fragments, derived fragments, completeness and the placement sink."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import placement as pl
from tessera.plans import catalog, domain
from tessera.session import scratch_path
from tessera.sources import sinks


def _base(spark):
    return pl.placement_base(domain.movies(spark, SF_SMALL), domain.credits(spark, SF_SMALL))


def test_part_and_rest_cover_the_fragment(spark):
    spec = catalog.SITE["west"]
    frag = pl.fragment(_base(spark), spec)
    part, rest = pl.split_fragment(frag, spec)
    ids = lambda df: {r["id"] for r in df.select("id").collect()}
    assert ids(part) | ids(rest) == ids(frag)
    assert not ids(part) & ids(rest)
    assert rest.count() == rest.distinct().count()
    assert "director" not in frag.columns


def test_rest_keeps_null_class_rows(spark):
    df = spark.createDataFrame([(1, ["x"]), (2, None), (2, None), (3, ["y"])],
                               "id int, genres array<string>")
    spec = pl.FragmentSpec("s", ("ignored",), split_any_of=("x",))
    part, rest = pl.split_fragment(df, spec)
    assert [r["id"] for r in part.collect()] == [1]
    assert sorted(r["id"] for r in rest.collect()) == [2, 3]        # NULL stays, deduplicated


def test_check_placement_matches_brute_force(spark):
    base = _base(spark)
    placed = pl.placed_ids(base, catalog.SITES)
    union = pl.union_ids([pl.fragment(base, s) for s in catalog.SITES])
    assert placed.count() == union.count()
    movies = domain.movies(spark, SF_SMALL)
    chk = pl.check_placement(movies, placed)
    all_ids = {r[0] for r in movies.select("id").collect()}
    on_site = {r[0] for r in union.collect()}
    assert {r[0] for r in chk["lost"].collect()} == all_ids - on_site
    assert chk["orphan"].count() == 0


def test_derived_fragment_is_a_semi_join(spark):
    spec = catalog.SITE["east"]
    frag = pl.fragment(_base(spark), spec)
    det = pl.derived_fragment(domain.credits(spark, SF_SMALL), frag)
    assert det.columns == ["id", "actors", "director"]
    assert det.count() == frag.select("id").distinct().count()


def test_write_placement_csv_and_parquet(spark):
    root = scratch_path(spark, "placement_test")
    credits = domain.credits(spark, SF_SMALL)
    out = sinks.write_placement(_base(spark), credits, catalog.SITES, root, fmt="csv")
    assert "north/part" in out and "north/details" not in out and "east/details" in out
    back = spark.read.option("header", True).csv(out["west/rest"])
    assert back.where(F.col("genres").startswith("[")).count() == back.count()


def test_pieces_are_written_by_more_tasks_as_the_table_grows(spark, monkeypatch):
    """A task gets so many rows of the base table, however large it is; the rows are the same."""
    import glob
    import re
    base, details = _base(spark), domain.credits(spark, SF_SMALL)
    want = sinks.write_pieces(base, details, catalog.SITES, scratch_path(spark, "pieces"))
    monkeypatch.setattr(sinks, "TASK_ROWS", 4)
    root = scratch_path(spark, "pieces")
    assert sinks.write_pieces(base, details, catalog.SITES, root) == want
    folder = root.split("file:")[-1]
    tasks = {re.search(r"part-(\d+)", f).group(1) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}
    assert len(tasks) > 16             # more than the session's 8 partitions on either side
