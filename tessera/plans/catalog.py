"""Named queries over the driver tables: name -> f(spark, sf_dir).

Each query runs over whole tables.  The SQL twin of every name lives in
``tessera.plans.oracle`` and is written independently (row-level joins,
no eager aggregation) so that it checks the Spark plan rather than
repeating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas
from tessera.functions import scalars, text
from tessera.operators import aggregates as agg
from tessera.operators import features as fe
from tessera.operators import learn, matrix, outer, profile, ranking, search, staged, tree
from tessera.operators import placement as pl
from tessera.operators.sizing import broadcast_if_bounded
from tessera.plans import domain as dom
from tessera.plans.tables import table
from tessera.session import scratch_path
from tessera.sources import multiline, parsers, readers, sinks
from tessera.streaming import deadletter, decode, dictionary, prequential, replay

Query = Callable[[SparkSession, str], DataFrame]

# Fixed column sets so result schemas do not depend on the scale factor.
NAME_WORDS = ("anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new",
              "old", "plate", "red", "ring", "rod", "small", "widget")
ORDER_YEARS = tuple(range(1995, 2002))
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SHARE_WORD = "small"

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- C8-C11: demand matrices, volumes, profiles -----------------------------

@query
def volume_rows_by_location(spark, d):
    return matrix.volume_by_location(dom.session_events(spark, d), dom.users(spark, d))


@query
def volume_units_by_location(spark, d):
    return matrix.volume_by_location(dom.tickets(spark, d), dom.users(spark, d),
                                     units="n_tickets", fact_key="user_id")


@query
def demand_array_matrix(spark, d):
    return matrix.demand_matrix(dom.searches(spark, d), dom.users(spark, d),
                                "genres", NAME_WORDS, mode="array")


@query
def demand_scalar_matrix(spark, d):
    return matrix.demand_matrix(dom.search_years(spark, d), dom.users(spark, d),
                                "year", ORDER_YEARS, mode="scalar")


@query
def demand_measure_matrix(spark, d):
    return matrix.demand_matrix(dom.tickets(spark, d), dom.users(spark, d), "city", REGIONS,
                                mode="measure", measure="n_tickets", fact_key="user_id")


@query
def demand_event_matrix(spark, d):
    """Scalar matrix where many users have no facts (NULL cells)."""
    return matrix.demand_matrix(dom.session_events(spark, d), dom.users(spark, d),
                                "event_type", ("click", "error", "purchase", "signup", "view"),
                                mode="scalar")


@query
def demand_array_long(spark, d):
    return matrix.demand_long(dom.searches(spark, d), dom.users(spark, d), "genres")


@query
def demand_macro_average(spark, d):
    out = matrix.demand_profile(dom.searches(spark, d), dom.users(spark, d),
                                "genres", NAME_WORDS, mode="array")
    return out.select(*[F.round(F.col(w), 6).alias(w) for w in NAME_WORDS])


@query
def domain_array_values(spark, d):
    return matrix.array_domain(dom.searched_genres(spark, d), "genres")


@query
def domain_scalar_values(spark, d):
    return matrix.scalar_domain(dom.searched_years(spark, d), "year")


@query
def share_with_value(spark, d):
    out = matrix.share_with_value(dom.movies(spark, d), "genres", SHARE_WORD)
    return out.select(F.round("share", 6).alias("share"))


@query
def presence_rate(spark, d):
    out = matrix.presence_rate(dom.searches(spark, d), dom.users(spark, d),
                               ["actors", "director"])
    return out.select("user_location", F.round("has_actors", 6).alias("has_actors"),
                      F.round("has_director", 6).alias("has_director"))


@query
def total_of_group_totals(spark, d):
    per_loc = matrix.volume_by_location(dom.tickets(spark, d), dom.users(spark, d),
                                        units="n_tickets", fact_key="user_id")
    return matrix.total_of_group_totals(per_loc, "units", "total_units")


@query
def user_facts_outer(spark, d):
    """Row-level FULL OUTER join of events and users, hot users salted."""
    facts = dom.session_events(spark, d).withColumnRenamed("id", "fact_user")
    return outer.full_outer(facts, dom.users(spark, d), "fact_user", "id")


@query
def domain_first_seen(spark, d):
    """Words of part names in the order the table first shows them."""
    parts = readers.with_position(table(spark, d, "part")).withColumn("genres", F.split("p_name", " "))
    return matrix.first_seen_domain(parts, "genres", ["__file", "__row"])


@query
def demand_sparse_rows(spark, d):
    """Units per part (thousands of values) for each location, as sorted sparse rows."""
    out = matrix.demand_rows(dom.tickets(spark, d), dom.users(spark, d), "movie_id", mode="measure",
                             measure="n_tickets", fact_key="user_id")
    return out.select("user_location", "n_rows", F.explode("cells").alias("c")).select(
        "user_location", "n_rows", "c.value", "c.n", F.round("c.average", 6).alias("average"))


@query
def demand_sparse_counts(spark, d):
    """The array and scalar modes in one row per location: (value, count, average)."""
    out = None
    for facts, column, mode in ((dom.searches(spark, d), "genres", "array"), (dom.search_years(spark, d), "year", "scalar")):
        cells = matrix.demand_rows(facts, dom.users(spark, d), column, mode=mode)
        cells = cells.select("user_location", F.lit(mode).alias("mode"), "n_rows", F.explode("cells").alias("c")).select(
            "user_location", "mode", "n_rows", F.col("c.value").cast("string").alias("value"), "c.n",
            F.round("c.average", 6).alias("average"))
        out = cells if out is None else out.unionByName(cells)
    return out


# --- C3, C5, C7, X1-X7, X12: text to arrays ---------------------------------


DOC_MARKER = "the"


def _words_after_marker(spark, d, n):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = text.with_words_after(docs, "text", DOC_MARKER, n, "hits")
    return out.select("doc_id", F.size("hits").cast("long").alias("n_hits"),
                      F.array_join("hits", "|").alias("hits"))


@query
def words_after_marker_n2(spark, d):
    return _words_after_marker(spark, d, 2)


@query
def words_after_marker_n1(spark, d):
    return _words_after_marker(spark, d, 1)


@query
def list_literal_roundtrip(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    literal = F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("']"))
    items = text.parse_list_literal(literal)
    return p.select("p_partkey", F.size(items).cast("long").alias("n_items"),
                    F.array_join(items, "|").alias("items"))


@query
def credits_text_parse(spark, d):
    c = dom.credits(spark, d)
    return c.select("id", F.array_join("actors", "|").alias("actors"),
                    F.array_join("director", "|").alias("director"))


@query
def date_pattern_year(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    raw = F.date_format("o_orderdate", "dd/MM/yyyy")
    release = scalars.date_from_pattern(raw)
    return o.select("o_orderkey", release.alias("release_date"),
                    F.year(release).alias("year"))


# --- C16, C17, A13, A14, A26, A27: staged curtain aggregates -----------------

CURTAIN_THRESHOLD = 0.041


@query
def two_stage_extremes(spark, d):
    return staged.two_stage_extremes(dom.curtain(spark, d))


@query
def two_stage_extremes_long(spark, d):
    return staged.two_stage_extremes(dom.curtain(spark, d), long=True)


@query
def groups_always_above(spark, d):
    out = staged.groups_always_above(dom.curtain(spark, d), CURTAIN_THRESHOLD)
    return out.select("month", F.array_join("faces", ",").alias("faces"))


@query
def groups_mean_rdd_equiv(spark, d):
    m = staged.key_means(dom.curtain(spark, d), ["day", "month", "face", "curtain"])
    return m.withColumn("mean_value", F.round("mean_value", 6))


# --- C18-C20, A2, A8-A12, A15, A16, A24, A25, A28: sensor profiles -----------

GT_VALUES = ("click", "error", "purchase", "signup", "view")


def _sensor(spark, d):
    return profile.with_time_features(dom.sensor(spark, d))


@query
def sensor_hour_minute(spark, d):
    return _sensor(spark, d).select("Index", "Hour", "Minutes")


@query
def class_counts(spark, d):
    return profile.counts(_sensor(spark, d), ["gt"])


@query
def class_shares(spark, d):
    s = profile.shares(_sensor(spark, d), "gt")
    return s.select("gt", "n", F.round("share", 6).alias("share"))


@query
def class_mean_hour(spark, d):
    return profile.mean_truncated(_sensor(spark, d), ["gt"], "Hour")


@query
def pivot_mean_hour(spark, d):
    return profile.pivot_mean(_sensor(spark, d), "User", "gt", GT_VALUES, "Hour", ordered=True)


@query
def pivot_count(spark, d):
    return profile.pivot_count(_sensor(spark, d), "User", "gt", GT_VALUES)


@query
def cross_counts_hour_user(spark, d):
    return profile.counts(_sensor(spark, d), ["Hour", "User"])


@query
def cross_counts_hour_class(spark, d):
    return profile.counts(_sensor(spark, d), ["Hour", "gt"])


@query
def cross_counts_class_user(spark, d):
    return profile.counts(_sensor(spark, d), ["gt", "User"])


@query
def class_centroids(spark, d):
    c = profile.centroids(_sensor(spark, d), "gt")
    return c.select("gt", *[F.round(f"avg_{a}", 6).alias(f"avg_{a}") for a in "xyz"])


AXIS_BIN_WIDTH = 5.0


@query
def axis_density(spark, d):
    return profile.axis_density(_sensor(spark, d), "x", "y", "gt", AXIS_BIN_WIDTH)


@query
def time_span(spark, d):
    t = profile.time_span(_sensor(spark, d), "Creation_Time", "us")
    return t.select("min_time", "max_time", F.round("span_hours", 6).alias("span_hours"))


@query
def distinct_models(spark, d):
    s = _sensor(spark, d)
    return profile.distinct_count(s, "Model", "n_models")


@query
def distinct_users_merged(spark, d):
    """Distinct users per class and in all, from sketches stored per day and class."""
    daily = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")
    path = scratch_path(spark, "user_sketches")
    profile.distinct_sketches(daily, ["day", "event_type"], "user_id").write.parquet(path)
    stored = spark.read.parquet(path)
    per_class = profile.merged_distinct(stored, ["event_type"], "n_users")
    return per_class.unionByName(profile.merged_distinct(stored, [], "n_users")
                                 .select(F.lit("all").alias("event_type"), "n_users"))


@query
def distinct_devices(spark, d):
    return _sensor(spark, d).select("Device").distinct()


@query
def device_counts(spark, d):
    return profile.counts(_sensor(spark, d), ["Device"])


# --- C12-C15, J-I, J-S, U1-U5: data placement --------------------------------


SITES = (
    pl.FragmentSpec("north", ("EUROPE", "AMERICA"), min_year=1996,
                    split_any_of=("small",), store_details=False),
    pl.FragmentSpec("center", ("EUROPE", "ASIA"), min_year=1996, drop=("director",),
                    split_any_of=("red", "blue")),
    pl.FragmentSpec("east", ("ASIA", "MIDDLE EAST"), drop=("director",)),
    pl.FragmentSpec("south", ("AFRICA",), drop=("director", "actors")),
    pl.FragmentSpec("west", ("AFRICA", "AMERICA"), drop=("director",),
                    split_any_of=("hot", "cold")),
)
SITE = {s.site: s for s in SITES}


def _base(spark, d):
    return pl.placement_base(dom.movies(spark, d), dom.credits(spark, d))


def _as_text(df):
    """Arrays as ``a|b`` text so results compare as plain values."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c)
                       for c, t in df.dtypes])


@query
def placement_inner_base(spark, d):
    return _as_text(_base(spark, d))


def _fragment_query(site):
    def run(spark, d):
        return _as_text(pl.fragment(_base(spark, d), SITE[site]))
    run.__name__ = f"fragment_{site}"
    return query(run)


for _site in SITE:
    _fragment_query(_site)


@query
def fragment_part(spark, d):
    part, _ = pl.split_fragment(pl.fragment(_base(spark, d), SITE["north"]), SITE["north"])
    return _as_text(part)


@query
def fragment_rest(spark, d):
    _, rest = pl.split_fragment(pl.fragment(_base(spark, d), SITE["north"]), SITE["north"])
    return _as_text(rest)


@query
def derived_fragment_semi(spark, d):
    frag = pl.fragment(_base(spark, d), SITE["east"])
    return _as_text(pl.derived_fragment(dom.credits(spark, d), frag))


def _placement_check(spark, d):
    base = _base(spark, d)
    return pl.check_placement(dom.movies(spark, d), pl.placed_ids(base, SITES))


@query
def placement_lost(spark, d):
    return _placement_check(spark, d)["lost"]


@query
def placement_orphan(spark, d):
    """Placed movies that no document describes (document n is about movie n)."""
    source = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return pl.check_placement(source, pl.placed_ids(_base(spark, d), SITES))["orphan"]


@query
def placement_site_counts(spark, d):
    return _placement_check(spark, d)["site_counts"]


def _written(spark, d):
    root = scratch_path(spark, "pieces")
    return root, sinks.write_pieces(_base(spark, d), dom.credits(spark, d), SITES, root)


@query
def placement_written(spark, d):
    """Every piece of every site, written in one job and read back."""
    root, _ = _written(spark, d)
    out = None
    for spec in SITES:
        for piece in sinks.pieces_of(spec):
            rows = _as_text(sinks.read_piece(spark, root, spec, piece)).select(
                F.lit(spec.site).alias("site"), F.lit(piece).alias("piece"), "*")
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


@query
def placement_manifest(spark, d):
    root, counts = _written(spark, d)
    if counts != sinks.manifest(spark, root):
        raise RuntimeError("the stored manifest differs from the counts told")
    return spark.createDataFrame([(*k.split("/"), n) for k, n in counts.items()],
                                 "site string, piece string, n_rows long")


@query
def placement_union_ids(spark, d):
    # all fragments' ids from one pass over the base
    return pl.placed_ids(_base(spark, d), SITES).select("id")


# --- S1-S4, S6: file round trips (written under the checkpoint folder) -------

@query
def csv_roundtrip(spark, d):
    t = dom.tickets(spark, d).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("movie_id").cast("string").alias("movie_id"),
        F.col("n_tickets").cast("int").cast("string").alias("number_of_tickets"),
        "city", F.lit("1").alias("cinema_id"))
    path = scratch_path(spark, "csv_roundtrip")
    sinks.write_csv(t, path)
    return parsers.parse_tickets(readers.read_csv_quoted(spark, path, schemas.TICKETS_RAW))


@query
def csv_array_as_text(spark, d):
    m = dom.movies(spark, d).select("id", "genres", "cities")
    path = scratch_path(spark, "csv_arrays")
    sinks.write_csv(m, path)
    return readers.read_csv_quoted(spark, path, schemas.all_strings("id", "genres", "cities"))


@query
def json_scan(spark, d):
    path = scratch_path(spark, "sensor_json")
    dom.sensor(spark, d).write.mode("overwrite").json(path)
    return readers.read_sensor_json(spark, path, schemas.SENSOR)


@query
def tsv_single_column(spark, d):
    path = scratch_path(spark, "credits_text")
    raw = dom.credits_raw(spark, d)
    raw.write.mode("overwrite").option("header", True).option("quote", "\u0000") \
        .option("delimiter", "\t").csv(path)
    lines = readers.read_single_column_tsv(spark, path)
    out = parsers.parse_credits(lines, "cast,crew,id", mode="compat")
    return out.select("id", F.array_join("actors", "|").alias("actors"),
                      F.array_join("director", "|").alias("director"))


@query
def curtain_positional_csv(spark, d):
    path = scratch_path(spark, "curtain_csv")
    dom.curtain_text(spark, d).write.mode("overwrite").option("header", True).csv(path)
    raw = readers.read_positional_csv(spark, path, ["StartedOn", "value", "face", "curtain"])
    return staged.two_stage_extremes(parsers.parse_curtain(raw))


# --- L1-L10: features and classifiers ----------------------------------------


# Fixed vocabularies for stream-safe encoding (positions are the codes).
GT_VOCABULARY = ("view", "click", "signup", "error", "purchase")
DEVICE_VOCABULARY = ("dev_1", "dev_2")


def _model_rows(spark, d):
    s = _sensor(spark, d)
    return s.select("Index", "gt", "User", scalars.suffix_code("Device").alias("Device"),
                    "Hour", "Minutes", "x", "y", "z")


def _batch_pipeline(train):
    columns = ["User", "Device", "Hour", "Minutes"]
    return fe.feature_pipeline(columns, columns, ["x", "y", "z"], label_col="gt")


@query
def string_index(spark, d):
    s = _sensor(spark, d)
    model = fe.string_indexer(["gt"], ["gt_index"]).fit(s)
    return model.transform(s).select("gt", "gt_index").distinct()


@query
def user_index(spark, d):
    """Every user's place by falling number of readings (ties by name)."""
    return ranking.value_codes(_sensor(spark, d), "User", name="user_index")


@query
def user_index_rows(spark, d):
    s = _sensor(spark, d).select("Index", "User")
    return ranking.with_codes(s, "User", ranking.value_codes(s, "User")).select("Index", "code")


@query
def value_ranks(spark, d):
    """Rank and dense rank of each reading's x, highest first."""
    return ranking.ranked(_sensor(spark, d).select("Index", "x"), "x", descending=True)


@query
def sorted_positions(spark, d):
    """The ordered table with the order as a column: by class, then x falling, then id."""
    s = _sensor(spark, d).select("Index", "gt", "x")
    out = ranking.numbered(s, [F.asc("gt"), F.desc("x"), F.asc("Index")], "position")
    return out.withColumn("position", F.col("position") + 1)


@query
def sorted_page(spark, d):
    """Rows 101 to 150 of the readings by class, x falling and id: offset and limit as a table."""
    s = _sensor(spark, d).select("Index", "gt", "x")
    return ranking.page(s, [F.asc("gt"), F.desc("x"), F.asc("Index")], 101, 50)


@query
def device_suffix(spark, d):
    return _sensor(spark, d).select("Index", "Device",
                                    scalars.suffix_code("Device").alias("device_code"))


@query
def code_lookup(spark, d):
    s = _sensor(spark, d)
    return s.select("Index", scalars.code_lookup("gt", GT_VOCABULARY).alias("label"),
                    scalars.code_lookup("Device", DEVICE_VOCABULARY).alias("device_index"))


DICTIONARY_BLOCK = 4_000


@query
def user_onehot(spark, d):
    """One-hot encoding in long form, (row, user's code, 1): the codes grow block by block."""
    rows = _sensor(spark, d).select("Index", "User").withColumn("block", F.floor(F.col("Index") / DICTIONARY_BLOCK))
    users = dictionary.GrowingDictionary(spark, scratch_path(spark, "user_codes"), "User")
    users.extend(rows.where("block >= 0"), 0, by="block")
    return users.encode(rows).select("Index", "code", F.lit(1).alias("value"))


def _vector_size(column):
    """Width of a vector, without its cells; one that is stored whole names no width."""
    v = F.unwrap_udt(column)
    return F.coalesce(v["size"], F.size(v["values"]))


@query
def onehot_assemble(spark, d):
    rows = _model_rows(spark, d)
    train, _ = fe.hash_split(rows, "Index", method="md5")
    prepared = _batch_pipeline(train).fit(train).transform(rows)
    return prepared.select("Index", "label", _vector_size("features").alias("n_features"))


@query
def onehot_vectors(spark, d):
    """The assembled vectors themselves: the places that hold a one, and the numbers after them."""
    rows = _model_rows(spark, d)
    train, _ = fe.hash_split(rows, "Index", method="md5")
    prepared = _batch_pipeline(train).fit(train).transform(rows)
    # only what the vector stores; a short vector may be stored whole, without places
    v = F.unwrap_udt("features")
    at = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.map_from_arrays(at, v["values"])
    first = F.col("size") - 3
    hot = F.array_sort(F.filter(F.map_keys("cells"), lambda i: (F.try_element_at("cells", i) != 0) & (i < first)))
    return prepared.select("Index", _vector_size("features").alias("size"), cells.alias("cells")).select(
        "Index", F.array_join(F.transform(hot, lambda i: F.concat_ws(
            "=", i, F.try_element_at("cells", i).cast("int"))), ",").alias("hot"),
        *[F.coalesce(F.try_element_at("cells", first + n), F.lit(0.0)).alias(name)
          for n, name in enumerate(("x", "y", "z"))])


@query
def hash_split_counts(spark, d):
    train, test = fe.hash_split(_model_rows(spark, d), "Index", method="md5")
    return train.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("train")) \
        .unionByName(test.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("test")))


FIT_ROWS = 50_000          # rows that are worth a task of their own


def _dealt(rows, parts):
    """``rows`` over ``parts`` tasks, if they have fewer."""
    return rows.repartition(parts) if rows.rdd.getNumPartitions() < parts else rows


def _fit_and_score(spark, d, estimator):
    rows = _model_rows(spark, d)
    train, _ = fe.hash_split(rows, "Index", method="md5")
    pipe = _batch_pipeline(train).fit(train)
    side = F.when(fe.split_bucket("Index", method="md5") < 70, "train").otherwise("test")
    prepared = pipe.transform(rows.withColumn("split", side)).select("split", "label", "features")
    path = scratch_path(spark, "model_rows")
    prepared.write.parquet(path)                 # prepared once, read by the fit and by the scores
    prepared = spark.read.schema(prepared.schema).parquet(path)
    train = prepared.where("split = 'train'")
    # every pass of the fit lasts as long as its slowest task
    model = estimator.fit(_dealt(train, min(spark.sparkContext.defaultParallelism, -(-train.count() // FIT_ROWS))))
    # score train and test rows in one pass, grouped by their side
    return learn.split_accuracy(model, prepared)


@query
def logistic_accuracy(spark, d):
    return _fit_and_score(spark, d, learn.logistic_regression())


@query
def forest_accuracy(spark, d):
    return _fit_and_score(spark, d, learn.random_forest())


DENSE_BYTES = 1 << 28      # a forest holds four bytes per row and feature; so many of them to a task


def _language_accuracy(spark, d, estimator, features=1 << 12):
    """Accuracy at telling a document's language from its character pairs, per side
    of the split, and whether it beats the share of that side's most frequent language by ``MARGIN``."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang").where("lang IS NOT NULL")
    docs = docs.withColumn("chars", F.split(F.lower(F.coalesce("text", F.lit(""))), ""))
    docs = docs.select("doc_id", "lang", F.zip_with(
        "chars", F.slice("chars", F.lit(2), F.size("chars")),
        lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))).alias("pairs"))
    side = F.when(fe.split_bucket("doc_id", method="md5") < 70, "train").otherwise("test")
    rows = HashingTF(numFeatures=features, inputCol="pairs", outputCol="features") \
        .transform(docs.withColumn("split", side)).select("split", "lang", "features")
    path = scratch_path(spark, "language_rows")
    rows.write.parquet(path)                     # prepared once, read by every pass of the fit
    rows = spark.read.parquet(path)
    train = rows.where("split = 'train'")
    rows = fe.string_indexer(["lang"], ["label"]).fit(train).transform(rows)
    train = rows.where("split = 'train'")
    train = _dealt(train, -(-train.count() * features * 4 // DENSE_BYTES))
    scored = learn.split_accuracy(estimator.fit(train), rows)
    most = rows.groupBy("split", "lang").count().groupBy("split").agg((F.max("count") / F.sum("count")).alias("most"))
    return scored.join(most, "split").select("split", "n_rows", F.round("most", 6).alias("majority_share"),
                                             (F.col("accuracy") > F.col("most") + MARGIN).alias("beats_majority"))


@query
def logistic_language(spark, d):
    return _language_accuracy(spark, d, learn.logistic_regression(max_iter=20))


@query
def forest_language(spark, d):
    return _language_accuracy(spark, d, learn.random_forest(num_trees=10, max_depth=6))


# --- T1-T10, S7: streaming -----------------------------------------------------


BLOCK_EVENTS = 2500
WIDE_BLOCK_EVENTS = 100_000


@query
def decode_json_bytes(spark, d):
    messages = decode.encode_json_value(dom.sensor(spark, d))
    return decode.decode_json_value(messages, schemas.SENSOR)


@query
def decode_json_corrupt(spark, d):
    """By event id: cut messages, messages that are not ASCII, and empty objects."""
    messages = table(spark, d, "events").select(_message().cast("binary").alias("value"))
    out = decode.decode_json_value(messages, _MESSAGE, keep_raw=True)
    return out.select("Index", "Device", "raw_text", "is_corrupt")


_MESSAGE = T.StructType([T.StructField("Index", T.LongType()), T.StructField("Device", T.StringType())])


def _message():
    key = F.col("event_id")
    device = F.when(key % 10 == 1, "dé").otherwise(F.concat(F.lit("dev_"), F.col("user_id").cast("string")))
    whole = F.concat(F.lit('{"Index": '), key.cast("string"), F.lit(', "Device": "'), device, F.lit('"}'))
    return F.when(key % 10 == 0, F.substring(whole, 1, 12)).when(key % 10 == 2, "{}").otherwise(whole)


def _run_blocks(run, rows, name):
    """Runs over ``rows`` in the order of their ``block``, each tested by the model of those before it
    and then learnt.  One block per micro-batch if the learner wants its rows together; many, if it
    can go through them epoch by epoch, or once it learns no more (``retrain_until``)."""
    spark = run.spark
    path = scratch_path(spark, f"{name}_blocks")
    rows.write.parquet(path)                       # derived once, read for either part
    rows = spark.read.schema(rows.schema).parquet(path)
    blocks = rows.select("block").distinct()
    if blocks.where("block IS NULL").count():
        raise ValueError("a row belongs to no block")
    epochs = broadcast_if_bounded(ranking.numbered(blocks, ["block"], "epoch"))
    rows = rows.join(epochs, "block")
    if run.steps():
        _run_packs(rows, f"{name}_steps", run.run_steps)
        return run.metrics()
    single = F.lit(True) if run.retrain_until is None else F.col("epoch") < run.retrain_until
    staged = scratch_path(spark, f"{name}_source")
    first = rows.where(single).drop("epoch")
    replay.stage_blocks(first, "block", staged)
    run.run(spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(staged))
    if run.retrain_until is not None:
        _run_packs(rows.where(~single), f"{name}_later", run.run_frozen)
    return run.metrics()


def _run_packs(rows, name, run):
    """``run`` on a stream of ``rows`` in which many whole epochs share a micro-batch."""
    spark = rows.sparkSession
    rows = rows.drop("block").withColumn("pack", replay.pack_of(F.col("epoch")))
    staged = scratch_path(spark, name)
    replay.stage_blocks(rows, "pack", staged)
    if replay.list_epochs(spark, staged, name="pack"):
        run(spark.readStream.schema(rows.schema)
            .option("maxFilesPerTrigger", replay.FILES_PER_BATCH).parquet(staged))


def _kept_epoch(batch):
    return [c for c in ("epoch",) if c in batch.columns]


def _sensor_blocks(spark, d, block_events=BLOCK_EVENTS):
    return dom.sensor(spark, d).withColumn("block", F.floor(F.col("Index") / block_events))


def _majority_metrics(spark, d, block_events, retrain_until=None):
    run = prequential.Prequential(spark, lambda b: b.select(F.col("gt").alias("label"), *_kept_epoch(b)),
                                  learn.MajorityClass(), scratch_path(spark, "prequential_majority_state"),
                                  retrain_until=retrain_until)
    return _run_blocks(run, _sensor_blocks(spark, d, block_events), "prequential_majority")


@query
def prequential_metrics(spark, d):
    return _majority_metrics(spark, d, BLOCK_EVENTS)


@query
def prequential_metrics_wide(spark, d):
    """Micro-batches of 100,000 rows; learns from the first 39, as the reference's stream does."""
    return _majority_metrics(spark, d, WIDE_BLOCK_EVENTS, retrain_until=40)


@query
def prequential_forest(spark, d):
    def prepare(batch):
        return fe.hashed_stream_features(batch, "gt", GT_VOCABULARY, ["User", "Device"],
                                         ["Arrival_Time", "Creation_Time", "x", "y", "z"], keep=_kept_epoch(batch))

    run = prequential.Prequential(spark, prepare, learn.random_forest(), scratch_path(spark, "prequential_forest_state"))
    return _run_blocks(run, _sensor_blocks(spark, d), "prequential_forest").select("epoch", "n_rows", "cum_rows",
                                F.col("n_correct").between(0, F.col("n_rows")).alias("scored"))


DOC_BLOCK = 250
LETTERS = "ñóíáéèàçùêäößüwkyhjz"
MARGIN = 0.1


def _letter_shares(batch):
    """Label and the share of each of some letters in the text, whose other letters are read once."""
    own = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    share = lambda few, n: F.array(*[
        (F.length(few) - F.length(F.translate(few, c, ""))) / F.greatest(n, F.lit(1)) for c in LETTERS])
    shares = own(F.lower(F.coalesce("text", F.lit(""))), lambda t: own(
        F.regexp_replace(t, f"[^{LETTERS}]+", ""), lambda few: share(few, F.length(t))))
    return batch.select(F.col("lang").alias("label"), *_kept_epoch(batch),
                        shares.cast("array<double>").alias("features"))


@query
def prequential_tree(spark, d):
    """An incremental tree tells the language of documents, block by block; whether its running
    accuracy beats the share of the most frequent language by ``MARGIN``."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang").where("lang IS NOT NULL")
    run = prequential.Prequential(spark, _letter_shares, tree.HistogramTree(confidence=0.05, tie=0.15),
                                  scratch_path(spark, "prequential_tree"))
    m = _run_blocks(run, docs.withColumn("block", F.floor(F.col("doc_id") / DOC_BLOCK)), "prequential_tree")
    most = docs.groupBy("lang").count().agg((F.max("count") / F.sum("count")).alias("share"))
    overall = m.agg((F.max_by("cum_correct", "epoch") / F.max_by("cum_rows", "epoch")).alias("accuracy"))
    return m.select("epoch", "n_rows", "cum_rows", F.round(most.scalar(), 6).alias("majority_share"),
                    (overall.scalar() > most.scalar() + MARGIN).alias("beats_majority"))


DEAD_BLOCK = 4_000


@query
def stream_dead_letters(spark, d):
    """A stream of messages, some of them broken: records and dead letters of committed batches."""
    path = scratch_path(spark, "messages")
    raw = table(spark, d, "events").select("event_id", _message().cast("binary").alias("value"))
    block = F.floor(F.col("event_id") / DEAD_BLOCK)
    replay.stage_blocks(raw.withColumn("pack", replay.pack_of(block)), "pack", path)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", replay.FILES_PER_BATCH).parquet(path)
    sink = deadletter.DeadLetterSink(spark, _MESSAGE, scratch_path(spark, "dead_letters"))
    sink.run(stream)
    return sink.good().withColumn("raw_text", F.lit(None).cast("string")) \
        .unionByName(sink.dead(), allowMissingColumns=True)


# --- A1, A4, A6: generic aggregates ------------------------------------------


@query
def numeric_means_by_class(spark, d):
    s = _sensor(spark, d).select("gt", "x", "y", "z", "Hour", "Minutes")
    m = agg.mean_numeric(s, ["gt"])
    return m.select("gt", *[F.round(c, 6).alias(c) for c in m.columns if c != "gt"])


@query
def numeric_sums_by_location(spark, d):
    """Sum of every numeric column per location (A4).  Sums decompose, so
    facts are summed per user first and only per-user rows are joined."""
    t = dom.tickets(spark, d).select("user_id", "n_tickets", "movie_id")
    per_user = agg.sum_numeric(t, ["user_id"], prefix="")
    joined = per_user.join(dom.users(spark, d), F.col("user_id") == F.col("id"), "left")
    return agg.sum_numeric(joined.select("user_location", "n_tickets", "movie_id"),
                           ["user_location"])


@query
def accounting_totals(spark, d):
    """Global counts whose per-location parts must add up (A1, A5)."""
    searches = agg.row_count(dom.search_years(spark, d), "n_searches")
    users = agg.row_count(dom.users(spark, d, all_customers=True), "n_users")
    units = dom.tickets(spark, d).agg(F.sum("n_tickets").alias("n_units"))
    return searches.select("n_searches", users.select("n_users").scalar().alias("n_users"),
                           units.select("n_units").scalar().alias("n_units"))


# --- SURVEY 2.14: saved-search matching -------------------------------------


@query
def search_matches(spark, d):
    return search.match_counts(dom.saved_searches(spark, d), dom.searchable_movies(spark, d))


@query
def search_pairs(spark, d):
    """Every search with each movie it matches; one row without a movie if none does."""
    return search.match_searches(dom.saved_searches(spark, d), dom.searchable_movies(spark, d))


@query
def demand_array_matrix_discovered(spark, d):
    """Value domain discovered in Spark, then the matrix (A20 + A17); only
    the bounded list of distinct values reaches the driver."""
    searches = dom.searches(spark, d)
    values = matrix.collect_domain(matrix.array_domain(dom.searched_genres(spark, d), "genres"))
    return matrix.demand_matrix(searches, dom.users(spark, d), "genres", values, mode="array")


# --- C1, C4, C6: source-format text -> CSV -> parsed tables ------------------

def _csv_roundtrip(spark, raw, name, schema, reader=readers.read_csv_quoted):
    path = scratch_path(spark, name)
    sinks.write_csv(raw, path)
    return reader(spark, path, schema)


@query
def users_csv_parse(spark, d):
    raw = _csv_roundtrip(spark, dom.users_raw(spark, d), "users_csv", schemas.USERS_RAW)
    return parsers.parse_users(raw)


@query
def searches_csv_parse(spark, d):
    raw = _csv_roundtrip(spark, dom.searches_raw(spark, d), "searches_csv",
                         schemas.SEARCHES_RAW)
    return _as_text(parsers.parse_searches(raw))


@query
def movies_csv_parse(spark, d):
    raw = _csv_roundtrip(spark, dom.movies_raw(spark, d), "movies_csv", schemas.MOVIES_RAW,
                         multiline.read_csv_multiline)
    return _as_text(parsers.parse_movies(raw))


@query
def movies_csv_parse_clean(spark, d):
    raw = _csv_roundtrip(spark, dom.movies_raw(spark, d), "movies_csv_clean",
                         schemas.MOVIES_RAW, multiline.read_csv_multiline)
    return _as_text(parsers.parse_movies(raw, mode="clean"))


@query
def credits_text_parse_clean(spark, d):
    c = dom.credits(spark, d, mode="clean")
    return c.select("id", F.array_join("actors", "|").alias("actors"),
                    F.array_join("director", "|").alias("director"))


@query
def pivot_count_filled(spark, d):
    """A10 with absent cells as 0 instead of NULL."""
    return profile.pivot_count(_sensor(spark, d), "User", "gt", GT_VALUES, fill=0)


@query
def demand_scalar_long(spark, d):
    """Long form of the order-year matrix (scalar mode)."""
    return matrix.demand_long(dom.search_years(spark, d), dom.users(spark, d), "year", mode="scalar")


@query
def groups_always_above_long(spark, d):
    return staged.groups_always_above(dom.curtain(spark, d), CURTAIN_THRESHOLD, as_list=False)
