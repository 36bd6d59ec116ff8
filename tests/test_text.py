"""Text -> array functions on the literal fixture rows."""

from pyspark.sql import functions as F

from conftest import fixture_path
from tessera import schemas
from tessera.functions import text
from tessera.sources import parsers, readers


def test_list_literal_edge_cases(spark):
    df = spark.createDataFrame([("['a', 'b']",), ("['']",), ("[]",), ("['O'Neil']",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(text.parse_list_literal("t")).collect()]
    assert got == [["a", "b"], [""], [""], ["ONeil"], None]


def test_words_after_marker_past_end_and_repeats(spark):
    df = spark.createDataFrame([("x the a b the c the",), ("nothing here",)], "t string")
    out = text.with_words_after(df, "t", "the", 2, "h").select("h").collect()
    assert out[0][0] == ["a b", "c the", ""]
    assert out[1][0] == []


def test_bracket_helpers(spark):
    df = spark.createDataFrame([("[a] x [b c] y,12",), ("[only],7",)], "t string")
    rows = df.select(text.first_bracket("t"), text.nth_bracket_content("t", 2),
                     text.last_token("t")).collect()
    assert tuple(rows[0]) == ("[a]", "b c", "12")
    assert tuple(rows[1]) == ("[only]", None, "7")


def test_credits_compat_and_clean(spark):
    raw = readers.read_single_column_tsv(spark, fixture_path("credits.csv"))
    assert raw.columns == ["cast,crew,id"]
    compat = {r["id"]: r for r in parsers.parse_credits(raw, mode="compat").collect()}
    assert compat[862]["actors"] == ["Mira Sol", "Zed order"]
    assert compat[862]["director"] == ["Ivo Lane"]
    assert compat[863]["actors"] == [] and compat[863]["director"] == []
    clean = {r["id"]: r for r in parsers.parse_credits(raw, mode="clean").collect()}
    assert clean[862]["actors"] == ["Mira Sol Vance", "Zed"]
    assert clean[862]["director"] == ["Ivo Lane"]


def test_movies_compat_and_clean(spark):
    raw = readers.read_csv_quoted(spark, fixture_path("movies.csv"), schemas.MOVIES_RAW,
                                  multiline=True)
    rows = {r["id"]: r for r in parsers.parse_movies(raw).collect()}
    m = rows[10]
    assert m["genres"] == ["Drama", "Science"]
    assert m["prod_comp"] == ["BlueKiteFilms"]
    assert m["countries"] == ["NewZealand"]
    assert m["languages"] == ["en", "fr"]
    assert str(m["release_date"]) == "2013-10-30"
    assert m["cities"] == ["Haifa", "Tel Aviv"]
    assert rows[11]["genres"] == [] and rows[11]["cities"] == [""]
    assert rows[11]["release_date"] is None          # 40/13/2013 -> NULL, no error
    assert rows[12]["genres"] is None and rows[12]["cities"] is None
    clean = {r["id"]: r for r in parsers.parse_movies(raw, mode="clean").collect()}
    assert clean[10]["genres"] == ["Drama", "Science Fiction"]
    assert clean[10]["prod_comp"] == ["Blue Kite Films"]
    assert clean[10]["countries"] == ["New Zealand"]
    assert clean[10]["languages"] == ["en", "fr"]


def test_searches_parse(spark):
    raw = readers.read_csv_quoted(spark, fixture_path("queries.csv"), schemas.SEARCHES_RAW)
    rows = {r["id"]: r for r in parsers.parse_searches(raw).collect()}
    assert rows[1]["genres"] == ["Drama", "Action"]
    assert rows[1]["director"] == [""]
    assert rows[3]["actors"] == [""]                 # [] parses to ['']
    assert rows[3]["genres"] == ["Drama", ""]
    assert rows[2]["date"] == 2015


def test_users_and_tickets_parse(spark):
    users = parsers.parse_users(readers.read_csv_quoted(spark, fixture_path("users.csv"),
                                                        schemas.USERS_RAW))
    assert users.count() == 4
    t = parsers.parse_tickets(readers.read_csv_quoted(spark, fixture_path("tickets.csv"),
                                                      schemas.TICKETS_RAW))
    assert t.columns == ["user_id", "movie_id", "n_tickets", "city"]
    bad = t.where(F.col("user_id") == 3).first()
    assert bad["n_tickets"] is None                  # 'x' -> NULL, not an error


def test_clean_parse_keeps_apostrophes_and_long_names(spark):
    line = ("\"[{'cast_id': 1, 'character': 'A', 'credit_id': 'x', 'gender': 1, 'id': 3, "
            "'name': \"D'Arcy Vole\", 'order': 0, 'profile_path': None}, {'cast_id': 2, "
            "'character': 'B', 'credit_id': 'y', 'gender': 2, 'id': 4, "
            "'name': 'Ann Lee Ray', 'order': 1, 'profile_path': None}]\","
            "\"[{'credit_id': 'z', 'department': 'Directing', 'gender': 2, 'id': 5, "
            "'job': 'Director', 'name': 'Jo-Ann Kim', 'profile_path': None}]\",77")
    raw = spark.createDataFrame([(line,)], "`cast,crew,id` string")
    clean = parsers.parse_credits(raw, mode="clean").first()
    assert clean["id"] == 77
    assert clean["actors"] == ["D'Arcy Vole", "Ann Lee Ray"]
    assert clean["director"] == ["Jo-Ann Kim"]
    doubled = line.replace("\"D'Arcy Vole\"", "\"\"D'Arcy Vole\"\"")
    again = parsers.parse_credits(spark.createDataFrame([(doubled,)], "`cast,crew,id` string")).first()
    assert tuple(again) == tuple(clean)
    compat = parsers.parse_credits(raw, mode="compat").first()
    # compat: the apostrophe and the hyphen are separators, names keep two words
    assert compat["actors"] == ["D Arcy", "Ann Lee"]
    assert compat["director"] == ["Jo Ann"]


def test_credits_with_brackets_none_escapes_and_malformed_lines(spark):
    line = ("\"[{'character': 'Cop [voice]', 'name': 'Noah None', 'order': 0, 'profile_path': None}, "
            "{'character': 'x', 'name': 'qqdirectorqq \\\\ A\\'B', 'order': 1}]\","
            "\"[{'job': 'Writer', 'name': 'Director'}, {'job': 'Director', 'name': 'Ann Mary Lee'}]\",5")
    raw = spark.createDataFrame([(line,), ("no lists here",), (None,), ('"[{broken","[]",7',)],
                                "`cast,crew,id` string")
    got = {r["id"]: r for r in parsers.parse_credits(raw).collect() if r["id"] is not None}
    assert got[5]["actors"] == ["Noah None", "qqdirectorqq \\ A'B"]
    assert got[5]["director"] == ["Ann Mary Lee"]
    assert got[7]["actors"] is None and got[7]["director"] == []
    assert parsers.parse_credits(raw).count() == 4
    compat = {r["id"]: r for r in parsers.parse_credits(raw, mode="compat").collect()}
    assert compat[5]["director"] == ["Ann Mary"]
