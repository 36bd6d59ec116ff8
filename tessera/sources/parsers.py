"""Raw text tables -> typed tables (C1-C4, C6, C7, curtain readings).

Each parser takes the raw all-string DataFrame (so it is independent of
where the text came from) and returns the typed table with one
projection; ids and counts go through ``try_cast`` so junk becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars, text

SEARCH_LIST_COLUMNS = ("genres", "lang", "actors", "director", "cities", "country", "company")


def parse_users(raw: DataFrame) -> DataFrame:
    """``user_id, user_location`` -> ``id int, user_location``."""
    return raw.select(scalars.to_int("user_id").alias("id"), "user_location")


def parse_tickets(raw: DataFrame) -> DataFrame:
    """-> ``user_id, movie_id, n_tickets int, city``; cinema dropped."""
    return raw.select(scalars.to_int("user_id").alias("user_id"),
                      scalars.to_int("movie_id").alias("movie_id"),
                      scalars.to_int("number_of_tickets").alias("n_tickets"),
                      "city")


def parse_searches(raw: DataFrame) -> DataFrame:
    """Saved searches: seven list literals -> arrays, year -> int (C4)."""
    r = raw.withColumnsRenamed({"from_realese_date": "date", "production_company": "company"})
    return r.select(
        scalars.to_int("user_id").alias("id"),
        *[text.parse_list_literal(c).alias(c) for c in SEARCH_LIST_COLUMNS[:6]],
        scalars.to_int(F.translate("date", text.LIST_LITERAL_CHARS, "")).alias("date"),
        text.parse_list_literal("company").alias("company"))


def parse_movies(raw: DataFrame, mode: str = "compat") -> DataFrame:
    """Movies with nested-list text columns -> arrays.

    ``compat`` reproduces the word-position parse (first word of a
    genre, glued company / country names); ``clean`` parses the lists
    exactly.  Dates ``dd/MM/yyyy``; bad dates become NULL.
    """
    m = raw.select(
        scalars.to_int("movie_id").alias("id"),
        F.col("genres"), F.col("production_companies").alias("prod_comp"),
        F.col("production_countries").alias("countries"),
        scalars.date_from_pattern("release_date").alias("release_date"),
        F.col("spoken_languages").alias("languages"),
        text.parse_list_literal("cities").alias("cities"))
    if mode == "clean":
        return m.select(
            "id",
            text.names_clean("genres").alias("genres"),
            text.names_clean("prod_comp").alias("prod_comp"),
            text.names_clean("countries").alias("countries"),
            "release_date",
            text.names_clean("languages", text.LANGUAGE_KEY).alias("languages"),
            "cities")
    m = text.with_names_compat(m, "genres", "genres")
    m = text.with_names_compat(m, "prod_comp", "prod_comp", squeeze_spaces=True)
    m = text.with_names_compat(m, "countries", "countries", squeeze_spaces=True)
    m = text.with_names_compat(m, "languages", "languages", key=text.LANGUAGE_KEY)
    return m.select("id", "genres", "prod_comp", "countries", "release_date",
                    "languages", "cities")


def parse_credits(raw: DataFrame, column: str = "cast,crew,id",
                  mode: str = "clean") -> DataFrame:
    """One raw ``cast,crew,id`` text column -> ``id, actors, director``."""
    return text.with_credits_parsed(raw, column, mode=mode)


def parse_curtain(raw: DataFrame) -> DataFrame:
    """``StartedOn`` ``d/m/...`` text + value/face/curtain -> typed rows.

    Day and month are both ints (``01`` and ``1`` are one day); the
    year is ignored, as in the source format's consumers.
    """
    return raw.select(scalars.split_part_int("StartedOn", "/", 0).alias("day"),
                      scalars.split_part_int("StartedOn", "/", 1).alias("month"),
                      F.col("value").try_cast("double").alias("value"),
                      F.col("face"), F.col("curtain"))
