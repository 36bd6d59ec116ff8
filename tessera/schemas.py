"""Declared schemas of the raw inputs and of the typed tables.

Raw CSV schemas are all-string: the text is cleaned and cast natively
afterwards (``try_cast``), so a junk cell becomes NULL instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


STRING_ARRAY = T.ArrayType(T.StringType(), True)

# --- raw text inputs -------------------------------------------------------
USERS_RAW = all_strings("user_id", "user_location")
TICKETS_RAW = all_strings("user_id", "movie_id", "number_of_tickets", "city", "cinema_id")
SEARCHES_RAW = all_strings("user_id", "genres", "lang", "actors", "director", "cities",
                           "country", "from_realese_date", "production_company")
MOVIES_RAW = all_strings("movie_id", "genres", "production_companies", "production_countries",
                         "release_date", "spoken_languages", "cities", "overview", "revenue",
                         "tagline", "title")
CURTAIN_RAW = all_strings("StartedOn", "value", "face", "curtain")

# --- typed tables ----------------------------------------------------------
USERS = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("user_location", T.StringType(), True),
])
TICKETS = T.StructType([
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("movie_id", T.IntegerType(), True),
    T.StructField("n_tickets", T.IntegerType(), True),
    T.StructField("city", T.StringType(), True),
])
SEARCHES = T.StructType(
    [T.StructField("id", T.IntegerType(), True)]
    + [T.StructField(c, STRING_ARRAY, True)
       for c in ("genres", "lang", "actors", "director", "cities", "country")]
    + [T.StructField("date", T.IntegerType(), True),
       T.StructField("company", STRING_ARRAY, True)])
MOVIES = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("genres", STRING_ARRAY, True),
    T.StructField("prod_comp", STRING_ARRAY, True),
    T.StructField("countries", STRING_ARRAY, True),
    T.StructField("release_date", T.DateType(), True),
    T.StructField("languages", STRING_ARRAY, True),
    T.StructField("cities", STRING_ARRAY, True),
])
CREDITS = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("actors", STRING_ARRAY, True),
    T.StructField("director", STRING_ARRAY, True),
])

# Sensor readings (JSON lines or a message stream).
SENSOR = T.StructType([
    T.StructField("Arrival_Time", T.LongType(), True),
    T.StructField("Creation_Time", T.LongType(), True),
    T.StructField("Device", T.StringType(), True),
    T.StructField("Index", T.LongType(), True),
    T.StructField("Model", T.StringType(), True),
    T.StructField("User", T.StringType(), True),
    T.StructField("gt", T.StringType(), True),
    T.StructField("x", T.DoubleType(), True),
    T.StructField("y", T.DoubleType(), True),
    T.StructField("z", T.DoubleType(), True),
])

CURTAIN = T.StructType([
    T.StructField("day", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("face", T.StringType(), True),
    T.StructField("curtain", T.StringType(), True),
])

MODEL_INPUT = T.StructType([
    T.StructField("label", T.DoubleType(), True),
    T.StructField("features", VectorUDT(), True),
])
