import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of the same names as the operators' own working columns.
CLASH = ("words", "fp", "key", "size", "base", "spans", "hashes", "range", "found", "id", "taken")

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards brew a potion of "
         "moonlight and thyme near the old harbour wall").split()


def prose(n: int, seed: int) -> str:
    """``n`` words, different for each seed."""
    return " ".join(f"{PROSE[(i * 7 + seed * 3 + i * i * (seed % 5 + 1)) % len(PROSE)]}{(i * seed) % 97}"
                    for i in range(n))


def edge_rows() -> list[tuple]:
    """Documents with NULLs, empty, blank and long texts, ties, repeats and a repeated id."""
    long = prose(30_000, 3)
    rows = [(1, prose(80, 1), "en", "a", 1), (2, prose(80, 1), "en", "b", 1), (3, None, "en", "a", None),
            (4, "", None, None, 0), (5, " \t\n ", "fr", "b", 4), (6, "one two", "en", "c", 7),
            (7, long, "en", "a", len(long)), (8, prose(80, 1) + " extra", "en", "a", 1),
            (9, prose(200, 9), "de", None, 1), (9, prose(200, 9), "de", None, 1),
            (10, "Größe ▁ \U0001f600 naïve x\n\nline\nline", "de", "c", 30),
            (None, prose(60, 4), "en", "a", 5), (11, "a\u0000b\x0bc", "en", "c", 5)]
    return rows + [(20 + i, prose(60 + i, 20 + i), "en", "abc"[i % 3], 1) for i in range(20)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.withColumns({name: F.lit("x") for name in CLASH})


def table_of(df) -> list[tuple]:
    """Rows in an order of their own, floats rounded."""
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()),
                  key=repr)
