"""Native text-to-array functions (no Python UDFs).

Everything here returns a ``Column`` (or adds columns to a DataFrame)
built from Spark SQL string / array / higher-order functions, so it
runs inside whole-stage codegen on the executors.

Regex note: ``\\W`` is ASCII-only in Java regex, so accented letters
count as separators (``Français`` -> ``Fran``, ``ais``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The key names and patterns of the nested-list text format.
# Results must match the source format, so they are stated here, together,
# as plain text.
NAME_KEY = "name"                 # key whose value is the item name
LANGUAGE_KEY = "iso_639_1"        # key of the language code
JOB_KEY, DIRECTOR = "job", "Director"   # crew entries that are directors
AFTER_CAST_NAME = "order"         # key that follows the name in a cast entry
AFTER_CREW_NAME = "profile_path"  # key that follows the name in a crew entry
NON_WORD = r"\W+"                 # separators between words
BRACKET_GROUP = r"\[(.*?)\]"      # one non-greedy [...] group
LIST_LITERAL_CHARS = "[]'"        # characters stripped from a list literal
LIST_SEPARATOR = ", "             # item separator of a list literal
# ---------------------------------------------------------------------------

# Three CSV fields of one line, quoted ones with doubled quotes inside.
_CSV_LINE = r'^("(?:[^"]++|"")*+"|[^"]*?),("(?:[^"]++|"")*+"|[^"]*?),([^,"]*)$'
# The same without doubling: two lists and a number, told apart by their brackets.
_LOOSE_LINE = r'^"?(\[.*?\])"?,"?(\[.*\])"?,([^,"]*)$'
# Tokens of a Python literal: a quoted text, or whatever stands between.
_LITERAL_TOKEN = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++"""
_ENTRIES = "array<map<string,string>>"
# Marks that never stand in a text (Unicode noncharacters): fields of a line cut either way, a pair.
_STRICT, _LOOSE, _PAIR_MARK = "\uffff", "\ufffe", "\uffff"
_QUOTED = r"""(?:'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")"""
_PLAIN = r"(?:None|True|False|-?[0-9]++(?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?)"
# What a list of flat dicts looks like once its pairs are marks.
_FLAT_DICT = rf"\{{\s*+{_PAIR_MARK}(?:\s*+,\s*+{_PAIR_MARK})*+\s*+\}}"
_FLAT_LIST = rf"^\s*+\[\s*+(?:{_FLAT_DICT}(?:\s*+,\s*+{_FLAT_DICT})*+)?\s*+\]\s*+$"
_DICT = rf"\{{(?:[^'\"{{}}]++|{_QUOTED})*+\}}"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_list_literal(c: str | Column) -> Column:
    """``"['a', 'b']"`` -> ``['a', 'b']``.

    Strips brackets and apostrophes, then splits on ``", "``.  Both
    ``[]`` and ``['']`` give ``['']`` (one empty string), which the
    presence tests rely on.  Apostrophes inside items are removed too.
    """
    return F.split(F.translate(_col(c), LIST_LITERAL_CHARS, ""), LIST_SEPARATOR)


def first_bracket(c: str | Column) -> Column:
    """Whole match of the first ``[...]`` group."""
    return F.regexp_extract(_col(c), BRACKET_GROUP, 0)


def nth_bracket_content(c: str | Column, n: int) -> Column:
    """Content of the n-th ``[...]`` group, NULL if there are fewer."""
    groups = F.regexp_extract_all(_col(c), F.lit(BRACKET_GROUP), F.lit(1))
    return F.try_element_at(groups, F.lit(n))


def last_token(c: str | Column, sep: str = ",") -> Column:
    """Last ``sep``-separated token (X3); ``sep`` is a literal string."""
    return F.element_at(F.split(_col(c), _regex_literal(sep)), -1)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in s)


def words_after(words: Column, marker: str, n: int = 1) -> Column:
    """For every element equal to ``marker`` join the next ``n`` elements.

    ``words`` should be a column reference (materialise the split first,
    see :func:`with_words_after`) so the lambda does not re-split the
    text for every hit.  Past the end the result is ``''``.
    """
    hits = F.transform(
        words,
        lambda x, i: F.when(x == F.lit(marker),
                            F.array_join(F.slice(words, i + 2, F.lit(n)), " ")))
    return F.filter(hits, lambda y: y.isNotNull())


def with_words_after(df: DataFrame, text: str | Column, marker: str, n: int,
                     out: str, squeeze_spaces: bool = False,
                     pre_replace: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add ``out`` = words following ``marker`` in ``text``.

    Steps: optional literal replacements, optionally drop all spaces
    (multi-word names stay whole but glued), ``\\W+`` -> space, split on
    space, then :func:`words_after`.  The split array is a separate
    projection so it is computed once per row.
    """
    cleaned = _col(text)
    for pattern, repl in pre_replace or []:
        cleaned = F.regexp_replace(cleaned, pattern, repl)
    if squeeze_spaces:
        cleaned = F.regexp_replace(cleaned, " ", "")
    cleaned = F.regexp_replace(cleaned, NON_WORD, " ")
    tmp = f"__{out}_words"
    return (df.withColumn(tmp, F.split(cleaned, " "))
              .withColumn(out, words_after(F.col(tmp), marker, n))
              .drop(tmp))


# --- nested-list columns in the two parse modes ---------------------------

def with_names_compat(df: DataFrame, col: str, out: str, key: str = NAME_KEY,
                      n: int = 1, squeeze_spaces: bool = False) -> DataFrame:
    """Compat parse of ``[{'k': v, 'name': 'X Y'}, ...]`` to names.

    Keeps the known truncations of the word-position approach: with
    ``n=1`` a multi-word name keeps its first word; ``squeeze_spaces``
    glues it instead.
    """
    return with_words_after(df, col, key, n, out, squeeze_spaces=squeeze_spaces)


def _token_to_json(t: Column) -> Column:
    """A token of a Python literal as JSON: a quoted text, or what stands between two."""
    body = F.substring(t, F.lit(2), F.length(t) - 2)
    # the plain search first: most tokens need no pattern at all
    escaped = F.regexp_replace(F.replace(body, F.lit("\\'"), F.lit("'")),
                               r"\\x([0-9a-f]{2})", r"\\u00$1")
    body = F.when(F.contains(body, F.lit("\\")), escaped).otherwise(body)
    single = F.when(F.contains(body, F.lit('"')), F.regexp_replace(body, r'(?<!\\)"', r'\\"')) \
        .otherwise(body)
    quoted = F.concat(F.lit('"'), F.when(F.startswith(t, F.lit("'")), single).otherwise(body),
                      F.lit('"'))
    json = t
    for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
        json = F.regexp_replace(json, rf"\b{word}\b", value)
    bare = F.when(F.rlike(t, F.lit("None|True|False")), json).otherwise(t)
    return F.when(F.startswith(t, F.lit("'")) | F.startswith(t, F.lit('"')), quoted).otherwise(bare)


def literal_to_json(c: str | Column) -> Column:
    """A Python list or dict literal as JSON text, token by token.

    Quotes are turned and escapes rewritten inside quoted texts only, and
    ``None``, ``True`` and ``False`` are replaced outside them only, so
    names may hold brackets, apostrophes or the word None.
    """
    tokens = F.regexp_extract_all(_col(c), F.lit(_LITERAL_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, _token_to_json), "")


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair(key: str) -> str:
    """A ``key: value`` pair of a flat dict; group 1 is the quoted value if the key is ``key``."""
    return rf"""(?:'{key}'|"{key}")\s*+:\s*+({_QUOTED})|{_QUOTED}\s*+:\s*+(?:{_QUOTED}|{_PLAIN})"""


def _skeleton(c: Column, key: str) -> Column:
    """The list with a mark for each pair; only marks and brackets are left of a list of flat dicts."""
    return F.regexp_replace(c, _pair(key), _PAIR_MARK)


def entries(c: str | Column) -> Column:
    """A Python-style list of dicts as an array of maps; NULL if malformed."""
    return F.from_json(literal_to_json(c), _ENTRIES)


def names_clean(c: str | Column, key: str = NAME_KEY) -> Column:
    """Exact parse of a Python-style list of dicts: the ``key`` values.

    A list of flat dicts that all have a quoted value of the key is read by its pairs; any
    other goes through :func:`entries` token by token.
    """
    def read(c: Column) -> Column:
        quoted = F.filter(F.regexp_extract_all(c, F.lit(_pair(key)), F.lit(1)), lambda v: v != "")
        return _once(F.struct(quoted.alias("q"), _skeleton(c, key).alias("s")), lambda x: F.when(
            F.rlike(x["s"], F.lit(_FLAT_LIST)) & (F.size(x["q"]) == F.regexp_count(x["s"], F.lit(r"\{"))),
            F.from_json(F.concat(F.lit("["), F.array_join(F.transform(x["q"], _token_to_json), ","), F.lit("]")),
                        "array<string>")).otherwise(F.transform(entries(c), lambda m: m[key])))

    return _once(_col(c), read)


def names_where(c: str | Column, key: str, value: str, name: str = NAME_KEY) -> Column:
    """The ``name`` of the dicts whose ``key`` is ``value``; of a list of flat dicts only those
    that hold the value are parsed."""
    def read(c: Column) -> Column:
        some = F.filter(F.regexp_extract_all(c, F.lit(_DICT), F.lit(0)), lambda d: F.contains(d, F.lit(value)))
        parsed = entries(F.when(F.rlike(_skeleton(c, name), F.lit(_FLAT_LIST)),
                                F.concat(F.lit("["), F.array_join(some, ","), F.lit("]"))).otherwise(c))
        return F.transform(F.filter(parsed, lambda m: m[key] == value), lambda m: m[name])

    return _once(_col(c), read)


def _csv_fields(line: Column) -> Column:
    """The three CSV fields of a line, unquoted; a line whose quotes are not doubled as CSV
    wants it is split at its lists, and one that is neither has empty fields."""
    def cut(pattern: str, mark: str) -> Column:
        return F.regexp_replace(line, pattern, f"{mark}$1{mark}$2{mark}$3")

    bare = lambda f: F.when(F.startswith(f, F.lit('"')), F.replace(
        F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f)
    none = F.array(*[F.lit("")] * 3)
    loose = _once(cut(_LOOSE_LINE, _LOOSE), lambda x: F.when(
        F.startswith(x, F.lit(_LOOSE)), F.slice(F.split(x, _LOOSE, -1), 2, 3)).otherwise(none))
    return _once(cut(_CSV_LINE, _STRICT), lambda x: F.when(
        F.startswith(x, F.lit(_STRICT)), F.transform(F.slice(F.split(x, _STRICT, -1), 2, 3), bare)).otherwise(loose))


def _two_words(name: Column, following: str, drop_digits: bool) -> Column:
    """The documented truncation: the first two words of a name; one word alone is
    followed by the key that comes after the name."""
    plain = F.regexp_replace(name, "[0-9]", " ") if drop_digits else name
    words = F.filter(F.split(F.regexp_replace(plain, NON_WORD, " "), " "), lambda w: w != "")
    return F.array_join(F.slice(F.concat(words, F.array(F.lit(following))), 1, 2), " ")


def with_credits_parsed(df: DataFrame, raw: str, mode: str = "clean",
                        keep_raw: bool = False) -> DataFrame:
    """Parse a raw ``cast,crew,id`` line into ``id``, ``actors``, ``director``.

    The line is split as CSV, both lists are parsed exactly, and the
    directors are the crew entries with that job.  ``mode="compat"`` then
    cuts every name to two words (cast names without digits).  A line or
    list that is malformed gives NULL.
    """
    line, fields = F.col(raw), F.col("__fields")
    cut = df.select(line, F.when(line.isNotNull(), _csv_fields(line)).alias("__fields"))   # once per line
    people = cut.select(
        *([line] if keep_raw else []),
        F.trim(F.get(fields, F.lit(2))).try_cast("int").alias("id"),
        names_clean(F.get(fields, F.lit(0))).alias("actors"),
        names_where(F.get(fields, F.lit(1)), JOB_KEY, DIRECTOR).alias("director"))
    if mode == "clean":
        return people
    return people.withColumns({
        "actors": F.transform("actors", lambda n: _two_words(n, AFTER_CAST_NAME, True)),
        "director": F.transform("director", lambda n: _two_words(n, AFTER_CREW_NAME, False))})
