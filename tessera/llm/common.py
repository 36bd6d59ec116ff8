"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

# The white space of every contract here: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage so that a lost executor never recomputes what came
    before, keeps the columns columnar and gives AQE real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of ``text`` in order; none for an empty or NULL text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def cumulative_starts(pieces: Column, matches: Column) -> Column:
    """Start offset (code points) of each match, from the text between matches.

    Works in blocks of 256 so that the cost stays near linear when one
    text holds very many matches.
    """
    block = 256
    steps = F.zip_with(pieces, matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("width")))

    def run(chunk: Column, begin: Column) -> Column:
        zero = F.struct(begin.cast("int").alias("at"),
                        F.array().cast("array<int>").alias("starts"))
        return F.aggregate(chunk, zero, lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["width"]).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + s["gap"])).alias("starts")))

    def blocks(all_steps: Column) -> Column:
        count = F.ceil(F.size(all_steps) / F.lit(block)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count - 1),
                             lambda b: F.slice(all_steps, b * block + 1, F.lit(block)))
        zero = F.struct(F.lit(0).alias("at"),
                        F.array().cast("array<array<int>>").alias("parts"))
        total = F.aggregate(chunks, zero, lambda acc, c: let(run(c, acc["at"]), lambda r: F.struct(
            r["at"].alias("at"),
            F.concat(acc["parts"], F.array(r["starts"])).alias("parts"))))
        return F.flatten(total["parts"])

    return let(steps, lambda s: F.when(F.size(s) > 0, blocks(s)).otherwise(
        F.array().cast("array<int>")))


CHUNK = 1024


def chunked(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points, cut in one pass."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))


def cut(chunks: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` (exclusive) of a chunked text.

    Costs no more than the part and two chunks; ``substring`` of the whole text would
    count from its start each time.
    """
    a, b = (begin / CHUNK).cast("int"), (end / CHUNK).cast("int")
    skip = begin - a * CHUNK
    part = lambda i: F.coalesce(F.get(chunks, i), F.lit(""))
    return F.when(a == b, F.substring(part(a), skip + 1, end - begin)).otherwise(F.concat(
        F.substring(part(a), skip + 1, F.lit(CHUNK)), F.array_join(F.slice(chunks, a + 2, b - a - 1), ""),
        F.substring(part(b), F.lit(1), end - b * CHUNK)))


def running_max(values: Column) -> Column:
    """For each number of an array the greatest one up to it, in blocks as :func:`cumulative_starts`."""
    block = 256
    number, numbers = "int", "array<int>"

    def run(chunk: Column, most: Column) -> Column:
        zero = F.struct(most.cast(number).alias("most"), F.array().cast(numbers).alias("out"))
        return F.aggregate(chunk, zero, lambda acc, v: let(F.greatest(acc["most"], v), lambda m: F.struct(
            m.alias("most"), F.concat(acc["out"], F.array(m)).alias("out"))))

    def blocks(every: Column) -> Column:
        count = F.ceil(F.size(every) / F.lit(block)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(every, b * block + 1, F.lit(block)))
        zero = F.struct(F.lit(-1).alias("most"), F.array().cast("array<array<int>>").alias("parts"))
        return F.flatten(F.aggregate(chunks, zero, lambda acc, c: let(run(c, acc["most"]), lambda r: F.struct(
            r["most"].alias("most"), F.concat(acc["parts"], F.array(r["out"])).alias("parts"))))["parts"])

    return let(values.cast(numbers), lambda v: F.when(F.size(v) > 0, blocks(v)).otherwise(F.array().cast(numbers)))


def reaches(spans: Column, places: Column, inclusive: bool) -> Column:
    """For each of ``places`` the greatest end of the spans that start before it (or at it, if
    ``inclusive``), -1 for none.  One sort and one pass, however many there are."""
    first, second = (0, 1) if inclusive else (1, 0)
    event = lambda at, order, end, i: F.struct(
        at.cast("int").alias("at"), F.lit(order).alias("order"), end.cast("int").alias("end"), i.cast("int").alias("i"))
    events = F.sort_array(F.concat(
        F.transform(spans, lambda s: event(s["start"], first, s["end"], F.lit(-1))),
        F.transform(places, lambda p, i: event(p, second, F.lit(-1), i))))
    told = let(events, lambda e: F.filter(F.zip_with(
        e, running_max(F.transform(e, lambda x: x["end"])),
        lambda x, m: F.struct(x["i"].alias("i"), m.alias("reach"))), lambda x: x["i"] >= 0))
    found = F.transform(F.sort_array(told), lambda x: x["reach"])
    none = F.transform(places, lambda p: F.lit(-1))
    return F.when(F.size(spans) == 0, none).otherwise(found)


SPAN = "array<struct<kind:string,rank:int,start:int,end:int,hit:string>>"


def find_spans(text: Column, pattern: str, kind: str, rank: int,
               gate: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` with code-point offsets.

    ``gate`` (cheap, necessary condition) spares the scan of texts that
    cannot match.  ``pattern`` must not match the empty string.
    """
    empty = F.array().cast(SPAN)
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(
        F.size(hits) > 0,
        F.zip_with(
            cumulative_starts(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits),
            hits,
            lambda s, h: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                                  s.alias("start"), (s + F.length(h)).alias("end"),
                                  h.alias("hit")))).otherwise(empty))
    if gate is not None:
        found = F.when(gate, found).otherwise(empty)
    return F.coalesce(found, empty)


def sort_spans(spans: Column) -> Column:
    """Spans by start, then by rank of their kind, then by end."""
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind")))),
        lambda s: s)


def join_spans(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
