"""Secret scans: fixed-pattern spans plus a sliding-window entropy scan.

Base spans are the leftmost non-overlapping matches of three patterns.
The method adds spans: maximal runs of a character class are split at
the parts the allow-list names, and what is left between them is a
candidate if it has ``WINDOW`` characters, is no plain number, and holds
a digit or letters of mixed case (``CASE_MIX``); a window of ``WINDOW``
characters slides over each, its symbol counts and the sum of
c * log2(c) change by the one symbol that enters and the one that
leaves, and windows whose Shannon entropy reaches the class's threshold
are joined into a span where they overlap or touch.  A span that lies inside a base span is passed
over.

Everything is DataFrame expressions over one scan, without a shuffle;
each text is handled whole, in its own row.

Defined results: a NULL or empty text has no spans; the run of a very
long text is scanned whole; repeated rows each get their row; an empty
table gives an empty result; other columns are left as they are, but for one
that has the name of a result column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (SPAN, chunked, cut, find_spans, join_spans, let, reaches,
                                running_max, sort_spans)

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
RANGES = "array<struct<first:int,last:int>>"
HEX_SYMBOLS = "0123456789abcdef"
BASE64_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
HEX_BITS = 3.0
BASE64_BITS = 3.8
# A run of at least WINDOW symbols, from where the run begins.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % WINDOW
# What looks random but is not secret: sample values, alphabets, one repeated sign; plain numbers.
ALLOW = (r"(?i)example|sample|dummy|placeholder|changeme|x{6,}"
         r"|abcdefghij|0123456789|([A-Za-z0-9+/_=-])\1{9,}")
PLAIN = r"^[0-9+/_=-]+$"
# Least share of the rarer case among the letters of a candidate without digits.  Random letters
# have a half; identifiers written in capitals or in CamelCase have less.
CASE_MIX = 0.3


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, failing matches dropped."""
    value = lambda s: F.regexp_extract(s["hit"], ASSIGN, 1)
    lower = F.lower(text)
    named = F.lit(False)
    for word in ("passw", "secret", "token", "apikey", "api_key"):
        named = named | F.contains(lower, F.lit(word))
    assign = F.filter(find_spans(text, ASSIGN, KINDS[0], 0, named),
                      lambda s: F.length(value(s)) >= 12)
    access = find_spans(text, ACCESS, KINDS[1], 1, F.contains(text, F.lit("AKIA")))
    return F.concat(assign, access, find_spans(text, HEX, KINDS[2], 2))


def _plog(count: int) -> float:
    return count * math.log2(count) if count else 0.0


def entropy_ranges(symbols: Column, alphabet: str, bits: float, window: int = WINDOW) -> Column:
    """``(first, last)`` starts of each group of windows of ``symbols`` (an array of
    single characters) with at least ``bits`` of entropy that overlap or touch.

    One pass: each step adds one symbol's count and takes one away, and
    ``s`` (the sum of c * log2(c)) moves by the two differences.
    """
    table = F.array(*[F.lit(_plog(c)) for c in range(window + 2)])
    full = math.log2(window)

    def scan(codes: Column) -> Column:
        zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("s"),
                        F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("i"),
                        F.array().cast(RANGES).alias("done"))

        def step(acc: Column, code: Column) -> Column:
            gone = F.when(acc["i"] >= window, F.get(codes, acc["i"] - window)).otherwise(F.lit(-1))
            return let(F.struct(gone.alias("gone"), code.alias("new")), lambda m: let(
                F.transform(acc["n"], lambda c, k: c + F.when(k == m["new"], 1).otherwise(0)
                            - F.when(k == m["gone"], 1).otherwise(0)),
                lambda n: let(_moved(acc, m, table), lambda s: let(_hit(acc, s), lambda hot: F.struct(
                    n.alias("n"), s.alias("s"),
                    F.when(hot & ((acc["first"] < 0) | _apart(acc)), acc["i"] - window + 1)
                    .otherwise(acc["first"]).alias("first"),
                    F.when(hot, acc["i"] - window + 1).otherwise(acc["last"]).alias("last"),
                    (acc["i"] + 1).alias("i"),
                    F.when(hot & (acc["first"] >= 0) & _apart(acc), _closed(acc))
                    .otherwise(acc["done"]).alias("done"))))))

        def _apart(acc: Column) -> Column:
            return acc["i"] - window + 1 > acc["last"] + window

        def _closed(acc: Column) -> Column:
            return F.concat(acc["done"], F.array(F.struct(
                acc["first"].alias("first"), acc["last"].alias("last"))))

        def _hit(acc: Column, s: Column) -> Column:
            return (acc["i"] >= window - 1) & (F.lit(full) - s / window >= bits - 1e-9)

        return F.aggregate(codes, zero, step, lambda acc: F.when(
            acc["first"] >= 0, _closed(acc)).otherwise(acc["done"]))

    codes = F.transform(symbols, lambda ch: F.instr(F.lit(alphabet), ch) - 1)
    return let(codes, scan)


def _moved(acc: Column, m: Column, table: Column) -> Column:
    """The sum of c * log2(c) after ``m.new`` enters and ``m.gone`` (if any) leaves."""
    same = m["new"] == m["gone"]
    new, gone = F.get(acc["n"], m["new"]), F.get(acc["n"], F.greatest(m["gone"], F.lit(0)))
    grow = F.get(table, new + 1) - F.get(table, new)
    shrink = F.when(m["gone"] < 0, F.lit(0.0)).otherwise(
        F.get(table, F.greatest(gone - 1, F.lit(0))) - F.get(table, gone))
    return F.when(same, acc["s"]).otherwise(acc["s"] + grow + shrink)


def _pieces(runs: Column) -> Column:
    """The parts of the runs between what the allow-list names."""
    def cut(s: Column) -> Column:
        begin = lambda h: let(F.transform(find_spans(h, ALLOW, "", 0), lambda a: F.struct(
            a["start"].alias("start"), a["end"].alias("end"))), lambda parts: F.zip_with(
                F.concat(F.array(F.lit(0)), parts["end"]),
                F.concat(parts["start"], F.array(F.length(h))),
                lambda a, b: F.struct(a.alias("at"), F.substring(h, a + 1, b - a).alias("hit"))))
        whole = F.array(F.struct(F.lit(0).alias("at"), s["hit"].alias("hit")))
        return F.transform(F.when(F.rlike(s["hit"], F.lit(ALLOW)), begin(s["hit"])).otherwise(whole),
                           lambda x: F.struct((s["start"] + x["at"]).alias("start"), x["hit"].alias("hit")))

    return F.flatten(F.transform(runs, cut))


def _likely(hit: Column) -> Column:
    """Whether a piece may hold a secret, before its entropy is known."""
    upper = F.length(F.regexp_replace(hit, "[^A-Z]", ""))
    lower = F.length(F.regexp_replace(hit, "[^a-z]", ""))
    mixed = F.least(upper, lower) >= CASE_MIX * (upper + lower)
    return (F.length(hit) >= WINDOW) & F.when(
        F.rlike(hit, F.lit("[0-9]")), ~F.rlike(hit, F.lit(PLAIN))).otherwise((upper > 0) & mixed)


def entropy_spans(text: Column) -> Column:
    """Spans of high-entropy windows in the candidate strings of ``text``."""
    runs = find_spans(text, CANDIDATE, "", 0, F.rlike(text, F.lit(CANDIDATE)))
    candidates = F.filter(_pieces(runs), lambda s: _likely(s["hit"]))

    def scored(s: Column) -> Column:
        hexa = F.rlike(s["hit"], F.lit("^[0-9A-Fa-f]+$"))
        chars = lambda t: F.split(t, "", -1)
        found = F.when(hexa, entropy_ranges(chars(F.lower(s["hit"])), HEX_SYMBOLS, HEX_BITS)) \
            .otherwise(entropy_ranges(chars(s["hit"]), BASE64_SYMBOLS, BASE64_BITS))
        return F.transform(found, lambda f: F.struct(
            F.when(hexa, F.lit(KINDS[3])).otherwise(F.lit(KINDS[4])).alias("kind"),
            F.when(hexa, F.lit(3)).otherwise(F.lit(4)).alias("rank"),
            (s["start"] + f["first"]).alias("start"),
            (s["start"] + f["last"] + WINDOW).alias("end"), s["hit"].alias("hit")))

    return F.flatten(F.transform(candidates, scored))


def scan(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (arrays of kind, rank, start, end in code points)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    b, a = f"{prefix}base", "__secret_added"
    out = docs.withColumns({f"{prefix}base": sort_spans(base_spans(text)), a: entropy_spans(text)})
    inside = reaches(F.col(b), F.transform(a, lambda s: s["start"]), True)
    outside = F.when(F.size(a) == 0, F.col(a)).otherwise(let(inside, lambda reach: F.filter(
        F.col(a), lambda s, i: F.get(reach, i) < s["end"])))
    return out.withColumn(f"{prefix}spans", sort_spans(F.concat(
        F.transform(F.col(b), lambda s: F.struct(s["kind"], s["rank"], s["start"], s["end"],
                                                 F.lit("").alias("hit"))).cast(SPAN),
        outside.cast(SPAN)))).drop(a)


def digest(scanned: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts per base kind, ``base_sha256`` and ``spans`` text from ``base`` and ``spans``."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                          F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"),
                          join_spans(F.col("spans")).alias("spans"))


def merged(spans: Column) -> Column:
    """(start, end) of what sorted spans cover, one for those that overlap."""
    def heads(spans: Column, reach: Column) -> Column:
        last = F.size(spans) - 1
        first = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (
            F.get(spans, i)["start"] >= F.get(reach, i - 1)))
        return let(first, lambda f: F.transform(f, lambda i, k: F.struct(
            F.get(spans, i)["start"].alias("start"),
            F.get(reach, F.coalesce(F.get(f, k + 1) - 1, last)).alias("end"))))

    return let(spans, lambda s: let(running_max(F.transform(s, lambda x: x["end"])), lambda reach: heads(s, reach)))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mask``.

    Overlapping spans share one mask.  ``length_col``, if the table has
    it, is set to the new length of the texts that changed.
    """
    tag = "__secret_"
    text, spans = F.col(text_col), F.col(f"{tag}spans")

    def masked(chunks: Column) -> Column:
        def joined(m: Column) -> Column:
            """The texts between the masks, from the end of one to the start of the next."""
            begins = F.concat(F.array(F.lit(0)), F.transform(m, lambda x: x["end"]))
            ends = F.concat(F.transform(m, lambda x: x["start"]), F.array(F.length(text)))
            return F.array_join(F.zip_with(begins, ends, lambda a, b: cut(chunks, a, b)), mask)

        return let(merged(spans), joined)

    cut_text = let(chunked(text), masked)
    out = scan(docs, text_col, tag).withColumn(
        f"{tag}text", F.when(F.size(spans) > 0, cut_text).otherwise(text))
    changes = {text_col: F.col(f"{tag}text")}
    if length_col in docs.columns:
        changes[length_col] = F.when(F.size(spans) > 0, F.length(f"{tag}text").cast(
            docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return out.withColumns(changes).select(docs.columns)
