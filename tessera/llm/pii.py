"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

1. *Candidates.* Every match of the four base patterns (with those that
   fail their check) and of four looser ones (bracketed e-mail forms,
   phone numbers without a country code).
2. *Votes.* Five labelers say +1, 0 or -1 on each candidate: the pattern
   it came from (nothing on loose ones), a checksum, range or form check,
   a gazetteer (top-level domains, card issuers, calling and area codes,
   reserved networks), key words before it, and the characters around it.
3. *Reliabilities.* Candidates are counted per kind and vote pattern
   (at most 3^5 patterns a kind, whatever the input).  Base spans count as
   true and base matches that fail their check as false; expectation
   maximisation over the loose ones estimates, per kind, how often each
   labeler says what about true and false candidates.  A labeler that
   says nothing is no evidence.  Each table starts from an anchor
   (``ANCHORS``) of a quarter of the loose candidates' weight: they
   outweigh it four to one, and it weighs the same at every size (an anchor
   of a fixed weight fades as the input grows, and large groups of equal
   votes would then decide for themselves).
4. *Classifier.* A logistic regression learns the estimated truth from
   features of the span itself (kind, length, separators, key words,
   neighbours), on the table of distinct feature vectors with counts as
   weights (at most 2^``N_FEATURES`` rows); the loose candidates have half
   of the weight.  It decides the loose candidates; base spans always
   stay, and base matches that fail their check never come back.

The corpus is scanned once, in DataFrame expressions; candidates go to a
small scratch table that training and the final pass read.  There is no
shuffle of texts; the two training tables are partial aggregates.

Defined results: a NULL or empty text has no spans; a match that fails
its check is dropped and its text is not searched again; a loose
candidate that overlaps a base span is dropped; without any loose
candidate nothing is trained; repeated rows each get their row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (SPAN, chunked, cut, find_spans, let, materialise, reaches,
                                sort_spans)

KINDS = ("email", "ip", "card", "phone")

# Base patterns: possessive where a step back could never help, and begun
# only where a match can begin (a run's first sign, or the end of the last match).
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Loose patterns.
EMAIL_LOOSE = (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++\x20?[\[({{](?:at|AT|@)[\])}}]\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|[\[({](?:dot|DOT)[\])}])\x20?[A-Za-z0-9-]++)+")
PHONE_LOOSE = (r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}"
               r"(?![0-9])")

# Gazetteers and key words (fixed values).
# Country suffixes are all two-letter ones; the others are the generic and sponsored suffixes in common use.
SUFFIX = (r"(?:[a-z]{2}|com|org|net|edu|gov|mil|int|arpa|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|cat|tel|"
          r"post|asia|xxx|app|dev|cloud|online|shop|site|store|tech|xyz|blog|email|live|news|top|club|agency|work)")
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
# Calling codes in use: one and two digits, then three digits by their first two.
CALLING = (r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|22[0-9]|23[0-9]|24[0-9]|"
           r"25[0-8]|26[0-9]|29[01789]|35[0-9]|37[0-9]|38[0-35-79]|42[013]|50[0-9]|59[0-9]|67[02-9]|68[0-35-9]|"
           r"69[0-2]|80[08]|85[02356]|87[08]|88[0-368]|96[0-8]|97[0-79]|99[2-68])")
AREA = r"^[^0-9]*[2-9][0-8][0-9]"
# Forms of loose matches: one kind of separator (any after a space or bracket), clean labels.
PHONE_FORM = r"^(?:\([0-9]{3}\)\x20?|[0-9]{3}\x20|[0-9]{3}([-.])(?=[0-9]{3}\1))"
EMAIL_FORM = r"[A-Za-z0-9](?:\.|\x20?[\[({](?:dot|DOT)[\])}]\x20?)[A-Za-z]{2,}$"
RESERVED = r"^0*(?:0|127|255)\."
CONTEXT = {
    "email": "e-?mail|contact|write|mailto|address",
    "ip": r"\bip\b|server|host|address|client|login",
    "card": "card|visa|master|credit|payment|amex",
    "phone": "phone|tel|call|mobile|fax|contact",
}
AGAINST = r"order|invoice|serial|isbn|version|\bid\b|ref|part"
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
BEFORE, CHECK_DIGITS = 40, (12, 19)
# How often each labeler that speaks says +1 of a true and of a false candidate, before any is seen.
ANCHORS = {kind: ((0.9, 0.1), (0.95, 0.6), (0.9, 0.1) if kind == "email" else (0.95, 0.6),
                  (0.95, 0.05), (0.95, 0.6)) for kind in KINDS}
ANCHOR_WEIGHT, ANCHOR_SHARE, PRIOR_SHARE = 50, 0.25, 1.0    # candidates, and shares of the loose ones
N_FEATURES = 12
ACCEPT = 0.9


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    code = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(code, lambda d, i: F.when(i % 2 == 0, d).otherwise(
            F.when(d > 4, 2 * d - 9).otherwise(2 * d))), F.lit(0), lambda acc, d: acc + d)
    return total % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def valid(kind: str, hit: Column) -> Column:
    """The base rule's check of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|(?<=0))"
        return F.rlike(hit, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    low, high = CHECK_DIGITS if kind == "card" else (9, 15)
    long_enough = F.length(_digits(hit)).between(low, high)
    return long_enough if kind == "phone" else F.when(long_enough, luhn(_digits(hit))).otherwise(False)


CANDIDATE = ("array<struct<kind:string,rank:int,start:int,end:int,base:boolean,loose:boolean,"
             "votes:array<int>,features:array<int>>>")


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote.when(no, -1) if no is not None else vote).otherwise(0)


def _described(chunks: Column, s: Column, kind: str, loose: bool) -> Column:
    """A match with its votes and features."""
    ok = F.lit(False) if loose else valid(kind, s["hit"])
    before = cut(chunks, F.greatest(s["start"] - BEFORE, F.lit(0)), s["start"])
    after = cut(chunks, s["end"], s["end"] + 1)
    last = F.right(before, F.lit(1))

    def body(m: Column) -> Column:
        hit, digits = s["hit"], m["digits"]
        known = {"email": F.rlike(F.lower(hit), F.lit(rf"(?:\.|dot[\])}}]\x20?){SUFFIX}$")),
                 "ip": ~F.rlike(hit, F.lit(RESERVED)),
                 "card": F.rlike(digits, F.lit(ISSUER)),
                 "phone": F.rlike(hit, F.lit(AREA if loose else CALLING))}[kind]
        here = F.rlike(m["before"], F.lit("(?i)" + CONTEXT[kind]))
        wrong = F.rlike(m["before"], F.lit("(?i)" + AGAINST))
        glued = F.rlike(m["last"], F.lit(r"[\p{L}\p{N}_]")) | F.rlike(m["after"], F.lit(r"[\p{L}\p{N}_]"))
        size = F.length(digits)
        fit = F.rlike(hit, F.lit(EMAIL_FORM if kind == "email" else PHONE_FORM)) if loose else m["ok"]
        votes = F.array(_vote(m["ok"]), _vote(fit, ~fit), _vote(known, ~known), _vote(here, wrong),
                        _vote(~glued, glued))
        bit = lambda c: F.coalesce(c, F.lit(False)).cast("int")
        features = F.array(*[F.lit(int(k == kind)) for k in KINDS[1:]], F.lit(int(loose)),
                           bit(fit), bit(known), bit(here), bit(wrong), bit(glued),
                           bit(size >= 13), bit(F.rlike(hit, F.lit(r"[\x20().-]"))),
                           bit(F.length(hit) >= 20))
        return F.struct(F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"),
                        s["start"].alias("start"), s["end"].alias("end"), m["ok"].alias("base"),
                        F.lit(loose).alias("loose"), votes.alias("votes"), features.alias("features"))

    return let(F.struct(ok.alias("ok"), _digits(s["hit"]).alias("digits"), before.alias("before"),
                        last.alias("last"), after.alias("after")), body)


def _describe_all(chunks: Column, spans: Column, kind: str, loose: bool) -> Column:
    return F.transform(spans, lambda s: _described(chunks, s, kind, loose))


def candidates(text: Column) -> Column:
    """All candidates of a (non-null) text; those whose ``base`` holds are the base spans."""
    has = lambda pattern: F.rlike(text, F.lit(pattern))
    sources = [("email", EMAIL, False, F.contains(text, F.lit("@"))),
               ("ip", IP, False, has(r"[0-9]\.[0-9]")),
               ("card", CARD, False, has(r"[0-9](?:[\x20-]?[0-9]){11}")),
               ("phone", PHONE, False, F.contains(text, F.lit("+"))),
               ("email", EMAIL_LOOSE, True, has(r"[\[({](?:at|AT|@)[\])}]")),
               ("phone", PHONE_LOOSE, True, has(r"[0-9]{3}[-.\x20][0-9]{4}"))]
    def described(chunks: Column) -> Column:
        parts = []
        for kind, pattern, loose, gate in sources:
            spans = find_spans(text, pattern, kind, 0, gate)
            if kind == "card":        # short numbers are no candidates at all
                spans = F.filter(spans, lambda s: F.length(_digits(s["hit"])).between(*CHECK_DIGITS))
            parts.append(_describe_all(chunks, spans, kind, loose).cast(CANDIDATE))
        return F.concat(*parts)

    def settle(every: Column) -> Column:
        """Without the loose ones that overlap a base span."""
        return let(F.filter(every, lambda c: c["loose"]), lambda loose: F.when(F.size(loose) == 0, every).otherwise(
            let(F.filter(every, lambda c: c["base"]), lambda base: let(
                reaches(base, F.transform(loose, lambda c: c["end"]), False), lambda reach: F.concat(
                    F.filter(every, lambda c: ~c["loose"]),
                    F.filter(loose, lambda c, i: F.get(reach, i) <= c["start"]))))))

    empty = F.array().cast(CANDIDATE)
    some = F.lit(False)
    for _, _, _, gate in sources:
        some = some | gate
    return F.when(some, let(chunked(text), lambda chunks: let(described(chunks), settle))).otherwise(empty)


Tables = list[list[list[float]]]


def estimate_reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 60,
                           smooth: float = 0.5, begin: Tables | None = None,
                           pull: float = 0.0) -> tuple[float, Tables]:
    """EM over counts of vote patterns: prior of truth and P(vote | truth) per labeler.

    Votes are -1, 0, 1; ``result[1][j][t][v + 1]`` is labeler j's share of
    vote v among candidates of truth t, without those it says nothing on.
    Starts from the sum of the votes, or, given ``begin`` (counts that are
    added to each table), from the tables of those.  ``pull`` counts as so
    many candidates of a prior of one half.
    """
    width = len(LABELERS)
    begin = begin or [[[0.0] * 3 for _ in range(2)] for _ in range(width)]
    shares = lambda tables: [[[(c + smooth) / (sum(row) + 3 * smooth) for c in row]
                              for row in t] for t in tables]
    prior, tables = 0.5, shares(begin)
    anchored = any(c for t in begin for row in t for c in row)
    sure = lambda x: 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))
    belief = {v: sure(log_odds(v, prior, tables) if anchored else sum(v)) for v in patterns}
    for _ in range(rounds):
        total = sum(patterns.values())
        mass = sum(n * belief[v] for v, n in patterns.items())
        prior = (mass + smooth + pull / 2) / (total + 2 * smooth + pull)
        counts = [[list(row) for row in t] for t in begin]
        for v, n in patterns.items():
            for j, vote in enumerate(v):
                if vote:
                    counts[j][1][vote + 1] += n * belief[v]
                    counts[j][0][vote + 1] += n * (1 - belief[v])
        tables = shares(counts)
        belief = {v: sure(log_odds(v, prior, tables)) for v in patterns}
    return prior, tables


def log_odds(votes: tuple[int, ...], prior: float, tables: Tables) -> float:
    return math.log(prior / (1 - prior)) + sum(
        math.log(tables[j][1][v + 1] / tables[j][0][v + 1]) for j, v in enumerate(votes) if v)


def anchored(kind: str, patterns: dict[str, dict[tuple[int, ...], float]]) -> tuple[float, Tables]:
    """Prior and tables of a kind from the counts of its ``true``, ``false`` and ``loose`` candidates."""
    loose = patterns.get("loose", {})
    total = sum(loose.values())
    weight = ANCHOR_WEIGHT + ANCHOR_SHARE * total
    begin = [[[weight * (1 - p), 0.0, weight * p] for p in (no, yes)] for yes, no in ANCHORS[kind]]
    for t, known in enumerate(("false", "true")):
        for votes, n in patterns.get(known, {}).items():
            for j, vote in enumerate(votes):
                if vote and LABELERS[j] not in ("pattern", "check"):     # these two made them known
                    begin[j][t][vote + 1] += n
    return estimate_reliabilities(loose, begin=begin, pull=2 * ANCHOR_WEIGHT + PRIOR_SHARE * total)


def train(found: DataFrame) -> tuple[list[float], float] | None:
    """Weights and intercept of the span classifier; None without loose candidates.

    What comes to the driver is one row per kind, group and vote pattern
    (at most 3 * 4 * 3^5) and the regression's coefficients.
    """
    spans = found.select(F.explode("found").alias("c")).select(
        "c.kind", "c.votes", "c.features", F.when(F.col("c.loose"), "loose").when(
            F.col("c.base"), "true").otherwise("false").alias("group"))
    table = materialise(spans.groupBy("kind", "group", "votes", "features").agg(
        F.count("*").cast("double").alias("n")), "votes")
    counts: dict[str, dict[str, dict[tuple[int, ...], float]]] = {}
    totals = {"loose": 0.0, "known": 0.0}
    for kind, group, votes, n in sorted(table.groupBy("kind", "group", "votes").agg(F.sum("n")).collect()):
        counts.setdefault(kind, {}).setdefault(group, {})[tuple(votes)] = n
        totals["loose" if group == "loose" else "known"] += n
    if not totals["loose"]:
        return None
    truth = F.when(F.col("group") == "true", 0.99).otherwise(0.01)
    for kind in counts:
        if "loose" not in counts[kind]:
            continue
        prior, tables = anchored(kind, counts[kind])
        odds = F.lit(math.log(prior / (1 - prior)))
        for j in range(len(LABELERS)):
            for v in (-1, 1):
                odds = odds + F.when(F.get("votes", F.lit(j)) == v, math.log(
                    tables[j][1][v + 1] / tables[j][0][v + 1])).otherwise(0.0)
        truth = F.when((F.col("kind") == kind) & (F.col("group") == "loose"),
                       1 / (1 + F.exp(-odds))).otherwise(truth)
    scale = F.when(F.col("group") == "loose", 1.0).otherwise(
        min(1.0, totals["loose"] / max(totals["known"], 1.0)))
    soft = table.select("features", (F.col("n") * scale / totals["loose"]).alias("n"), truth.alias("truth"))
    soft = soft.groupBy("features").agg(F.sum(F.col("n") * F.col("truth")).alias("yes"),
                                        F.sum(F.col("n") * (1 - F.col("truth"))).alias("no"))
    rows = soft.select(array_to_vector(F.col("features").cast("array<double>")).alias("x"), F.explode(
        F.array(F.struct(F.lit(1.0).alias("y"), F.col("yes").alias("w")),
                F.struct(F.lit(0.0).alias("y"), F.col("no").alias("w")))).alias("e"))
    rows = rows.select("x", "e.y", "e.w").filter("w > 0").coalesce(1)
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1e-3,
                               maxIter=50, standardization=False).fit(rows)
    return [float(c) for c in model.coefficients], float(model.intercept)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         accept: float = ACCEPT) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of kind, rank, start, end in code points)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = materialise(docs.select(F.col(id_col).alias("doc_id"), candidates(text).alias("found")),
                        "candidates")
    model = train(found)
    span = lambda c: F.struct(c["kind"], c["rank"], c["start"], c["end"],
                              F.lit("").alias("hit"))
    pick = lambda keep: sort_spans(F.transform(F.filter("found", keep), span).cast(SPAN))

    def accepted(c: Column) -> Column:
        if model is None:
            return c["base"]
        weights = F.array(*[F.lit(w) for w in model[0]])
        score = F.aggregate(F.zip_with(weights, c["features"], lambda w, x: w * x),
                            F.lit(model[1]), lambda acc, v: acc + v)
        return c["base"] | (c["loose"] & (score >= math.log(accept / (1 - accept))))

    return found.select("doc_id", pick(lambda c: c["base"]).alias("base"),
                        pick(accepted).alias("spans"))
