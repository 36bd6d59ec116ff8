"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by *membership pattern* (the set of sources
they belong to).  A pattern can supply its size once for nothing, a
second time at a cost and a third time at a higher one (convex, so
nothing is repeated while something unread could serve); each source
asks for its quota.  The cheapest flow that serves the most is found on
patterns and sources alone.  It says how many words each pattern gives:
whole passes over the pattern plus a remainder, which goes to documents
in the order of a seeded hash.

Scale: sources are numbered and their targets found by Spark, with a few
sums on the driver.  A source that no document shares with another gives
its target by a join; only patterns that share sources need a flow, and
each connected group of them is routed by a task of its own.  No pattern
and no document reaches the driver.  The remainder's cut is found with a
histogram of hash ranges: only the documents of one range in
4,096 per pattern are sorted, so a source with a third of all rows
needs no task that sees a third of the rows.  The decisions are one row
per pattern; they are broadcast up to ``MAX_BROADCAST`` rows and joined
by the session's skew-join rules beyond.

Defined results: a NULL text has size 0; NULL is a source of its own,
last in order; a document of no source is not taken; a source without a
given weight weighs 0; with repeated rows of one id a cut falls before or after
all of them; documents of size 0 are taken with 0 words; an empty table
gives an empty result; other columns are left as they are.  The same
input, seed and parameters give the same mix.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialise
from tessera.llm.graph import connected_components
from tessera.operators.ranking import numbered
from tessera.operators.sizing import broadcast_if_bounded

MAX_BROADCAST = 100_000
RANGE_BITS = 12          # 4,096 hash ranges a pattern
MAX_REPEAT = 3

Source = str | None


def targets(sources: DataFrame, weights: dict[Source, float] | None = None,
            max_repeat: int = MAX_REPEAT, budget: int | None = None) -> DataFrame:
    """``sources(source, size)``, one row each, with ``number`` (by code point, NULL last),
    ``weight`` and ``target``: the share of ``budget`` (default: all sizes) by weight,
    at most ``max_repeat`` times the size, the excess shared again until none is above.

    One sum per round; a round ends only if it closes at least one source more.
    """
    rows = numbered(sources, [F.asc_nulls_last("source")])
    if weights is None:
        rows = rows.withColumn("weight", (F.col("number") % 3 + 1).cast("double"))
    else:
        given = sources.sparkSession.createDataFrame(list(weights.items()), "named string, weight double")
        rows = rows.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("named")), "left").select(
            "source", "size", "number", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    rows = materialise(rows, "weights")
    most = F.col("size") * max_repeat
    if budget is None:
        budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    unit, closed = 0.0, -1
    while True:
        above = F.col("weight") * unit > most
        exact = F.col("weight").cast("decimal(38,12)")
        n, used, open_ = rows.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
                                  F.sum(F.when(~above, exact))).first()
        if n == closed:
            return rows.withColumn("target", F.when(above, most.cast("double")).otherwise(
                F.col("weight") * unit))
        closed, unit = n, (budget - used) / float(open_) if open_ else 0.0


def route(supply: list[int], member_of: list[list[int]], quota: list[int],
          max_repeat: int = MAX_REPEAT) -> list[int]:
    """Words each pattern gives in the cheapest largest flow.

    Successive shortest paths: the r-th pass over any pattern costs more
    than the (r-1)-th and nothing else costs, so the shortest paths are
    those from the lowest open pass, and each pass is one maximum flow on
    top of what flows already.  Paths alternate pattern -> source ->
    (another pattern that feeds it) -> source.
    """
    n, m = len(supply), len(quota)
    flow: list[dict[int, int]] = [{} for _ in range(n)]
    feeds: list[set[int]] = [set() for _ in range(m)]
    need = list(quota)
    given = [0] * n
    for _ in range(max_repeat):
        room = list(supply)
        while True:
            parent: dict[tuple[str, int], tuple[str, int] | None] = {}
            queue: deque[tuple[str, int]] = deque()
            for p in range(n):
                if room[p] > 0:
                    parent[("p", p)] = None
                    queue.append(("p", p))
            ends: list[int] = []
            while queue:
                side, i = queue.popleft()
                if side == "p":
                    for s in member_of[i]:
                        if ("s", s) not in parent:
                            parent[("s", s)] = ("p", i)
                            if need[s] > 0:
                                ends.append(s)
                            queue.append(("s", s))
                else:
                    for p in feeds[i]:
                        if ("p", p) not in parent:
                            parent[("p", p)] = ("s", i)
                            queue.append(("p", p))
            moved = False
            for end in ends:          # each along its own branch of the search tree, if still open
                path, at = [], ("s", end)
                while at is not None:
                    path.append(at)
                    at = parent[at]
                path.reverse()
                amount = min(room[path[0][1]], need[end])
                for (side, i), (_, j) in zip(path, path[1:]):
                    if side == "s":
                        amount = min(amount, flow[j].get(i, 0))
                if amount <= 0:
                    continue
                moved = True
                for (side, i), (_, j) in zip(path, path[1:]):
                    if side == "p":
                        flow[i][j] = flow[i].get(j, 0) + amount
                        feeds[j].add(i)
                    else:
                        flow[j][i] -= amount
                        if not flow[j][i]:
                            feeds[i].discard(j)
                room[path[0][1]] -= amount
                given[path[0][1]] += amount
                need[end] -= amount
            if not moved:
                break
    return given


def _route_group(rows: pd.DataFrame) -> pd.DataFrame:
    """The flow of one connected group of patterns ``(key, size, numbers, quotas)``."""
    rows = rows.sort_values("key")
    quota = {int(n): int(q) for ns, qs in zip(rows["numbers"], rows["quotas"]) for n, q in zip(ns, qs)}
    index = {n: i for i, n in enumerate(sorted(quota))}
    given = route([int(n) for n in rows["size"]], [[index[int(n)] for n in ns] for ns in rows["numbers"]],
                  [quota[n] for n in index], int(rows["most"].iloc[0]))
    return pd.DataFrame({"key": rows["key"].to_numpy(), "given": given})


def _keyed(docs: DataFrame, source_col: str, text_col: str, id_col: str, seed: int,
           tag: str) -> DataFrame:
    """``docs`` with its pattern, size and seeded place in the order of the pattern."""
    array = docs.schema[source_col].dataType.typeName() == "array"
    sources = F.col(source_col).cast("array<string>") if array else \
        F.array(F.col(source_col).cast("string"))
    place = F.xxhash64(F.lit(seed), F.col(id_col))
    pattern = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    return docs.withColumns({
        f"{tag}key": F.to_json(pattern), f"{tag}pattern": pattern,
        f"{tag}size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
        f"{tag}place": place, f"{tag}range": F.shiftrightunsigned(place, 64 - RANGE_BITS).cast("int")})


def _passes(slim: DataFrame, weights: dict[Source, float] | None, max_repeat: int) -> DataFrame:
    """One row per pattern: whole passes, remainder, target and source size."""
    stats = materialise(slim.groupBy("key").agg(F.first("pattern").alias("pattern"),
                                                F.sum("size").alias("size")), "patterns")
    named = F.to_json(F.array("source"))
    members = stats.select("key", "size", F.size("pattern").alias("width"), F.explode("pattern").alias("source"))
    budget = stats.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    goals = materialise(targets(members.groupBy("source").agg(F.sum("size").alias("size")), weights,
                                max_repeat, budget)
                        .select(named.alias("name"), "number", "target", F.col("size").alias("source_size"),
                                F.round("target").cast("long").alias("quota")), "targets")
    members = members.withColumn("name", named).join(broadcast_if_bounded(goals, MAX_BROADCAST), "name")
    one = F.struct("number", "target", "source_size", "quota")
    patterns = materialise(members.groupBy("key").agg(
        F.first("size").alias("size"), F.array_sort(F.collect_list(one)).alias("of")), "members")
    shared = patterns.filter(F.size("of") > 1)
    alone = patterns.select("key", F.get("of", F.lit(0))["quota"].alias("given"))
    if not shared.isEmpty():
        first = F.get("of", F.lit(0))["number"]
        groups = materialise(connected_components(shared.select(
            first.alias("a"), F.explode(F.col("of")["number"]).alias("b"))), "groups")
        tied = patterns.withColumn("node", first).join(groups, "node")
        routed = materialise(tied.select(
            "root", "key", "size", F.lit(max_repeat).alias("most"), F.col("of")["number"].alias("numbers"),
            F.col("of")["quota"].alias("quotas")).groupBy("root").applyInPandas(
                _route_group, "key string, given long"), "routed")
        alone = alone.join(routed.select("key"), "key", "left_anti").unionByName(routed)
    total = lambda c, zero: F.aggregate(F.col("of")[c], zero, lambda a, v: a + v)
    sums = patterns.select("key", total("target", F.lit(0.0)).alias("target"),
                           total("source_size", F.lit(0).cast("long")).alias("source_size"))
    given = F.coalesce("given", F.lit(0).cast("long"))
    return materialise(stats.join(alone, "key", "left").join(sums, "key", "left").select(
        "key", F.when(F.col("size") > 0, F.expr("coalesce(given, 0) div size")).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("size") > 0, given % F.col("size")).otherwise(0).cast("long").alias("remainder"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size")), "passes")


def _running(*keys: str):
    return Window.partitionBy("key").orderBy(*keys).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)


def decide(slim: DataFrame, weights: dict[Source, float] | None = None,
           max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per pattern of ``slim(id, key, pattern, size, place, range)``: ``passes``
    over all its documents, and the ``range`` and ``last`` (place, id) up to which
    its remainder reaches (NULL: not into that range)."""
    passes = _passes(slim, weights, max_repeat)
    by_range = slim.groupBy("key", "range").agg(F.sum("size").alias("size"))
    edges = materialise(
        by_range.withColumn("upto", F.sum("size").over(_running("range")))
        .join(broadcast_if_bounded(passes.filter("remainder > 0").select("key", "remainder"), MAX_BROADCAST), "key")
        .filter("upto >= remainder").groupBy("key")
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("size")).alias("before"),
                            "remainder")).alias("e")).select("key", "e.*"), "edges")
    near = slim.select("id", "key", "size", "place", "range").join(broadcast_if_bounded(edges, MAX_BROADCAST),
                                                                      ["key", "range"])
    last = (near.withColumn("upto", F.col("before") + F.sum("size").over(_running("place", "id")))
            .filter(F.col("upto") - F.col("size") / 2 <= F.col("remainder"))
            .groupBy("key").agg(F.max(F.struct("place", "id")).alias("last")))
    return materialise(passes.join(edges.select("key", "range"), "key", "left")
                       .join(last, "key", "left"), "mix")


def _repeats(rows: DataFrame, decided: DataFrame, id_col: str, tag: str) -> tuple[DataFrame, Column]:
    """``rows`` with the decisions of their pattern, and how often each row is taken."""
    named = decided.select(F.col("key").alias(f"{tag}key"), *[
        F.col(c).alias(f"{tag}d_{c}") for c in decided.columns if c != "key"])
    at, cut = F.col(f"{tag}range"), F.col(f"{tag}d_range")
    here = F.struct(F.col(f"{tag}place").alias("place"), F.col(id_col).alias("id"))
    extra = (at < cut) | ((at == cut) & (here <= F.col(f"{tag}d_last")))
    joined = rows.join(broadcast_if_bounded(named, MAX_BROADCAST), f"{tag}key")
    return joined, F.col(f"{tag}d_passes") + F.coalesce(extra, F.lit(False)).cast("int")


def _slim(docs: DataFrame, source_col: str, text_col: str, id_col: str, seed: int) -> DataFrame:
    keyed = _keyed(docs.select(id_col, source_col, text_col), source_col, text_col, id_col, seed, "__")
    return materialise(keyed.select(
        F.col(id_col).alias("id"), *[F.col(f"__{c}").alias(c) for c in
                                     ("key", "pattern", "size", "place", "range")]), "sizes")


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id",
        text_col: str = "text", weights: dict[Source, float] | None = None,
        max_repeat: int = MAX_REPEAT, seed: int = 42) -> DataFrame:
    """Per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``repeats`` and
    ``taken`` words (sums over its sources if it has several).

    ``source_col`` holds one source or an array of sources (overlapping
    memberships).  Default weights are 1, 2, 3 over the sources in order,
    repeating; the budget is the size of all documents.
    """
    slim = _slim(docs, source_col, text_col, id_col, seed)
    decided = decide(slim, weights, max_repeat)
    rows, repeats = _repeats(slim.select("id", *[F.col(c).alias(f"__{c}") for c in (
        "key", "size", "place", "range")]), decided, "id", "__")
    return rows.select(F.col("id").alias(id_col), F.col("__size").alias("size"),
                       F.col("__d_source_size").alias("source_size"),
                       F.col("__d_target").alias("target"), repeats.alias("repeats"),
                       (repeats * F.col("__size")).alias("taken"))


def mixed_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id",
                    text_col: str = "text", weights: dict[Source, float] | None = None,
                    max_repeat: int = MAX_REPEAT, seed: int = 42) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they are."""
    decided = decide(_slim(docs, source_col, text_col, id_col, seed), weights, max_repeat)
    tag = "__mix_"
    rows, repeats = _repeats(_keyed(docs, source_col, text_col, id_col, seed, tag), decided, id_col, tag)
    return rows.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), repeats.cast("int")))
                       .alias(f"{tag}copy")).select(docs.columns)
