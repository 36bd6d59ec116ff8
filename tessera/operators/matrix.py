"""Location-by-value demand matrices, volumes, profiles and rates.

Every operator here answers "per user location, how much of X", where
facts (searches, tickets, ...) carry a user id and a dimension maps the
user id to a location, joined FULL OUTER so that

* a user without facts still adds one row to its location, and
* facts whose user is unknown form a NULL-location group.

Plan shape (the part that matters at scale)
-------------------------------------------
The naive plan joins every fact row to the users table and then groups
by location.  A FULL OUTER join cannot be broadcast, and AQE cannot
split a skewed partition of a full outer join, so one user holding a
third of all facts would put a third of the fact table into one join
task.  Instead we aggregate *eagerly*:

1. ``facts.groupBy(user)`` -> one row of partial sums per user.  The
   partial (map-side) aggregate collapses a hot user to one row per
   map task before anything is shuffled.
2. FULL OUTER join of those per-user rows with the user dimension:
   both sides now have user cardinality, at most one row per key on
   the fact side, and the fact side is already hash-partitioned on the
   join key, so only the dimension is exchanged.
3. ``groupBy(location)`` of the joined rows (partial + final aggregate
   on a handful of groups).

Sums and row counts decompose exactly over step 1, so the result is
identical to the row-level join (the oracle SQL uses the row-level
form).  Averages are carried as (sum, count) pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import numbered

DEFAULT_MAX_VALUES = 1000

_N = "__n_facts"
_FK = "__fact_user"
_UK = "__dim_user"


@dataclass(frozen=True)
class Measure:
    """One output column of :func:`per_location`.

    kind:
      ``rows``        number of joined rows (an unmatched user counts 1)
      ``sum``         sum of ``expr`` over fact rows (NULL if none)
      ``sum_or_zero`` like ``sum`` but an unmatched user adds 0, i.e.
                      the expression is evaluated after the join
      ``avg``         mean of ``expr`` over fact rows, NULLs ignored
    """

    name: str
    kind: str
    expr: Column | None = None


def _partials(measures: Sequence[Measure]) -> list[Column]:
    out = [F.count(F.lit(1)).alias(_N)]
    for i, m in enumerate(measures):
        if m.kind in ("sum", "sum_or_zero"):
            out.append(F.sum(m.expr).alias(f"__s{i}"))
        elif m.kind == "avg":
            out += [F.sum(m.expr).alias(f"__s{i}"), F.count(m.expr).alias(f"__c{i}")]
        elif m.kind != "rows":
            raise ValueError(f"unknown measure kind {m.kind!r}")
    return out


def _finals(measures: Sequence[Measure]) -> list[Column]:
    out = []
    matched = F.col(_N).isNotNull()
    for i, m in enumerate(measures):
        if m.kind == "rows":
            out.append(F.sum(F.coalesce(F.col(_N), F.lit(1))).alias(m.name))
        elif m.kind == "sum":
            out.append(F.sum(f"__s{i}").alias(m.name))
        elif m.kind == "sum_or_zero":
            out.append(F.sum(F.when(matched, F.col(f"__s{i}")).otherwise(F.lit(0)))
                       .alias(m.name))
        else:
            out.append((F.sum(f"__s{i}") / F.sum(f"__c{i}")).alias(m.name))
    return out


def per_location(facts: DataFrame, users: DataFrame, measures: Sequence[Measure],
                 fact_key: str = "id", user_key: str = "id",
                 location: str = "user_location", how: str = "full_outer") -> DataFrame:
    """Aggregate fact measures per user location (eager aggregation).

    ``how`` is the join of facts to users: ``full_outer`` (default,
    both unmatched sides kept), ``left`` (facts only), ``right`` (users
    only) or ``inner``.
    """
    partial = facts.groupBy(F.col(fact_key).alias(_FK)).agg(*_partials(measures))
    dim = users.select(F.col(user_key).alias(_UK), F.col(location).alias(location))
    joined = partial.join(dim, partial[_FK] == dim[_UK], how)
    return joined.groupBy(location).agg(*_finals(measures))


# --- indicator builders ----------------------------------------------------

def indicator(column: str | Column, value, mode: str) -> Column:
    """0/1 (or NULL) column: does this row's ``column`` hold ``value``."""
    c = F.col(column) if isinstance(column, str) else column
    if mode == "array":
        return F.array_contains(c, F.lit(value)).cast("int")
    if mode == "scalar":
        return (c == F.lit(value)).cast("int")
    raise ValueError(f"unknown indicator mode {mode!r}")


def value_label(value) -> str:
    return str(value)


def _checked_values(values: Sequence, max_values: int) -> list:
    values = list(values)
    if len(values) > max_values:
        raise ValueError(f"{len(values)} matrix columns requested, limit is {max_values}; "
                         "use demand_long for an unbounded value domain")
    return values


def demand_matrix(facts: DataFrame, users: DataFrame, column: str, values: Sequence,
                  mode: str = "array", measure: str | Column | None = None,
                  fact_key: str = "id", user_key: str = "id",
                  location: str = "user_location", how: str = "full_outer",
                  max_values: int = DEFAULT_MAX_VALUES) -> DataFrame:
    """Location x value matrix (C8; A17 array, A18 scalar, A19 measure).

    * ``array``:  count fact rows whose array ``column`` contains value
    * ``scalar``: count fact rows whose ``column`` equals value
    * ``measure``: sum ``measure`` over fact rows whose ``column``
      equals value, 0 otherwise (an unmatched user adds 0, not NULL)

    A location with no matching fact row gets NULL in the count modes.
    ``values`` fixes the column set (a stable schema); see
    :func:`collect_domain` for a bounded lookup.
    """
    values = _checked_values(values, max_values)
    if mode == "measure":
        m = F.col(measure) if isinstance(measure, str) else measure
        c = F.col(column)
        ms = [Measure(value_label(v), "sum_or_zero",
                      F.when(c == F.lit(v), m).otherwise(F.lit(0))) for v in values]
    else:
        ms = [Measure(value_label(v), "sum", indicator(column, v, mode)) for v in values]
    return per_location(facts, users, ms, fact_key, user_key, location, how)


def demand_long(facts: DataFrame, users: DataFrame, column: str, mode: str = "array",
                fact_key: str = "id", user_key: str = "id",
                location: str = "user_location") -> DataFrame:
    """Long form of the count matrix: (location, value, n) for every pair
    that occurs.  Scales with the value domain without widening the
    schema.  Facts of unknown users land in the NULL location.
    """
    c = F.col(column)
    v = F.explode(F.array_distinct(c)) if mode == "array" else c
    exploded = facts.select(F.col(fact_key).alias(_FK), v.alias("value")) \
        .where(F.col("value").isNotNull())
    partial = exploded.groupBy(_FK, "value").agg(F.count(F.lit(1)).alias(_N))
    dim = users.select(F.col(user_key).alias(_UK), F.col(location).alias(location))
    joined = partial.join(dim, partial[_FK] == dim[_UK], "left")
    return joined.groupBy(location, "value").agg(F.sum(_N).alias("n"))


def demand_rows(facts: DataFrame, users: DataFrame, column: str, mode: str = "array",
                measure: str | Column | None = None, fact_key: str = "id", user_key: str = "id",
                location: str = "user_location") -> DataFrame:
    """The whole matrix, one row per location: ``cells``, sorted (value, n, average) of the values
    that occur there, and ``n_rows``, the rows of the FULL OUTER join (C8, A17-A19).

    There is no limit on the number of values, and none reaches the driver.  ``n`` counts
    fact rows that hold the value, or sums ``measure`` over them; ``average`` is ``n`` over the
    location's fact rows.  What is grouped last is one row per location and value.
    """
    c = F.col(column)
    m = (F.col(measure) if isinstance(measure, str) else measure) if mode == "measure" else F.lit(1)
    value = F.array_distinct(c) if mode == "array" else F.array(c)
    dim = users.select(F.col(user_key).alias(_UK), F.col(location).alias(location))
    # NULL stands for the row itself: it is counted, whatever it holds
    kind = facts.select(value.alias("v")).schema["v"].dataType
    whole = F.array(F.lit(None).cast(kind.elementType))
    exploded = facts.select(F.col(fact_key).alias(_FK), m.alias("__m"), F.explode(F.concat(
        whole, F.coalesce(F.filter(value, lambda v: v.isNotNull()), F.array().cast(kind)))).alias("value"))
    per_user = exploded.groupBy(_FK, "value").agg(F.count(F.lit(1)).alias(_N), F.sum("__m").alias("__s"))
    joined = per_user.join(dim, per_user[_FK] == dim[_UK], "full_outer")
    cells = joined.groupBy(location, "value").agg(
        F.sum(F.coalesce(F.col(_N), F.lit(1))).alias("n_all"), F.sum(_N).alias("n_facts"), F.sum("__s").alias("n"))
    rows = F.col("value").isNull()
    return cells.groupBy(location).agg(
        F.sum(F.when(rows, F.col("n_all"))).alias("n_rows"), F.sum(F.when(rows, F.col("n_facts"))).alias("__facts"),
        F.array_sort(F.collect_list(F.when(~rows, F.struct("value", "n")))).alias("cells")) \
        .select(location, "n_rows", F.transform("cells", lambda x: F.struct(
            x["value"].alias("value"), x["n"].alias("n"), (x["n"] / F.col("__facts")).alias("average"))).alias("cells"))


def demand_profile(facts: DataFrame, users: DataFrame, column: str, values: Sequence,
                   mode: str = "array", fact_key: str = "id", user_key: str = "id",
                   location: str = "user_location", how: str = "full_outer",
                   max_values: int = DEFAULT_MAX_VALUES) -> DataFrame:
    """Macro average (C10, A7): per-location mean of each indicator,
    then the unweighted mean of those over locations (NULL group too).
    One row, one column per value.
    """
    values = _checked_values(values, max_values)
    ms = [Measure(value_label(v), "avg", indicator(column, v, mode)) for v in values]
    per_loc = per_location(facts, users, ms, fact_key, user_key, location, how)
    return per_loc.agg(*[F.avg(F.col(f"`{value_label(v)}`")).alias(value_label(v))
                         for v in values])


def volume_by_location(facts: DataFrame, users: DataFrame, units: str | None = None,
                       fact_key: str = "id", user_key: str = "id",
                       location: str = "user_location", how: str = "full_outer") -> DataFrame:
    """Rows per location and, with ``units``, summed units."""
    ms = [Measure("n_rows", "rows")]
    if units:
        ms.append(Measure("units", "sum", F.col(units)))
    return per_location(facts, users, ms, fact_key, user_key, location, how)


def total_of_group_totals(per_group: DataFrame, column: str, alias: str = "total") -> DataFrame:
    """Global sum of per-group sums (A5 re-aggregation); one row."""
    return per_group.agg(F.sum(column).alias(alias))


def first_element_present(column: str | Column) -> Column:
    """1 if the array's first element is a non-empty string, else 0;
    NULL for a NULL array (X22).  ``get`` avoids the ANSI out-of-bounds
    error on empty arrays."""
    c = F.col(column) if isinstance(column, str) else column
    return (F.length(F.get(c, F.lit(0))) > 0).cast("int")


def presence_rate(facts: DataFrame, users: DataFrame, columns: Sequence[str],
                  fact_key: str = "id", user_key: str = "id",
                  location: str = "user_location", how: str = "full_outer",
                  prefix: str = "has_") -> DataFrame:
    """Share of fact rows per location whose list is not ``['']``."""
    ms = [Measure(f"{prefix}{c}", "avg", first_element_present(c)) for c in columns]
    return per_location(facts, users, ms, fact_key, user_key, location, how)


def share_with_value(df: DataFrame, column: str, value, alias: str = "share") -> DataFrame:
    """Share of *all* rows whose array ``column`` holds ``value``."""
    hit = F.coalesce(F.array_contains(F.col(column), F.lit(value)).cast("int"), F.lit(0))
    return df.agg(F.avg(hit).alias(alias))


# --- value domains ---------------------------------------------------------

def array_domain(df: DataFrame, column: str, alias: str = "value") -> DataFrame:
    """Distinct non-empty elements of an array column (A20), distributed."""
    return (df.select(F.explode(F.col(column)).alias(alias))
              .where(F.col(alias).isNotNull() & (F.col(alias) != ""))
              .distinct())


def first_seen_domain(df: DataFrame, column: str, position: Sequence[str], name: str = "place") -> DataFrame:
    """(value, place): distinct non-empty elements of an array column in the order they are
    first seen (A20).  ``position`` are columns that order the rows, such as those of
    :func:`tessera.sources.readers.with_position`; within a row the list's order counts."""
    seen = df.select(F.posexplode(F.col(column)).alias("__at", "value"), *position) \
        .where(F.col("value").isNotNull() & (F.col("value") != ""))
    first = seen.groupBy("value").agg(F.min(F.struct(*position, "__at")).alias("first"))
    return numbered(first, [F.asc("first")], name).select("value", name)


def scalar_domain(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Distinct non-NULL values of a scalar column."""
    alias = alias or column
    return df.select(F.col(column).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def collect_domain(domain: DataFrame, max_values: int = DEFAULT_MAX_VALUES) -> list:
    """Bring a value domain to the driver, refusing more than
    ``max_values`` (the driver only ever holds a bounded list)."""
    col = domain.columns[0]
    rows = domain.orderBy(col).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"value domain of {col!r} exceeds {max_values} values")
    return [r[0] for r in rows]
