"""Data placement: overlapping horizontal / vertical / derived fragments
for several sites, and a completeness check (C12-C14, J-I, J-S, U1-U5).

A site is described by a :class:`FragmentSpec` row, so adding a site is
data, not code.  Fragments overlap (one movie may live on several
sites), so they are never modelled as a single-valued partition column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FragmentSpec:
    """One site's share of the base table.

    rows:     keep rows whose ``rows_column`` array holds any of ``any_of``
    min_year: and whose ``year_column`` is >= this (inclusive), if set
    drop:     attributes not stored at the site (vertical fragmentation)
    split_any_of: if set, the fragment is stored as a class part (rows
              whose ``split_column`` holds any of these) and a rest
    store_details: whether the site also stores the detail rows of its
              movies (derived fragmentation)
    """

    site: str
    any_of: tuple[str, ...]
    rows_column: str = "cities"
    min_year: int | None = None
    year_column: str = "year"
    drop: tuple[str, ...] = ()
    split_any_of: tuple[str, ...] = ()
    split_column: str = "genres"
    store_details: bool = True


def _any_of(column: str, values: Sequence[str]) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values]))


def placement_base(movies: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """Movies joined with their detail rows (J-I)."""
    return movies.join(details, key, "inner")


def site_condition(spec: FragmentSpec) -> Column:
    cond = _any_of(spec.rows_column, spec.any_of)
    if spec.min_year is not None:
        cond = cond & (F.col(spec.year_column) >= F.lit(spec.min_year))
    return cond


def fragment(base: DataFrame, spec: FragmentSpec) -> DataFrame:
    """Horizontal (rows) + vertical (dropped attributes) fragment."""
    return base.where(site_condition(spec)).drop(*spec.drop)


def split_fragment(frag: DataFrame, spec: FragmentSpec) -> tuple[DataFrame, DataFrame]:
    """(class part, rest) of a fragment.

    ``rest`` has EXCEPT semantics: distinct rows of the fragment that are
    not in the part; rows whose class column is NULL stay in the rest.
    Written as a negated filter + ``distinct`` instead of ``subtract``,
    so the fragment is scanned once per piece and no join is needed.
    """
    if not spec.split_any_of:
        raise ValueError(f"site {spec.site!r} has no class split")
    cond = _any_of(spec.split_column, spec.split_any_of)
    part = frag.where(cond)
    rest = frag.where(~F.coalesce(cond, F.lit(False))).distinct()
    return part, rest


def derived_fragment(details: DataFrame, frag: DataFrame, key: str = "id") -> DataFrame:
    """Detail rows of the movies in a fragment: LEFT SEMI join (C13, J-S)."""
    return details.join(frag.select(key), key, "left_semi")


def placed_ids(base: DataFrame, specs: Sequence[FragmentSpec], key: str = "id") -> DataFrame:
    """(site, id) for every placement, one pass over the base table.

    Each row gets the array of sites whose predicate it meets, exploded;
    this replaces a union of one scan per site (U2).
    """
    sites = F.filter(F.array(*[F.when(site_condition(s), F.lit(s.site)) for s in specs]),
                     lambda x: x.isNotNull())
    return base.select(F.col(key), F.explode(sites).alias("site"))


def check_placement(all_ids: DataFrame, placed: DataFrame, key: str = "id"
                    ) -> dict[str, DataFrame]:
    """Completeness of a placement.

    ``lost``: ids of the source that no site holds (all - placed);
    ``orphan``: ids on a site that the source does not have (placed - all);
    ``site_counts``: distinct ids per site.
    """
    on_site = placed.select(key).distinct()
    source = all_ids.select(key).distinct()
    return {
        "lost": source.join(on_site, key, "left_anti"),
        "orphan": on_site.join(source, key, "left_anti"),
        "site_counts": placed.groupBy("site").agg(F.count_distinct(key).alias("n_ids")),
    }


def union_ids(frames: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """UNION ALL of the key column of several fragments.

    Fragments of one base recompute that base per branch unless it is
    materialised first (``checkpoint``); :func:`placed_ids` gets the same
    ids from a single pass.
    """
    return reduce(lambda a, b: a.unionByName(b), [f.select(key) for f in frames])
