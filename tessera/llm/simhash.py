"""SimHash near-duplicates by segment-popcount embedding and a grid range join.

A 64-bit fingerprint is cut into 16 segments of 4 bits and mapped to the
16 bit counts, a point of the grid {0..4}^16 packed into one long.  The
Manhattan distance of two points never exceeds the bit distance of their
fingerprints, so fingerprints within ``max_bits`` have points within
``max_bits``, and two such points share a grid cell when each point is
listed in the cells at most half that distance away.  The join on cells
gives candidates; the bit distance of the fingerprints decides.

Scale: everything runs on *distinct* fingerprints (copies are folded
before the first shuffle).  A cell with more than ``pair_limit`` members
is never paired up: its fingerprints are listed under all bit patterns
at most half the distance away, and those that share a pattern are
linked to the least of them.  Any two fingerprints under one pattern are
within ``max_bits`` of each other and any two within ``max_bits`` share
a pattern, so the links of such cells give exactly the same components
with a number of rows linear in the members.

Defined results: a NULL or blank text has fingerprint 0 and is linked
like any other; a text with fewer words than a shingle is one shingle;
repeated rows and repeated ids each get their row; a NULL id takes part
in links but is never a component's id (NULL if a component has no
other); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.graph import connected_components

SEED = 42
SEGMENTS = 16
ONES = 0x1111111111111111
_CHUNK = 1 << 16


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: a bit is set if set in over half the shingles."""
    words = (data or b"").lower().split()      # bytes: ASCII letters and ASCII space only
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(line, SEED)]
    else:
        ends = list(accumulate([len(w) + 1 for w in words]))
        starts = [0, *ends]
        hashes = [digest(line[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at:at + _CHUNK], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def embed(fp: Column) -> Column:
    """Bit counts (0 to 4) of the 16 segments, packed four bits apiece."""
    total = fp.bitwiseAND(F.lit(ONES))
    for shift in range(1, 4):
        total = total + F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(ONES))
    return total


def _steps(radius: int) -> list[int]:
    """All moves of Manhattan length up to ``radius`` on the packed grid.

    A cell's key is the sum of its counts times powers of 16.  A move that
    leaves a segment's four bits may give two cells one key: that adds a
    candidate and loses none.  Up to radius 3 no key overflows a long.
    """
    moves = {0}
    for _ in range(radius):
        moves |= {m + s * (1 << (4 * i)) for m in moves for i in range(SEGMENTS) for s in (1, -1)}
    return sorted(moves)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _flips(radius: int) -> list[int]:
    """Masks that flip at most ``radius`` bits."""
    return [_signed(sum(1 << b for b in bits))
            for r in range(radius + 1) for bits in combinations(range(64), r)]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def links(fingerprints: DataFrame, max_bits: int, pair_limit: int = 32) -> DataFrame:
    """Verified links ``(a, b)`` between distinct fingerprints ``fp``, enough to
    connect every two within ``max_bits`` bits (all of them outside crowded cells)."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0 to 6")
    near, far = max_bits // 2, max_bits - max_bits // 2
    if max_bits == 0:
        return fingerprints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    cells = fingerprints.select(
        "fp", F.explode_outer(F.transform(_longs(_steps(far)), lambda d: embed(F.col("fp")) + d)).alias("cell"))
    crowd = cells.groupBy("cell").agg(F.count("*").alias("members")).filter("members > 1")
    # Spark sizes a table as if an explode added no rows, and would broadcast what only looks small
    shared = materialise(cells.join(crowd.hint("merge"), "cell"), "cells")

    few = shared.filter(F.col("members") <= pair_limit).select("cell", "fp")
    left, right = few.select("cell", F.col("fp").alias("a")), few.select("cell", F.col("fp").alias("b"))
    pairs = left.join(right.hint("merge"), "cell").filter(
        (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")

    many = shared.filter(F.col("members") > pair_limit).select("fp").distinct()
    around = lambda radius: many.select("fp", F.explode_outer(F.transform(
        _longs(_flips(radius)), lambda m: F.col("fp").bitwiseXOR(m))).alias("pattern"))
    centre = around(near).groupBy("pattern").agg(F.min("fp").alias("b"))
    stars = around(far).join(centre.hint("merge"), "pattern").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, pair_limit: int = 32) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (long) and ``component_id``.

    ``component_id`` is the least id that links of at most ``max_bits``
    bits reach.  See the module for the method and the defined cases.
    """
    marked = materialise(docs.select(
        F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
        "fingerprints")
    return _grouped(marked, max_bits, pair_limit).select(
        F.col("doc_id").alias(id_col), "fp", "component_id")


def _grouped(marked: DataFrame, max_bits: int, pair_limit: int = 32) -> DataFrame:
    """Rows of ``marked(doc_id, fp, ...)`` with the ``root`` of their group and its least id."""
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = connected_components(links(classes.select("fp"), max_bits, pair_limit))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return marked.join(named, "fp")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the
    least id and, among those, the least hash of the row.

    Rows that are the same in every column count once.  Rows without an id
    cannot be named as a representative and stay.
    """
    tag = "__row_key"
    keyed = docs.withColumn(tag, F.xxhash64(*docs.columns))
    marked = materialise(keyed.select(
        F.col(id_col).alias("doc_id"), F.col(tag).alias("row_key"),
        fingerprint_column(F.col(text_col), shingle).alias("fp")), "fingerprints")
    chosen = _grouped(marked, max_bits).filter("doc_id is not null").groupBy("root").agg(
        F.min(F.struct("doc_id", "row_key")).alias("x")).select(
            F.col("x.doc_id").alias(id_col), F.col("x.row_key").alias(tag))
    kept = keyed.join(chosen, [id_col, tag], "left_semi").dropDuplicates([id_col, tag])
    return kept.select(docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
