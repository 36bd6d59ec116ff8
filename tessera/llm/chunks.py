"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; the text is cut where its upper
bits are zero.  Chunk lengths are normalised: before the usual length
``NORMAL`` a stricter mask must be met and after it a looser one, within
``LEAST`` and ``MOST`` bytes.  Only the last 16 bytes decide a cut, so an
edit moves the cuts near it and no others.  The fingerprint is the set
of chunk digests with the bytes each stands for; the containment of one
in another is the share of its bytes in chunks that the other has.

Neighbours: a row needs the text of the next document in descending id
order.  Ids are cut into ranges at approximate quantiles; each text goes
once to the task of its range and is sorted there, and the first row of
a range is also sent to the range before it.  Only range bounds and one
id per range reach the driver.

Defined results: a NULL or empty text has no chunk and the fingerprint
of the empty set; the likeness of an empty fingerprint is 1 to an empty
one and 0 to any other; rows with one id follow in text order (NULL as
empty), a NULL id comes after all others; the only row of a table is its
own neighbour; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.operators.ranking import value_codes, with_codes

LEAST, NORMAL, MOST = 16, 64, 256
STRICT, LOOSE = 0xFF00, 0xF000          # 8 and 4 of the upper bits of a 16-bit hash
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 42) & 0xFFFF for b in range(256)], dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """16-bit gear hash ending at each byte: sum of GEAR[byte] << distance, by doubling."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint16(step)
        h = h + shifted
    return h


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(np.frombuffer(data, dtype=np.uint8))
    loose = np.flatnonzero((h & LOOSE) == 0) + 1                 # a cut falls after the byte
    strict = np.flatnonzero((h & STRICT) == 0) + 1
    ends: list[int] = []
    begin = i = j = 0
    loose_l, strict_l = loose.tolist(), strict.tolist()
    while n - begin > LEAST:
        low, mid, high = begin + LEAST, begin + NORMAL, min(begin + MOST, n)
        while i < len(strict_l) and strict_l[i] < low:
            i += 1
        if i < len(strict_l) and strict_l[i] <= min(mid, high):
            end = strict_l[i]
        else:
            while j < len(loose_l) and loose_l[j] <= mid:
                j += 1
            end = loose_l[j] if j < len(loose_l) and loose_l[j] < high else high
        ends.append(end)
        begin = end
    if begin < n:
        ends.append(n)
    return ends


def fingerprint(data: bytes) -> dict[int, int]:
    """Chunk digest -> bytes that its occurrences cover."""
    out: dict[int, int] = {}
    begin = 0
    for end in chunk_ends(data):
        digest = xxhash.xxh64_intdigest(data[begin:end])
        out[digest] = out.get(digest, 0) + end - begin
        begin = end
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of the bytes of ``a`` in chunks that ``b`` has too."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def written(f: dict[int, int]) -> str:
    """``digest:bytes`` in order of the digest, comma-joined."""
    return ",".join(f"{d:016x}:{f[d]}" for d in sorted(f))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(text: str, own: dict[int, int], following: str, other: dict[int, int]) -> tuple:
    changed = edited(text, following).encode()
    new = fingerprint(changed)
    return (len(text), hashlib.sha256(changed).hexdigest(), written(own), written(new),
            containment(own, new), containment(own, other))


_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _bounds(ids: DataFrame, ranges: int) -> np.ndarray:
    """Approximate quantiles of the ids, at most ``ranges`` - 1 of them."""
    if ranges < 2:
        return np.zeros(0, dtype=np.int64)
    found = ids.select(F.percentile_approx(
        "doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def _range_of(bounds: np.ndarray):
    """Range of an id: how many bounds lie below it; the last one is for NULL."""
    @F.pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(0).astype("int64").to_numpy())
        return pd.Series(np.where(ids.isna(), len(bounds) + 1, at).astype("int32"))

    return of


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ranges: int | None = None) -> DataFrame:
    """Per row: id, length, digest of the edited text, both fingerprints, and how
    much of the row's fingerprint that of the edited text and of the next document contains.

    ``ranges`` (default: twice the session's shuffle partitions) only spreads the work.
    Ids that are no integers are numbered in their order first.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        codes = value_codes(docs.select(id_col), id_col, by_frequency=False)
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        found = fingerprints(with_codes(rows, "id", codes).select("code", "text"), "code", "text", ranges)
        names = codes.select(F.col("code").alias("doc_id"), F.col("value").alias("__id"))
        return found.join(names, "doc_id", "left").select(F.col("__id").alias("doc_id"), *_COLUMNS)
    kind = docs.schema[id_col].dataType.simpleString()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    bounds = _bounds(ids, ranges or 2 * parts)
    range_of = _range_of(bounds)
    found = ids.groupBy(range_of("doc_id").alias("range")).agg(F.max("doc_id").alias("top")).collect()
    # Documents run from the highest range down and NULL ids come last, then the first again.
    present = sorted((r["range"] for r in found), key=lambda r: (r > len(bounds), -r))
    slots = len(bounds) + 2
    goes, top = np.full(slots, -1), np.zeros(slots, dtype=np.int64)
    for i, r in enumerate(present):
        goes[r] = present[i - 1]                               # a range's first row follows that range
    for r in found:
        top[r["range"]] = r["top"] or 0

    @F.pandas_udf("array<int>")
    def homes(keys: pd.Series) -> pd.Series:
        """The range of a row; a second one if the row may be the first of its range."""
        empty = keys.isna().to_numpy()
        key = keys.fillna(0).astype("int64").to_numpy()
        at = np.where(empty, slots - 1, np.searchsorted(bounds, key))
        first = empty | (top[at] == key)
        return pd.Series([[r, g] if f else [r] for r, g, f in zip(at.tolist(), goes[at].tolist(), first)])

    dealt = docs.select(
        F.col(id_col).alias("doc_id"), F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
        F.posexplode_outer(homes(F.col(id_col).cast("long"))).alias("lead", "range"))
    dealt = dealt.repartitionByRange(parts, "range").sortWithinPartitions(
        F.col("range"), F.col("lead"), F.col("doc_id").desc_nulls_last(), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                            # the row that waits for the next one
        for batch in batches:
            done, out = [], []
            keys, texts, where, leads = (batch.column(i).to_pylist() for i in range(4))
            for key, text, at, lead in zip(keys, texts, where, leads):
                if lead and (held is None or held[0] != at):
                    continue                                   # only the first row of a range follows
                own = fingerprint(text.encode())
                if held is not None and held[0] == at:
                    done.append(held[1])
                    out.append(_row(held[2], held[3], text, own))
                held = None if lead else (at, key, text, own)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(done, type=batch.schema.field(0).type)]
                    + [pa.array(c, type=t) for c, t in zip(zip(*out), _TYPES)], names=["doc_id", *_COLUMNS])

    return dealt.select("doc_id", "text", "range", "lead").mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
