"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words with smallest period q and a length of at
least ``exponent`` * q (and ``shortest``).  Runs are found scale by scale:

* *Small periods* (up to ``SMALL``) come from comparing the text with itself
  shifted.  These and the runs of lower scales are the *highly periodic
  regions* of a scale.
* *Scale t* (a power of two) serves the periods from 3t - 2 up to 6t - 3.
  Every stretch of t words has a hash identity; those with a period of at most
  t / 3 are left out.  Position i is in the synchronising set if the least
  identity left among i .. i + t is that of i or of i + t.  Membership depends
  only on the 2t words from i on, and any t positions in a row hold a member
  unless the 3t - 1 words from the first one have a period of at most t / 3.
* *Pairs.* Members with equal 2t words propose their distance as a period, if
  the scale serves it.  In a run of length 3q or more some position among the
  first q is not highly periodic, so a member lies within the first q + t and
  repeats, with its context, q words on: no run is missed.  Such a context
  has no period of t / 3 or less, so it occurs at most 18 times within 6t
  words and the pairs are at most so many times the members.
* *Check.* A proposed period is extended word by word in both directions;
  hashes only propose, so the runs are exact.

Documents of a batch are put end to end, longest first, with a unique mark
between them; a scale looks at the documents long enough for it.  Work is
near n log n words, and a text is handled whole in one task.

Defined results: a NULL or empty text has no words and no runs; each repeated
row has its own result; an empty table gives an empty result; other columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.terms import as_bytes, in_rows, plain_words

SMALL = 9                     # the first scale, 4, serves periods from 10 on
REGION = 3                    # length of a recorded region, in periods: what the scales above leave out
EXPONENT, SHORTEST = 4, 6
BATCH_WORDS = 1 << 18
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes each."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Identities of stretches of 2t words from those of t."""
    return _mixed(h[:-t], h[t:]) if len(h) > t else h[:0]


def _primitive(u: np.ndarray) -> bool:
    """Whether ``u`` is no repetition of a shorter string."""
    q, rest, r = len(u), len(u), 2
    while rest > 1:
        if r * r > rest:
            r = rest
        if rest % r == 0:
            d = q // r
            if (u[d:] == u[:-d]).all():
                return False
            while rest % r == 0:
                rest //= r
        r += 1
    return True


def _stretch(ids: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The longest ``[b, e)`` around ``at`` in which each word equals the one q words on."""
    n, e, step = len(ids) - q, at, 64
    while e < n:
        to = min(n, e + step)
        other = ids[e:to] != ids[e + q:to + q]
        k = int(other.argmax())
        if other[k]:
            e += k
            break
        e, step = to, step * 2
    b, step = at, 64
    while b > 0:
        to = max(0, b - step)
        other = (ids[to:b] != ids[to + q:b + q])[::-1]
        k = int(other.argmax())
        if other[k]:
            b -= k
            break
        b, step = to, step * 2
    return b, e


def _shifted(ids: np.ndarray, q: int, least: int) -> list[tuple[int, int, int]]:
    """Regions of period q and a length of at least ``least``, by comparing with the shifted text."""
    same = np.zeros(len(ids) - q + 2, dtype=np.int8)
    same[1:-1] = ids[q:] == ids[:-q]
    edges = np.flatnonzero(np.diff(same))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least - q
    return [(b, e + q, q) for b, e in zip(begin[long].tolist(), end[long].tolist())
            if q == 1 or _primitive(ids[b:b + q])]


def synchronising_set(h: np.ndarray, t: int, omitted: np.ndarray) -> np.ndarray:
    """Members of the set at scale t; ``h`` are identities of t words, ``omitted`` masks some."""
    v = np.where(omitted, _NONE, h)
    least, width = v, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    m = len(v) - t
    if m <= 0:
        return np.zeros(0, dtype=np.int64)
    least = np.minimum(least[:m], least[1:m + 1])
    return np.flatnonzero((least != _NONE) & ((v[:m] == least) | (v[t:t + m] == least)))


def _omitted(regions: list[tuple[int, int, int]], t: int, n: int) -> np.ndarray:
    """Which stretches of t words lie in a region of a period of at most t / 3."""
    step = np.zeros(n + 1, dtype=np.int32)
    for b, e, q in regions:
        if 3 * q <= t and e - b >= t and b < n:
            step[b] += 1
            step[min(e - t + 1, n)] -= 1
    return np.cumsum(step[:n]) > 0


def _proposed(members: np.ndarray, context: np.ndarray, t: int) -> list[tuple[int, int]]:
    """(period, position) of members that repeat with equal context at a distance the scale serves."""
    order = np.argsort(context, kind="stable")
    at, key = members[order], context[order]
    found, k = [], 1
    while k < len(at):
        distance = at[k:] - at[:-k]
        close = (key[k:] == key[:-k]) & (distance < 6 * t - 2)
        if not close.any():
            break
        close &= distance >= 3 * t - 2
        found.append(np.stack([distance[close], at[:-k][close]], axis=1))
        k += 1
    return [] if not found else np.unique(np.concatenate(found), axis=0).tolist()


def regions_of(ids: np.ndarray, lengths: list[int]) -> list[tuple[int, int, int]]:
    """All (begin, end, smallest period) of at least ``REGION`` periods, maximal.

    ``ids`` are word numbers of documents, longest first, each followed by a mark that
    occurs once; ``lengths`` are the documents' words.
    """
    ends = np.cumsum(np.array(lengths, dtype=np.int64) + 1)
    found: list[tuple[int, int, int]] = []

    def long_enough(n: int) -> int:
        """Where the documents of at least n words end."""
        k = int(np.searchsorted(-np.array(lengths), -n, "right"))
        return int(ends[k - 1]) if k else 0

    for q in range(1, SMALL + 1):
        to = long_enough(REGION * q)
        if to:
            found.extend(_shifted(ids[:to], q, REGION * q))
    h, t = _mixed(ids.view(np.uint64), ids.view(np.uint64)), 1
    while t < 4:
        h, t = _doubled(h, t), 2 * t
    while True:
        to = long_enough(REGION * (3 * t - 2))
        if not to:
            return found
        h = h[:max(0, to - t + 1)]
        twice = _doubled(h, t)
        members = synchronising_set(h, t, _omitted(found, t, len(h)))
        members = members[members < len(twice)]
        done, reach, new = 0, -1, []
        for q, at in _proposed(members, twice[members], t):
            if q == done and at < reach:
                continue                                  # in a stretch that is known
            b, reach = _stretch(ids[:to], at, q)
            done = q
            if reach - b >= (REGION - 1) * q and _primitive(ids[b:b + q]):
                new.append((b, reach + q, q))
        found.extend(new)
        h, t = twice, 2 * t


def runs_of(words: list[list[bytes]], exponent: int = EXPONENT,
            shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Per text its runs (start, length, period), by start, then period."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    lengths = [len(words[i]) for i in order]
    every = [w for i in order for w in words[i]]
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    ends = np.cumsum(np.array(lengths, dtype=np.int64) + 1)
    ids = np.empty(len(every) + len(words), dtype=np.int64)
    marks = ends - 1
    plain = np.ones(len(ids), dtype=bool)
    plain[marks] = False
    ids[plain] = np.fromiter(map(number.__getitem__, every), dtype=np.int64, count=len(every))
    ids[marks] = -1 - np.arange(len(words))
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for b, e, q in regions_of(ids, lengths):
        if e - b >= max(shortest, exponent * q):
            k = int(np.searchsorted(ends, b, "right"))
            out[order[k]].append((b - int(ends[k] - 1 - lengths[k]), e - b, q))
    for own in out:
        own.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by a space: of each run its first period stays."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        step[start + q] += 1
        step[start + length] -= 1
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
              shortest: int = SHORTEST) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (start, length, period by word) and ``collapsed``:
    the text's words without those that any run has after its first period."""
    if exponent < REGION:
        raise ValueError(f"exponent must be at least {REGION}")
    kind = docs.schema[id_col].dataType.simpleString()

    def results(keys: list, words: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(words, exponent, shortest)
        sizes = np.array([0] + [len(r) for r in runs]).cumsum().astype(np.int32)
        flat = [r for own in runs for r in own]
        columns = [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(keys), pa.array([len(w) for w in words], pa.int64()),
             pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(columns, fields=list(_RUN))),
             pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, words, total = [], [], 0
        for batch in in_rows(batches):
            begin = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = plain_words(text)
                if words and total + len(own) > BATCH_WORDS:
                    yield results(keys + [batch.column(0).slice(begin, i - begin)], words)
                    keys, words, total, begin = [], [], 0, i
                words.append(own)
                total += len(own)
            keys.append(batch.column(0).slice(begin))
        if words:
            yield results(keys, words)

    rows = docs.select(F.col(id_col).alias("doc_id"), as_bytes(F.col(text_col)).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
             "collapsed binary").withColumn("collapsed", F.col("collapsed").cast("string"))
