"""SentencePiece segmentations drawn without replacement, and decoding.

A text's lattice has a node at every character and an arc for every
vocabulary piece that matches there; a character that no piece covers
gets an arc of byte pieces.  An arc weighs -alpha * log(2 + rank of the
piece), and a segmentation's probability is its weight over the sum of
all.  ``k`` distinct segmentations are drawn by Gumbel top-k: every
segmentation has a log probability plus Gumbel noise, and the ``k``
largest are the sample.

They are found best first without listing segmentations.  The lattice
splits into *units* (no piece crosses the start of a run of spaces), so
a path is a choice per unit.  Following the path that holds the maximum
is plain sampling: the maximum under a node is handed on unchanged to
the branch that holds it.  At every unit the branches not taken form one
group whose own maximum is a Gumbel at the group's log mass, truncated
at the value of the path.  The group with the largest maximum holds the
next segmentation: it keeps the units before, takes another segmentation
of its unit (those already drawn excluded exactly) and goes on from
there, leaving new groups behind.  After ``k`` paths the largest group
left is the threshold, and the chance that a segmentation lies above it
is its inclusion score.

Scale: one pass over the documents, no shuffle, nothing kept between
batches but the vocabulary.  Random numbers are hashes of the row key,
the draw and the place in the text, so a row's result does not depend on
its batch, partition or attempt.  Lattices are built for the distinct
units of a slice of at most ``SLICE_CHARS`` characters (or one text).

Defined results: a NULL or empty text has one segmentation, the empty
one; a text with fewer than ``k`` segmentations gives all it has, each
with inclusion 1 (a tail of a unit's segmentations with less than 1e-12
of its mass is out of reach of double precision and is never drawn); rows with the same key and text give the same sample;
a NULL key is a key of its own; an empty table gives an empty result;
other columns are ignored.  ``decode`` returns the text exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import count as count_from

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 1.0
SEED = 42
SLICE_CHARS = 1_500_000
SPACE, LITERAL = "▁", "\ud800"          # LITERAL: the sign itself, in a text
_UNIT = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
_CODE_BITS = 21
_BUCKET_BITS = 17
_MASK = (1 << 64) - 1
_NOISE = 38.0                            # -log(-log u) of the largest number _mix gives, and some


class Vocabulary:
    """Pieces as a trie in sorted arrays, with weights and byte pieces."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.byte_id = np.zeros(256, dtype=np.int32)
        normal = []
        for i, piece in enumerate(self.text):
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        if any(not _UNIT.fullmatch(self.text[i]) for i in normal):
            raise ValueError("a piece crosses the start of a run of spaces or a line end")
        # what each piece stands for, as bytes: a byte piece for its byte, a space for the space sign
        byte_of = {int(i): bytes([b]) for b, i in enumerate(self.byte_id)}
        written = [byte_of[i] if i in byte_of else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        self.bytes = np.frombuffer(b"".join(written), dtype=np.uint8)
        self.byte_count = np.array([len(w) for w in written], dtype=np.int32)
        self.byte_first = np.cumsum(self.byte_count, dtype=np.int32) - self.byte_count
        self.weight = np.zeros(size)
        for rank, i in enumerate(normal):
            self.weight[i] = -alpha * np.log(2 + rank)
        self.byte_weight = -alpha * np.log(2 + len(normal))
        self.longest = max(len(self.text[i]) for i in normal)
        nodes: dict[tuple[int, str], int] = {}
        piece_at = {0: -1}
        for i in normal:
            at = 0
            for ch in self.text[i]:
                at = nodes.setdefault((at, ch), len(nodes) + 1)
                piece_at.setdefault(at, -1)
            piece_at[at] = i
        keys = np.array([(a << _CODE_BITS) | ord(c) for a, c in nodes], dtype=np.int64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        self.keys = keys[order]
        self.child = np.array(list(nodes.values()), dtype=np.int32)[order]
        self.bucket = np.searchsorted(bucket[order], np.arange((1 << _BUCKET_BITS) + 1)).astype(np.int32)
        self.root = np.full(1 << 16, -1, dtype=np.int32)         # children of the root by code, where short
        for (at, ch), node in nodes.items():
            if at == 0 and ord(ch) < 1 << 16:
                self.root[ord(ch)] = node
        self.piece_at = np.array([piece_at[i] for i in range(len(nodes) + 1)], dtype=np.int64)

    @staticmethod
    def _bucket(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _BUCKET_BITS)).astype(np.int32)

    def children(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The trie node after ``code`` at each node; -1 where there is none."""
        key = (state.astype(np.int64) << _CODE_BITS) | code
        bucket = self._bucket(key)
        at, end = self.bucket[bucket], self.bucket[bucket + 1]
        out = np.full(len(key), -1, dtype=np.int32)
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.keys[at] == key[open_]
            out[open_[hit]] = self.child[at[hit]]
            at += 1
            go = np.flatnonzero(~hit & (at < end))
            open_, at, end = open_[go], at[go], end[go]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids (of one whole text)."""
        if not len(ids):
            return ""
        size = self.byte_count[ids]
        ends = np.cumsum(size)
        place = np.repeat(self.byte_first[ids] - ends + size, size)
        place += np.arange(len(place), dtype=np.int32)
        return self.bytes[place].tobytes().decode("utf-8")[1:]


_LOADED: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    """The vocabulary, loaded once per Python process."""
    if (path, alpha) not in _LOADED:
        _LOADED[path, alpha] = Vocabulary(path, alpha)
    return _LOADED[path, alpha]


def _code_hashes(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


_LOW_HASH = _code_hashes(np.arange(1 << 16))


class Units:
    """The units of a list of texts: occurrences in order, and the distinct ones.

    A text is written as pieces write it, a space in front.  ``of`` names
    the distinct unit of every occurrence, ``count`` the occurrences per
    text; ``codes`` and ``lengths`` hold the distinct units one after the
    other.  Units are told apart by a 64-bit hash of their characters.
    """

    def __init__(self, texts: list[str]):
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        codes = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"),
                              dtype="<u4").astype(np.int32)
        codes[codes == ord(SPACE)] = ord(LITERAL)
        codes[codes == ord(" ")] = ord(SPACE)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        space, line = codes == ord(SPACE), codes == ord("\n")
        starts = np.ones(len(codes), dtype=bool)
        starts[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        starts[begin[:-1][sizes > 0]] = True
        first = np.flatnonzero(starts)
        self.count = np.diff(np.searchsorted(first, begin))
        if not len(first):
            self.of = np.zeros(0, dtype=np.int64)
            self.codes, self.lengths = codes, np.zeros(0, dtype=np.int64)
            return
        lengths = np.diff(first, append=len(codes))
        place = np.arange(len(codes), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(lengths.max()), 0xA0761D6478BD642F, dtype=np.uint64))
            signs = _LOW_HASH[codes] if codes.max() < 1 << 16 else _code_hashes(codes)
            signs *= powers[place]
            hashes = np.add.reduceat(signs, first)
        self.of, found = pd.factorize(hashes)
        shown = np.empty(len(found), dtype=np.int64)
        shown[self.of[::-1]] = np.arange(len(first))[::-1]
        self.lengths = lengths[shown]
        ends = np.cumsum(self.lengths)
        self.codes = codes[np.repeat(first[shown] - (ends - self.lengths), self.lengths) + np.arange(ends[-1])]


class Lattice:
    """Arcs and conditional probabilities for a list of distinct units.

    Node 0 is the end of every unit; a node per character follows, sorted
    by the distance to its unit's end.  The arcs of ``node`` are rows
    ``first[node]`` to ``first[node + 1]``, shortest first: ``piece`` (-1:
    byte pieces), ``to``, ``weight`` and ``upto`` (cumulated probability).
    """

    def __init__(self, vocab: Vocabulary, codes: np.ndarray, lengths: np.ndarray):
        total = len(codes)
        ends = np.cumsum(lengths)
        left = (np.repeat(ends, lengths) - np.arange(total)).astype(
            np.int16 if total and lengths.max() < 1 << 15 else np.int64)
        order = np.argsort(left, kind="stable")
        node_of = np.zeros(total + 1, dtype=np.int32)
        node_of[order] = np.arange(1, total + 1, dtype=np.int32)
        self.start = node_of[ends - lengths]
        self.code = np.zeros(total + 1, dtype=np.int32)
        self.code[node_of[:-1]] = codes

        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []       # node, node after, piece
        count = np.zeros(total + 2, dtype=np.int32)
        at, state, room = np.arange(total, dtype=np.int32), np.zeros(total, dtype=np.int32), left
        for length in range(1, vocab.longest + 1):
            if length == 1 and total and codes.max() < 1 << 16:
                state = vocab.root[codes]
            else:
                state = vocab.children(state, codes[at + (length - 1)])
            hit = np.flatnonzero(state >= 0)
            at, state, room = at[hit], state[hit], room[hit]
            piece = vocab.piece_at[state]
            real = piece >= 0
            node = node_of[at[real]]
            found.append((node, np.where(room[real] > length, node_of[at[real] + length], 0), piece[real]))
            count[node] += 1                                 # a node occurs once per length
            if length == 1:                                  # byte pieces where no piece is
                lone = np.flatnonzero(count[1:total + 1] == 0) + 1
                pos = order[lone - 1]
                found.append((lone, np.where(left[pos] > 1, node_of[pos + 1], 0), np.full(len(lone), -1)))
                count[lone] = 1
            more = np.flatnonzero(room > length)
            at, state, room = at[more], state[more], room[more]
            if not len(at):
                break
        self.first = np.concatenate([[0], np.cumsum(count)])[:total + 2].astype(np.int32)
        arcs = int(self.first[-1])
        self.piece = np.empty(arcs, dtype=np.int32)
        self.to = np.empty(arcs, dtype=np.int32)
        used = self.first.copy()
        for node, after, piece in found:
            row = used[node]
            self.piece[row], self.to[row] = piece, after
            used[node] = row + 1
        self.weight = vocab.weight[self.piece]
        lone = np.flatnonzero(self.piece == -1)
        spelled = np.searchsorted(self.first, lone, side="right") - 1
        self.weight[lone] = vocab.byte_weight * _utf8_length(self.code[spelled])

        self.ahead = np.zeros(total + 1)                     # log of the sum of all ways to the end
        self.upto = np.empty(arcs)
        bounds = np.searchsorted(left[order], np.arange(1, (int(left.max()) if total else 0) + 2)) + 1
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            rows = slice(int(self.first[a]), int(self.first[b]))
            begin = self.first[a:b] - rows.start
            ways = self.weight[rows] + self.ahead[self.to[rows]]
            size = np.diff(self.first[a:b + 1])
            top = np.maximum.reduceat(ways, begin)
            mass = np.exp(ways - np.repeat(top, size))
            whole = np.add.reduceat(mass, begin)
            self.ahead[a:b] = top + np.log(whole)
            run = np.cumsum(mass)
            before = np.concatenate([[0.0], run])[begin]
            self.upto[rows] = (run - np.repeat(before, size)) / np.repeat(whole, size)
        self.upto[self.first[2:] - 1] = 2.0                  # the last arc takes all that is left


def _utf8_length(code: np.ndarray) -> np.ndarray:
    code = np.where(code == ord(LITERAL), ord(SPACE), code)
    return 1 + (code >= 0x80).astype(int) + (code >= 0x800) + (code >= 0x10000)


def _mix(x: np.ndarray) -> np.ndarray:
    """A uniform number in (0, 1) from each 64-bit key (splitmix finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    out = x.astype(np.float64)
    out += 0.5
    out /= 1 << 53
    return out


def _place(seed: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a unit of a text, to which draw and step are added."""
    return seed + word.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)


def _uniform(place: np.ndarray, draw: int, step: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(place + (np.uint64(draw) * np.uint64(0xD6E8FEB86659FD93)
                             + np.uint64(step) * np.uint64(0xE7037ED1A0B428DB)))


def _number(place: int, draw: int, step: int) -> float:
    """``_uniform`` for a single key."""
    x = (place + draw * 0xD6E8FEB86659FD93 + step * 0xE7037ED1A0B428DB + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return (((x ^ (x >> 31)) >> 11) + 0.5) / (1 << 53)


class _Draw:
    """One plain sample of every occurrence: its arcs in order and its log probability."""

    def __init__(self, lattice: Lattice, unit: np.ndarray, place: np.ndarray, draw: int):
        n = len(unit)
        active, node = np.arange(n, dtype=np.int32), lattice.start[unit]
        pieces = np.zeros(n, dtype=np.int32)
        self.logp = -lattice.ahead[node]
        steps = []
        while len(active):
            u = _uniform(place, draw, len(steps) + 16)
            arc = lattice.first[node]
            behind = np.flatnonzero(lattice.upto[arc] < u)
            while len(behind):
                arc[behind] += 1
                behind = behind[lattice.upto[arc[behind]] < u[behind]]
            if len(active) == n:
                self.logp += lattice.weight[arc]
                pieces += 1
            else:
                self.logp[active] += lattice.weight[arc]
                pieces[active] += 1
            steps.append((active, arc))
            node = lattice.to[arc]
            go = np.flatnonzero(node)
            active, node, place = active[go], node[go], place[go]
        self.first = np.concatenate([[0], np.cumsum(pieces, dtype=np.int64)])
        self.arc = np.empty(self.first[-1], dtype=np.int32)
        for s, (who, arc) in enumerate(steps):
            self.arc[self.first[who] + s] = arc
        np.minimum(self.logp, 0.0, out=self.logp)


def _truncated(location: np.ndarray, top: np.ndarray | float, u: np.ndarray) -> np.ndarray:
    """Gumbel numbers at ``location``, each at most ``top``; -inf where the mass is 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = location - np.logaddexp(location - top, np.log(-np.log(u)))
    return np.where(np.isneginf(location), -np.inf, out)


def _log_rest(logp: np.ndarray) -> np.ndarray:
    """log(1 - p), -inf where nothing is left."""
    rest = -np.expm1(logp)
    with np.errstate(divide="ignore"):
        return np.where(rest <= 1e-12, -np.inf, np.log(rest))


def _another(lattice: Lattice, unit: int, barred: list[tuple[int, ...]], rand: Iterator[float]):
    """A segmentation of a unit that is not barred (arcs, log probability); None if none is left.

    At each node an arc's share loses what the barred segmentations below
    it hold, so the draw is exact and never tried again.
    """
    node = int(lattice.start[unit])
    out: list[int] = []
    logp = 0.0
    below = [(arcs, math.exp(_path_logp(lattice, node, arcs))) for arcs in barred]
    while node:
        begin, end = int(lattice.first[node]), int(lattice.first[node + 1])
        whole = float(lattice.ahead[node])
        after = lattice.to[begin:end].tolist()
        shares = [math.exp(w + a - whole) for w, a in zip(
            lattice.weight[begin:end].tolist(), lattice.ahead[after].tolist())]
        mass = shares.copy()
        for arcs, p in below:
            mass[arcs[0] - begin] -= p
        mass = [m if m >= 1e-13 else 0.0 for m in mass]
        left = next(rand) * sum(mass)
        pick = -1
        for i, m in enumerate(mass):
            if m > 0:
                pick = i
                left -= m
                if left < 0:
                    break
        if pick < 0:
            return None
        below = [(arcs[1:], p / shares[pick]) for arcs, p in below if arcs[0] == begin + pick]
        logp += math.log(shares[pick])
        out.append(begin + pick)
        node = after[pick]
    return tuple(out), min(0.0, logp)


def _path_logp(lattice: Lattice, node: int, arcs: tuple[int, ...]) -> float:
    return min(0.0, sum(lattice.weight[list(arcs)].tolist()) - float(lattice.ahead[node]))


class _Path:
    """A drawn segmentation of one text: the arcs of its units, and the groups it leaves."""

    __slots__ = ("arcs", "first", "logp", "value", "groups", "barred")

    def __init__(self, arcs, first, logp, value, groups):
        self.arcs, self.first, self.logp = arcs, first, logp
        self.value, self.groups = value, groups
        self.barred: dict[int, list[tuple[int, ...]]] = {}

    def unit_arcs(self, j: int) -> tuple[int, ...]:
        return tuple(self.arcs[self.first[j]:self.first[j + 1]].tolist())

    def best(self) -> float:
        return float(self.groups.max()) if len(self.groups) else -np.inf


def _groups(logp: np.ndarray, value: float, place: np.ndarray, draw: int, k: int,
            begin: int = 0) -> np.ndarray:
    """Maximum of the branches not taken at each unit from ``begin`` on.

    The masses fall along the text and no noise passes ``_NOISE``, so once
    a unit's mass plus that is below the ``k``-th largest maximum so far,
    no later group can be among the ``k`` largest, and the array ends.
    """
    stop = begin
    width = 256
    out = np.full(begin, -np.inf)
    at = float(logp[:begin].sum())
    while stop < len(logp):
        part = logp[stop:stop + width]
        run = at + np.cumsum(part)
        out = np.concatenate([out, _truncated(
            run - part + _log_rest(part), value, _uniform(place[stop:stop + width], draw, 1))])
        at, stop, width = float(run[-1]), stop + width, 2 * width
        if len(out) >= k and at + _NOISE < np.partition(out, -k)[-k]:
            break
    return out


def sample_texts(vocab: Vocabulary, keys: list[bytes], texts: list[str], k: int, seed: int):
    """For each text its samples: lists of (ids, log probability, perturbed, log inclusion)."""
    units = Units(texts)
    lattice = Lattice(vocab, units.codes, units.lengths)
    counts, unit = units.count, units.of
    begin = np.concatenate([[0], np.cumsum(counts)])
    doc_seed = np.array([xxhash.xxh64_intdigest(key, seed) for key in keys], dtype=np.uint64)
    place = _place(np.repeat(doc_seed, counts), np.arange(len(unit)) - np.repeat(begin[:-1], counts))
    top = -np.log(-np.log(_uniform(doc_seed, 0, 0)))

    paths: list[list[_Path]] = [[] for _ in texts]
    for draw in range(k):
        fresh = _Draw(lattice, unit, place, draw)
        for d in range(len(texts)):
            a, b = int(begin[d]), int(begin[d + 1])
            f0 = int(fresh.first[a])
            first, arcs = fresh.first[a:b + 1] - f0, fresh.arc[f0:int(fresh.first[b])]
            noise = (place[a:b], draw)
            logp = fresh.logp[a:b]
            if draw == 0:
                value = float(top[d])
                paths[d].append(_Path(arcs, first, logp, value, _groups(logp, value, *noise, k)))
            elif len(paths[d]) == draw:
                new = _next_path(lattice, unit[a:b], paths[d], arcs, first, logp, noise, k)
                if new is not None:
                    paths[d].append(new)
    out = []
    for own in paths:
        threshold = max(p.best() for p in own) if len(own) == k else -np.inf
        out.append([(_ids(vocab, lattice, p), total, p.value, _log_inclusion(total, threshold))
                    for p in own for total in (float(p.logp.sum()),)])
    return out


def _next_path(lattice, unit, own: list[_Path], arcs, first, logp, noise, k) -> _Path | None:
    """The best segmentation in the groups that a text's paths leave; None if there is none."""
    place, draw = noise
    while True:
        best = max(own, key=_Path.best)
        value = best.best()
        if np.isneginf(value):
            return None
        j = int(best.groups.argmax())
        barred = best.barred.setdefault(j, [best.unit_arcs(j)])
        key = int(place[j])
        numbers = (_number(key, draw, (1 << 24) + i) for i in count_from(0))
        found = _another(lattice, int(unit[j]), barred, numbers)
        if found is not None:
            break
        best.groups[j] = -np.inf
    chosen, chosen_logp = found
    head, tail = int(best.first[j]), int(first[j + 1])
    new_logp = np.concatenate([best.logp[:j], [chosen_logp], logp[j + 1:]])
    new = _Path(np.concatenate([best.arcs[:head], np.array(chosen, dtype=np.int32), arcs[tail:]]),
                np.concatenate([best.first[:j + 1], first[j + 1:] - tail + head + len(chosen)]),
                new_logp, value, _groups(new_logp, value, *noise, k, begin=j + 1))
    # what is left of the group at this unit stays with the path it branched from
    barred.append(chosen)
    start = int(lattice.start[unit[j]])
    rest = 1.0 - sum(math.exp(_path_logp(lattice, start, b)) for b in barred)
    u = _uniform(place[j:j + 1], draw, 2)
    best.groups[j] = -np.inf if rest <= 1e-12 else float(
        _truncated(np.array([best.logp[:j].sum() + np.log(rest)]), value, u)[0])
    return new


def _log_inclusion(logp: float, threshold: float) -> float:
    """log of the chance that log p plus Gumbel noise passes the threshold."""
    if np.isneginf(threshold):
        return 0.0
    x = logp - threshold
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


def _ids(vocab: Vocabulary, lattice: Lattice, path: _Path) -> np.ndarray:
    """Ids of a path, byte arcs spelled out."""
    ids = lattice.piece[path.arcs]
    lone = np.flatnonzero(ids == -1)
    if not len(lone):
        return ids
    codes = lattice.code[np.searchsorted(lattice.first, path.arcs[lone], side="right") - 1]
    if (codes < 0x80).all():
        ids[lone] = vocab.byte_id[codes]
        return ids
    parts, last = [], 0
    for i, code in zip(lone.tolist(), codes.tolist()):
        sign = SPACE if code == ord(LITERAL) else chr(code)
        parts += [ids[last:i], vocab.byte_id[np.frombuffer(sign.encode("utf-8"), dtype=np.uint8)]]
        last = i + 1
    return np.concatenate([*parts, ids[last:]])


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if i > a and total + n > SLICE_CHARS:
            yield a, i
            a, total = i, 0
        total += n
    if sizes:
        yield a, len(sizes)


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES,
           alpha: float = ALPHA, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """``k`` distinct segmentations per row: ``rank``, ``ids``, ``log_prob``, ``perturbed``,
    ``log_inclusion`` and ``round_trip`` (whether the ids decode to the text)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def drawn_of(vocab: Vocabulary, part: pa.RecordBatch) -> pa.RecordBatch:
        """The samples of a slice; in a function of its own, so that nothing of it outlives it."""
        texts = [t or "" for t in part.column(2).to_pylist()]
        keys = [b"" if x is None else b"=" + x.encode() for x in part.column(1).to_pylist()]
        drawn = sample_texts(vocab, keys, texts, k, seed)
        rows = [(i, r, *s) for i, found in enumerate(drawn) for r, s in enumerate(found)]
        flat = [row[2] for row in rows]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
        values = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32)
        return pa.RecordBatch.from_arrays([
            part.column(0).take(pa.array([r[0] for r in rows], type=pa.int32())),
            pa.array([r[1] for r in rows], type=pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            pa.array([r[3] for r in rows]), pa.array([r[4] for r in rows]),
            pa.array([r[5] for r in rows]),
            pa.array([vocab.decode(r[2]) == texts[r[0]] for r in rows])],
            names=["doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, alpha)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
            for a, b in _slices(sizes):
                yield drawn_of(vocab, batch.slice(a, b - a))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("key"),
                       F.make_valid_utf8(F.col(text_col)).alias("text")).mapInArrow(
        run, f"doc_id {kind}, rank int, ids array<int>, log_prob double, perturbed double, "
             "log_inclusion double, round_trip boolean")


def decode(tokens: DataFrame, ids_col: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """``tokens`` with the text that each row's piece ids stand for; NULL for NULL ids.

    A column of the name ``out`` gives way to the text.  Ids that are no pieces are an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, ALPHA)
        at = names.index(ids_col)
        for batch in batches:
            texts = [None if ids is None else vocab.decode(np.asarray(ids, dtype=np.int64))
                     for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    kept = tokens.drop(out)
    names = kept.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, `{out}` string")
