"""Benchmark decontamination over a distributed positional inverted index.

1. *Index* (``build_index``).  Documents are dealt into shards as they are
   read, at most ``SHARD_WORDS`` words each unless one document has more.
   Within a shard every word has a number: documents follow each other with
   ``GAP`` numbers between them.  A row per (shard, word) holds the word's
   positions as variable-length differences; a row per document holds its id
   and length.  The table holds every word of every document and can serve any
   number of later searches.
2. *Phrases.* Each item's windows of ``window`` words (the whole item if it is
   shorter).  Items come in blocks of at most ``MAX_PHRASES`` phrases, and what
   is broadcast is one block.
3. *Intersection* (``phrase_matches``).  The postings of the block's words meet
   by shard.  Each phrase starts from its rarest word in the corpus; its
   positions less the word's offset are the candidates, and the lists of the
   other words, from the rarest on, are intersected with them at their own
   offsets.  With ``slop`` a word may stand up to so many places off its place
   counted from the rarest word (a proximity match); exact matches are the
   candidates that also pass without slop.

A shard's work is bounded by the shard and the block, also where a passage
stands in very many documents.  No text is shuffled, only postings of words
that some phrase has, and no list leaves its shard.

Defined results: NULL and empty texts have no words and no hits; a repeated row is a
document of its own; an item without words has no windows; the items of one id
are one item; a NULL item id counts as an item and is not written in joined ids;
empty tables give no rows, or no hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.terms import as_bytes, folded_words, in_rows, item_blocks

SHARD_WORDS = 1 << 19
GAP = 1 << 10
MAX_PHRASES = 1_000_000
CANDIDATES = 2_000_000         # handled at once
WINDOW = 10
SLOP = 2


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as bytes of 7 bits, the lowest first; where each one ends."""
    size = np.ones(len(values), dtype=np.int64)
    rest = values >> 7
    while rest.any():
        size += rest > 0
        rest >>= 7
    ends = np.cumsum(size)
    out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
    begin = ends - size
    for k in range(int(size.max(initial=0))):
        more = size > k
        out[begin[more] + k] = ((values[more] >> (7 * k)) & 127) | ((size[more] > k + 1) << 7)
    return out, ends


def decode(data: np.ndarray) -> np.ndarray:
    """The integers that ``encode`` wrote."""
    ends = np.flatnonzero(data < 128)
    begin = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out = np.zeros(len(ends), dtype=np.int64)
    size = ends - begin + 1
    for k in range(int(size.max(initial=0))):
        more = size > k
        out[more] |= (data[begin[more] + k].astype(np.int64) & 127) << (7 * k)
    return out


def _shard_rows(shard: int, names, words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: a row per document, then a row per word."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    docs = len(words)
    empty = lambda n, t: pa.nulls(n, t)
    columns = ["shard", "term", "n", "postings", "ord", "doc_id"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(docs, shard)), empty(docs, pa.binary()), pa.array(lengths.astype(np.int32)),
         empty(docs, pa.binary()), pa.array(np.arange(docs, dtype=np.int32)), names], names=columns)
    every = [w for own in words for w in own]
    if not every:
        return
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    term = np.fromiter(map(number.__getitem__, every), dtype=np.int32, count=len(every))
    base = np.cumsum(lengths + GAP) - lengths - GAP
    at = np.arange(len(every)) + np.repeat(base - (np.cumsum(lengths) - lengths), lengths)
    at = at[np.argsort(term, kind="stable")]
    counts = np.bincount(term, minlength=len(number))
    first = np.cumsum(counts) - counts
    step = np.diff(at, prepend=0)
    step[first] = at[first]
    data, ends = encode(step)
    offsets = np.concatenate([[0], ends[np.cumsum(counts) - 1]]).astype(np.int32)
    postings = pa.Array.from_buffers(pa.binary(), len(number),
                                     [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    n = len(number)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, shard)), pa.array(list(number), pa.binary()), pa.array(counts.astype(np.int32)),
         postings, empty(n, pa.int32()), empty(n, names.type)], names=columns)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index as a scratch table: ``shard, term, n, postings`` and, with a NULL term, ``ord, doc_id, n``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        names, words, total = [], [], 0

        def closed():
            return _shard_rows(shard, pa.concat_arrays(names), words)

        for batch in in_rows(batches):
            begin = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = folded_words(text)
                if words and total + len(own) > shard_words:
                    names.append(batch.column(0).slice(begin, i - begin))
                    yield from closed()
                    shard, names, words, total, begin = shard + 1, [], [], 0, i
                words.append(own)
                total += len(own)
            names.append(batch.column(0).slice(begin))
        if words:
            yield from closed()

    rows = docs.select(F.col(id_col).alias("doc_id"), as_bytes(F.col(text_col)).alias("text"))
    return materialise(rows.mapInArrow(
        run, f"shard long, term binary, n int, postings binary, ord int, doc_id {kind}"), "positions")


def item_phrases(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """The different windows of each item: ``item_id`` and ``phrase`` (words joined by a space)."""
    if not 1 <= window <= GAP // 2:
        raise ValueError(f"window must be 1 to {GAP // 2}")
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_rows(batches):
            at, phrases = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = folded_words(text)
                own = dict.fromkeys(b" ".join(words[k:k + window])
                                    for k in range(max(1, len(words) - window + 1))) if words else ()
                phrases.extend(own)
                at.extend([i] * len(own))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())),
                                              pa.array(phrases, pa.binary())], names=["item_id", "phrase"])

    rows = items.select(F.col(id_col).alias("item_id"), as_bytes(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, f"item_id {kind}, phrase binary").distinct()


class _Block:
    """A block of phrases as arrays: words by number, offsets in order of rarity, items."""

    def __init__(self, table: pa.Table, count_of: dict[bytes, int]):
        ids = table["item_id"].combine_chunks()
        self.items = pc.unique(ids)
        number: dict[bytes, int] = {}
        row = np.array([number.setdefault(p, len(number)) for p in table["phrase"].to_pylist()], dtype=np.int64)
        item = pc.index_in(ids, self.items).to_numpy().astype(np.int64)
        words = [p.split(b" ") for p in number]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for p in words for w in p}))}
        frequency = np.array([count_of.get(w, 0) for w in self.vocabulary] + [np.iinfo(np.int64).max])
        self.length = np.array([len(p) for p in words], dtype=np.int64)
        wide = int(self.length.max(initial=1))
        self.word = np.full((len(words), wide), len(self.vocabulary), dtype=np.int64)
        for i, p in enumerate(words):
            self.word[i, :len(p)] = [self.vocabulary[w] for w in p]
        self.order = np.argsort(frequency[self.word], axis=1, kind="stable")     # ties: the first offset
        order = np.argsort(row, kind="stable")
        self.item = item[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))])


def _expand(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + counts, counts)


def _positions(n: np.ndarray, blobs: pa.Array) -> np.ndarray:
    """The positions of all lists, one list after the other."""
    step = decode(np.frombuffer(b"".join(blobs.to_pylist()), dtype=np.uint8))
    first = np.cumsum(n) - n
    total = np.cumsum(step)
    return total - np.repeat(total[first] - step[first], n)


def _intersected(block: _Block, present: np.ndarray, begin: np.ndarray, keys: np.ndarray, span: int,
                 slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Phrase, where it starts, and whether it is exact, in stretches of bounded size.

    ``keys`` are word * ``span`` + position in order; word w has those from ``begin[w]``
    to ``begin[w + 1]``, and ``present`` says whether it has any.
    """
    alive = np.flatnonzero(np.append(present, True)[block.word].all(axis=1))
    rarest = block.order[alive, 0]
    word = block.word[alive, rarest]
    counts = begin[word + 1] - begin[word]
    at, total = 0, np.cumsum(counts)
    while at < len(alive):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + CANDIDATES, "right")))
        own = slice(at, to)
        phrase = np.repeat(alive[own], counts[own])
        start = keys[_expand(begin[word[own]], counts[own])] % span - np.repeat(rarest[own], counts[own])
        at = to

        def holds(phrase: np.ndarray, start: np.ndarray, reach: int) -> np.ndarray:
            left = np.arange(len(phrase))
            for k in range(1, block.word.shape[1]):
                offset = block.order[phrase[left], k]
                longer = block.length[phrase[left]] > k
                wanted = block.word[phrase[left], offset] * span + start[left] + offset
                low = np.maximum(wanted - reach, 0)
                found = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
                near = (keys[found] >= low) & (keys[found] <= wanted + reach)
                left = left[near | ~longer]
            return left

        near = holds(phrase, start, slop)
        phrase, start = phrase[near], start[near]
        exact = np.zeros(len(phrase), dtype=bool)
        exact[holds(phrase, start, 0) if slop else slice(None)] = True
        yield phrase, start, exact


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals that the given ones cover."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.zeros(0, dtype=bool)
    last = np.concatenate([new[1:], [True]]) if len(start) else new
    return start[new], reach[last]


def _lists(owner: np.ndarray, docs: np.ndarray, values: pa.Array) -> pa.ListArray:
    """``values`` as one list per entry of ``docs``; ``owner`` is sorted."""
    ends = np.searchsorted(owner, docs, "right")
    begin = np.searchsorted(owner, docs, "left")
    return pa.ListArray.from_arrays(pa.array(np.concatenate([begin[:1], ends]).astype(np.int32)), values)


MATCHES = "shard long, ord int, hits array<struct<start:int,end:int>>, items array<{k}>, near array<{k}>"


def _matcher(block, slop: int):
    def run(group: pa.Table) -> pa.Table:
        b: _Block = block.value
        group = group.combine_chunks()
        doc = group.filter(pc.is_null(group["number"])).sort_by("ord")
        lists = group.filter(pc.is_valid(group["number"])).sort_by("number")
        own = pa.schema([("shard", pa.int64()), ("ord", pa.int32()),
                         ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         ("items", pa.list_(b.items.type)), ("near", pa.list_(b.items.type))])
        if not lists.num_rows or not doc.num_rows:
            return own.empty_table()
        length = doc["n"].to_numpy().astype(np.int64)
        base = np.cumsum(length + GAP) - length - GAP
        span = int(base[-1] + length[-1]) + 2 * GAP
        n = lists["n"].to_numpy().astype(np.int64)
        word = lists["number"].to_numpy().astype(np.int64)
        keys = np.repeat(word * span, n) + _positions(n, lists["postings"].combine_chunks())
        counts = np.zeros(len(b.vocabulary), dtype=np.int64)
        counts[word] = n
        begin = np.concatenate([[0], np.cumsum(counts)])
        starts, ends, exact_pairs, near_pairs = [], [], [], []
        wide = len(b.length)
        for phrase, start, exact in _intersected(b, counts > 0, begin, keys, span, slop):
            # a near match may begin before its document: its rarest word never does
            anchor = start + b.order[phrase, 0]
            pair = (np.searchsorted(base, anchor, "right") - 1) * wide + phrase
            exact_pairs.append(np.unique(pair[exact]))
            near_pairs.append(np.unique(pair))
            s, e = _merged(start[exact], start[exact] + b.length[phrase[exact]])
            starts.append(s)
            ends.append(e)
        if not near_pairs:
            return own.empty_table()

        def items_of(pairs: list[np.ndarray]) -> tuple[np.ndarray, pa.Array]:
            pair = np.unique(np.concatenate(pairs))
            phrase, fan = pair % wide, b.first[pair % wide + 1] - b.first[pair % wide]
            found = np.unique(np.repeat(pair // wide, fan) * len(b.items) + b.item[_expand(b.first[phrase], fan)])
            return found // len(b.items), b.items.take(pa.array(found % len(b.items)))

        start, end = _merged(np.concatenate(starts), np.concatenate(ends))
        inside = np.searchsorted(base, start, "right") - 1
        hit = pa.StructArray.from_arrays(
            [pa.array((start - base[inside]).astype(np.int32)), pa.array((end - base[inside]).astype(np.int32))],
            names=["start", "end"])
        (exact_doc, exact_item), (near_doc, near_item) = items_of(exact_pairs), items_of(near_pairs)
        docs = np.unique(near_doc)
        return pa.table([
            pa.array(np.full(len(docs), group["shard"][0].as_py())),
            doc["ord"].combine_chunks().take(pa.array(docs)), _lists(inside, docs, hit),
            _lists(exact_doc, docs, exact_item), _lists(near_doc, docs, near_item)], schema=own) \
            if len(docs) else own.empty_table()

    return run


def phrase_matches(index: DataFrame, phrases: DataFrame, slop: int = SLOP,
                   max_phrases: int = MAX_PHRASES) -> DataFrame:
    """Per document (``shard``, ``ord``) with a match: ``hits`` (word ranges that exact matches cover),
    ``items`` with an exact match and ``near``: items with an exact or proximity match.

    ``phrases`` as from ``item_phrases``.  One row per document and block of items.
    """
    if not 0 <= slop <= GAP // 4:
        raise ValueError(f"slop must be 0 to {GAP // 4}")
    spark = index.sparkSession
    phrases = materialise(phrases, "phrases")
    kind = phrases.schema["item_id"].dataType.simpleString()
    out = None
    for rows in item_blocks(phrases, max_phrases):
        table = rows.sort("item_id", "phrase").toArrow()
        words = sorted({w for p in table["phrase"].to_pylist() for w in p.split(b" ")})
        known = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term binary, number int")
        lists = index.select("shard", "term", "n", "postings", "ord").join(F.broadcast(known), "term", "left") \
            .filter(F.col("number").isNotNull() | F.col("term").isNull())
        counts = lists.filter("number is not null").groupBy("number").agg(F.sum("n"))
        block = spark.sparkContext.broadcast(
            _Block(table, {words[i]: n for i, n in counts.toLocalIterator()}))    # one row per word
        found = lists.select("shard", "number", "n", "postings", "ord").groupBy("shard") \
            .applyInArrow(_matcher(block, slop), MATCHES.format(k=kind))
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCHES.format(k=kind)) if out is None else out


def _covered(hits: Column) -> Column:
    """How many words the ranges cover, counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    step = lambda acc, h: F.struct(
        (acc["n"] + F.greatest(h["end"] - F.greatest(h["start"], acc["reach"]), F.lit(0))).alias("n"),
        F.greatest(acc["reach"], h["end"]).alias("reach"))
    return F.aggregate(F.array_sort(hits), zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  slop: int = SLOP, shard_words: int = SHARD_WORDS,
                  max_phrases: int = MAX_PHRASES) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` words inside an exact match, the ``items`` matched
    and the items ``near`` (within ``slop``; the matched ones included)."""
    index = build_index(docs, id_col, text_col, shard_words)
    matches = phrase_matches(index, item_phrases(items, item_id, item_text, window), slop, max_phrases)
    joined = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    found = matches.groupBy("shard", "ord").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), joined("items").alias("items"), joined("near").alias("near"))
    none = lambda c: F.coalesce(F.col(c), F.array().cast(found.schema[c].dataType))
    return index.filter(F.col("term").isNull()).select("shard", "ord", "doc_id", "n") \
        .join(found, ["shard", "ord"], "left").select(
            "doc_id", F.col("n").cast("long").alias("n_words"), _covered(none("hits")).alias("n_hit"),
            none("items").alias("items"), none("near").alias("near"))
