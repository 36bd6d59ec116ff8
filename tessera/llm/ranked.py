"""Ranked lexical search, reversed: the items' inverted index goes to the documents.

1. *Index.* The items' terms with their counts are turned into an inverted
   index term -> (item, count).  It is broadcast; items come in blocks of at
   most ``MAX_ENTRIES`` (item, term) pairs (``item_blocks``), and a larger set
   takes one pass over the documents per block.
2. *Counts.* One pass over the texts keeps of each document its length and
   the counts of the terms that some item has, as a scratch table.  The
   corpus figures (documents, terms, document frequencies) are partial
   aggregates of that table.
3. *Stream.* Each task streams its documents' term counts through the index,
   sums the scores of a slice of documents against all items of the block
   and updates one bounded heap per item.
4. *Merge.* The heaps (at most ``top`` rows per item and task) are merged in
   two steps, first per item and hash class of the document, then per item,
   so that no task sees all heaps of an item.

A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's
damping 75 + (25 n N) div L, and a score the sum over the item's terms,
repeats included, of weight * ((10^9 tf) div (1000 tf + 12 damping)).

Defined results: NULL and empty texts have no terms, are never returned and
do not count as documents; equal scores go by ascending id, NULL ids last;
each repeated row is a document of its own; items with one id are one item,
whose terms are those of all its different texts; items without a
hit, an empty table of items or documents give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import materialise
from tessera.llm.terms import as_bytes, folded_words, in_rows, item_blocks

TOP = 20
MAX_ENTRIES = 2_000_000
SLICE = 4_000_000          # cells of a slice's score table, and sums made at once
CLASSES = 64


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id``, ``term`` and its count ``n`` over the item's different texts."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_rows(batches):
            counts = [Counter(folded_words(t)) for t in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)),
                 pa.array([t for c in counts for t in c], pa.binary()),
                 pa.array([n for c in counts for n in c.values()], pa.int64())], names=["item_id", "term", "n"])

    rows = items.select(F.col(id_col).alias("item_id"), as_bytes(F.col(text_col)).alias("text")).distinct()
    return rows.mapInArrow(run, f"item_id {kind}, term binary, n long") \
        .groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def _counted(known):
    """Per document with a term: its length, the numbers of the known terms in it, their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in in_rows(batches):
            rows, lengths, terms, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = folded_words(text)
                if not words:
                    continue
                own = Counter(map(number, words))
                own.pop(None, None)
                rows.append(i)
                lengths.append(len(words))
                terms.extend(own)
                counts.extend(own.values())
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return run


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them), for each i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _slices(sums: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Stretches of documents with few enough cells (``width`` each) and sums."""
    at, most = 0, max(1, SLICE // max(1, width))
    total = np.concatenate([[0], np.cumsum(sums)])
    while at < len(sums):
        to = int(np.searchsorted(total, total[at] + SLICE, "right")) - 1
        to = min(max(to, at + 1), at + most, len(sums))
        yield at, to
        at = to


def _heaps(index, top: int):
    """Streams documents' term counts through the index; the best of each item at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, first, item_of, times, weights, documents, length = index.value
        heaps: list[list[tuple]] = [[] for _ in range(len(ids))]
        floor = np.ones(len(ids), dtype=np.int64)
        kind = None
        for batch in in_rows(batches, 4096):
            keys = batch.column(0)
            kind = keys.type
            n = batch.column(1).to_numpy()
            terms = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy()
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            place = np.empty(len(n), dtype=np.int64)          # of the ids among themselves, NULL last
            place[pc.sort_indices(keys).to_numpy()] = np.arange(len(n))
            damping = 75 + (25 * n * documents) // length
            doc = np.repeat(np.arange(len(n)), sizes)
            gain = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * damping[doc]))
            fan = first[terms + 1] - first[terms]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            per_doc = np.diff(np.concatenate([[0], np.cumsum(fan)])[begin])
            for a, b in _slices(per_doc, len(ids)):
                own = slice(begin[a], begin[b])
                cell = _ragged(first[terms[own]], fan[own])
                row = np.repeat(doc[own] - a, fan[own])
                scores = np.zeros((b - a) * len(ids), dtype=np.int64)
                np.add.at(scores, row * len(ids) + item_of[cell], np.repeat(gain[own], fan[own]) * times[cell])
                _keep(scores.reshape(b - a, len(ids)), place[a:b], keys.slice(a, b - a), heaps, floor, top)
        found = [(i, key, -less) for i, heap in enumerate(heaps) for less, _, key in heap]
        if found:
            at, key, score = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(key, kind), pa.array(score, pa.int64())],
                names=["item_id", "doc_id", "score"])

    return run


def _keep(scores: np.ndarray, place: np.ndarray, keys: pa.Array, heaps: list, floor: np.ndarray,
          top: int) -> None:
    """Moves what is good enough from a slice's scores to the heaps; ``floor`` rises with them."""
    row, item = np.nonzero(scores >= floor)
    if not len(row):
        return
    order = np.lexsort((place[row], -scores[row, item], item))
    row, item = row[order], item[order]
    begin = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    rank = np.arange(len(item)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(item)]])))
    row, item = row[rank < top], item[rank < top]
    named = keys.take(pa.array(row)).to_pylist()
    new: dict[int, list] = {}
    for i, s, key in zip(item.tolist(), scores[row, item].tolist(), named):
        new.setdefault(i, []).append((-s, key is None, key))
    for i, rows in new.items():
        heaps[i] = sorted(heaps[i] + rows)[:top]
        if len(heaps[i]) == top:
            floor[i] = -heaps[i][-1][0]


def _search_block(rows: DataFrame, kind: str, entries: DataFrame, top: int) -> DataFrame:
    """The unmerged heaps of one block of items."""
    spark = rows.sparkSession
    table = entries.sort("item_id", "term").toArrow()
    ids = table["item_id"].combine_chunks()
    number: dict[bytes, int] = {}
    term = np.array([number.setdefault(t, len(number)) for t in table["term"].to_pylist()], dtype=np.int64)
    names = pc.unique(ids)
    item = pc.index_in(ids, names).to_numpy().astype(np.int64)
    order = np.argsort(term, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(number)))])
    known = spark.sparkContext.broadcast(number)
    counts = materialise(rows.mapInArrow(
        _counted(known), f"doc_id {kind}, n long, terms array<int>, counts array<long>"), "term-counts")
    documents, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(number), dtype=np.int64)
    for t, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[t] = weight(df, documents)                     # one row per term of the block
    index = spark.sparkContext.broadcast(
        (names, first, item[order], table["n"].to_numpy()[order], weights, documents, max(length, 1)))
    item_kind = entries.schema["item_id"].dataType.simpleString()
    return counts.mapInArrow(_heaps(index, top), f"item_id {item_kind}, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", top: int = TOP,
           max_entries: int = MAX_ENTRIES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: each item's ``top`` best documents."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), as_bytes(F.col(text_col)).alias("text"))
    entries = materialise(item_terms(items, item_id, item_text), "item-terms")
    heaps = None
    for block in item_blocks(entries, max_entries):
        own = _search_block(rows, kind, block, top)
        heaps = own if heaps is None else heaps.unionByName(own)
    if heaps is None:
        heaps = docs.sparkSession.createDataFrame([], StructType([
            StructField("item_id", items.schema[item_id].dataType),
            StructField("doc_id", docs.schema[id_col].dataType), StructField("score", LongType())]))

    def best(df: DataFrame, *keys) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    spread = heaps.withColumn("class", F.pmod(F.xxhash64("doc_id"), F.lit(CLASSES)))
    return best(best(spread, "item_id", "class").drop("rank", "class"), "item_id") \
        .select("item_id", "rank", "doc_id", "score")
