"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes long, trained
on the training documents.  A symbol is predicted by the longest context
that has seen it; a context that has not escapes to the next shorter one
with probability D / (N + D) (N counts, D distinct symbols), and symbols
that the longer context knows are excluded from the shorter one's
counts.  Below the empty context all symbols left are alike.  A text
begins after ``ORDER`` start signs and ends with an end sign, so the
probabilities of all texts add up to one; its score is the log10 of its
probability, the pretrained code length with the sign turned.

Beside it stands a word model with add-0.1 smoothing (``base_score``).

Scale: one pass counts words (as 64-bit hashes) and byte strings of
length ``ORDER`` + 1 per task, in numpy with bounded tables, and Spark
sums them.  The trie's probabilities are joins and sums over its arcs.
A second pass scores the texts.  The strings that occur most often, at
most ``MAX_ARCS``, are sent to every task with their probabilities; the
other strings of each document, of which there are few, are joined with
theirs.  Words that make up at least 1 / ``FREQUENT`` of all tokens, of
which there can be no more than ``FREQUENT``, are sent as well and the
other words joined, so no hot string or word enters a join.

Defined results: a NULL or empty text has one token, the end; a NULL id
counts as the empty text when documents are dealt out to training; with
no training documents no token is known, the word model is uniform and
the byte model too; repeated rows count each time; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

ORDER = 4
MAX_ARCS = 4_000_000
FREQUENT = 1 << 20
SMOOTH = 0.1
SYMBOLS = 255                     # every byte but the start sign; the end sign is one of them
START, END = 0xFF, 0xFE           # bytes that UTF-8 never uses
SLICE_BYTES = 4_000_000
TABLE_ROWS = 2_000_000
WORD, GRAM, DOCS = 0, 1, 2


def split_tokens(data: bytes) -> list[bytes]:
    return data.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 with seed 42, as Spark's xxhash64 gives it."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, 42) for w in words), dtype=np.uint64, count=len(words)).view(np.int64)


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings (context and symbol, packed) of all symbols of the texts in order,
    and where each text's begin."""
    pad, end = bytes([START]) * order, bytes([END])
    data = np.frombuffer(b"".join(pad + t.lower() + end for t in texts), dtype=np.uint8)
    kind = np.uint32 if order <= 3 else np.uint64
    packed = data.astype(kind)
    for back in range(1, order + 1):
        packed[back:] |= data[:-back].astype(kind) << kind(8 * back)
    packed = packed[data != START]
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return packed, np.concatenate([[0], np.cumsum(sizes)])[:-1]


class _Tally:
    """Sums by key in sorted arrays, handed out when they grow past ``TABLE_ROWS``."""

    def __init__(self, kind: int):
        self.kind = kind
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, keys: np.ndarray, trains: bool) -> None:
        if len(keys):
            found, n = np.unique(keys, return_counts=True)
            self.parts.append((found.astype(np.int64), n * trains, n))
            self.rows += len(found)

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts])
        found, where = np.unique(keys, return_inverse=True)
        sums = []
        for i in (1, 2):
            total = np.zeros(len(found), dtype=np.int64)
            np.add.at(total, where, np.concatenate([p[i] for p in self.parts]))
            sums.append(total)
        return found, *sums

    def settle(self) -> bool:
        """Fold the parts together; whether the table is still large."""
        if self.rows < TABLE_ROWS:
            return False
        self.parts = [self.merged()]
        self.rows = len(self.parts[0][0])
        return self.rows >= TABLE_ROWS // 2

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, trained, every = self.merged()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), self.kind, dtype=np.int32)), pa.array(keys),
                 pa.array(trained), pa.array(every)], names=["kind", "key", "trained", "every"])
        self.parts, self.rows = [], 0


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``SLICE_BYTES`` together (or one row)."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > SLICE_BYTES:
            yield begin, i
            begin, total = i, 0
        total += n
    if sizes:
        yield begin, len(sizes)


def _counter(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, strings, docs = _Tally(WORD), _Tally(GRAM), _Tally(DOCS)
        for batch in batches:
            texts, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                for trains in (True, False):
                    own = [texts[i] for i in range(a, b) if held[i] != trains]
                    if not own:
                        continue
                    strings.add(grams(own, order)[0], trains)
                    if trains:
                        every = [w for t in own for w in split_tokens(t)]
                        words.add(word_hashes(every), True)
                        docs.add(np.zeros(len(own), dtype=np.int64), True)
                for tally in (words, strings, docs):
                    if tally.settle():
                        yield from tally.take()
        for tally in (words, strings, docs):
            yield from tally.take()

    return run


def trie(strings: DataFrame, order: int) -> DataFrame:
    """``key``, ``log10`` of the probability of a packed string's symbol after its context.

    ``strings(key, n)``: every string that occurs, with its count in training (0 allowed).
    """
    symbol = F.col("key").bitwiseAND(F.lit(0xFF))
    context = lambda j: F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * j)) - 1))
    arcs, nodes = {}, {}
    seen = strings.filter("n > 0")
    for j in range(order, -1, -1):
        arcs[j] = seen.groupBy(context(j).cast("long").alias(f"c{j}"), symbol.alias("a")).agg(
            F.sum("n").alias(f"n{j}"))
        if j < order:            # from the next longer arcs: the same sums over fewer rows
            arcs[j] = arcs[j + 1].groupBy(
                F.col(f"c{j + 1}").bitwiseAND(F.lit((1 << (8 * j)) - 1)).alias(f"c{j}"), "a").agg(
                F.sum(f"n{j + 1}").alias(f"n{j}"))
        arcs[j] = materialise(arcs[j], f"arcs{j}")
        nodes[j] = arcs[j].groupBy(f"c{j}").agg(F.sum(f"n{j}").alias(f"total{j}"), F.count("*").alias(f"kinds{j}"))
    # what a shorter context has counted of the symbols that a longer one knows
    known = {}
    for j in range(order - 1, -1, -1):
        short = F.col(f"c{j + 1}").bitwiseAND(F.lit((1 << (8 * j)) - 1))
        known[j] = (arcs[j + 1].withColumn(f"c{j}", short).join(arcs[j], [f"c{j}", "a"])
                    .groupBy(f"c{j + 1}").agg(F.sum(f"n{j}").alias(f"known{j}")))

    table = strings.select("key", symbol.alias("a"),
                           *[context(j).cast("long").alias(f"c{j}") for j in range(order + 1)])
    for j in range(order, -1, -1):
        table = table.join(arcs[j], [f"c{j}", "a"], "left").join(nodes[j], f"c{j}", "left")
        if j < order:
            table = table.join(known[j], f"c{j + 1}", "left")
    table = table.fillna(0)
    left, chance = F.lit(1.0), F.lit(None).cast("double")
    for j in range(order, -1, -1):
        seen_n = F.col(f"total{j}") - (F.col(f"known{j}") if j < order else F.lit(0))
        kinds = F.col(f"kinds{j}") - (F.col(f"kinds{j + 1}") if j < order else F.lit(0))
        whole = (seen_n + kinds).cast("double")
        chance = F.coalesce(chance, F.when(F.col(f"n{j}") > 0, left * F.col(f"n{j}") / whole))
        left = left * F.when(kinds > 0, kinds / F.greatest(whole, F.lit(1.0))).otherwise(1.0)
    chance = F.coalesce(chance, left / (F.lit(SYMBOLS) - F.col("kinds0")))
    return table.select("key", F.log10(chance).alias("log10"))


def _scorer(order: int, frequent, model):
    """Per row: tokens, known frequent words and their sum, other words, sum over the
    frequent strings, other strings."""
    def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, keys[at] == wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, gain = frequent.value
        keys, logs = model.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                own = texts[a:b]
                words = [split_tokens(t) for t in own]
                counts = np.array([len(w) for w in words], dtype=np.int64)
                hashes = word_hashes([w for ws in words for w in ws])
                doc = np.repeat(np.arange(len(own)), counts)
                at, hit = found(common, hashes)
                n_common = np.bincount(doc[hit], minlength=len(own))
                total = np.bincount(doc[hit], weights=gain[at[hit]] if len(common) else None,
                                    minlength=len(own))
                others = hashes[~hit]
                n_others = np.concatenate([[0], np.cumsum(counts - n_common)]).astype(np.int32)
                packed, first = grams(own, order)
                at, hit = found(keys, packed)
                each = logs[at] if len(keys) else np.zeros(len(packed))
                each[~hit] = 0.0
                value = np.add.reduceat(each, first)
                strings = packed[~hit].astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.add.reduceat((~hit).astype(np.int64), first))]
                                         ).astype(np.int32)
                del packed, at, hit, each
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array(counts + 1), pa.array(n_common.astype(np.int64)),
                    pa.array(total.astype(np.float64)),
                    pa.ListArray.from_arrays(pa.array(n_others), pa.array(others)),
                    pa.array(value), pa.ListArray.from_arrays(pa.array(offsets), pa.array(strings))],
                    names=["doc_id", "held_out", "n_tokens", "n_common", "common_gain", "others",
                           "score", "strings"])

    return run


def held_out_flag(key: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0 by 10."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _frequent_from(strings: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` strings occur that often."""
    bits = F.length(F.bin("every")) - 1
    sizes = dict(strings.groupBy(bits.alias("bits")).count().collect())      # at most 64 rows
    held = 0
    for bit in range(63, -1, -1):
        held += sizes.get(bit, 0)
        if held > most:
            return 1 << (bit + 1)
    return 1


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          max_arcs: int = MAX_ARCS, frequent: int = FREQUENT) -> DataFrame:
    """Per row: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out_flag(F.col(id_col)).alias("held_out"),
        F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("text"))
    counted = rows.select("text", "held_out").mapInArrow(
        _counter(order), "kind int, key long, trained long, every long")
    counts = materialise(counted.groupBy("kind", "key").agg(
        F.sum("trained").alias("n"), F.sum("every").alias("every")), "counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    ends = counts.filter(F.col("kind") == DOCS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    distinct, total = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    train_tokens, kinds = total + ends, distinct + (1 if ends else 0)
    unit = train_tokens + SMOOTH * (kinds + 1)

    # at most ``frequent`` words can have so large a share of the tokens
    floor = max(1, -(-total // frequent))
    gain = F.log10((F.col("n") + SMOOTH) / SMOOTH)
    head = words.filter(F.col("n") >= floor).select("key", gain.alias("gain")).sort("key").toArrow()
    common = spark.sparkContext.broadcast((head["key"].to_numpy(), head["gain"].to_numpy()))

    strings = counts.filter(F.col("kind") == GRAM)
    model = materialise(trie(strings.select("key", "n"), order), "trie")
    often = _frequent_from(strings, max_arcs)
    table = (model.join(strings.filter(F.col("every") >= often).select("key"), "key", "left_semi")
             .sort("key").toArrow())
    arcs = spark.sparkContext.broadcast(
        (table["key"].to_numpy().astype(np.uint32 if order <= 3 else np.uint64), table["log10"].to_numpy()))

    scored = materialise(rows.mapInArrow(
        _scorer(order, common, arcs),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_common long, common_gain double, "
        "others array<long>, score double, strings array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = (scored.select("row", F.explode("others").alias("key"))
            .join(words.filter(F.col("n") < floor), "key")
            .groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(gain).alias("rare_gain")))
    rest = (scored.select("row", F.explode("strings").alias("key"))
            .join(model.join(strings.filter(F.col("every") < often).select("key"), "key", "left_semi"), "key")
            .groupBy("row").agg(F.sum("log10").alias("rest")))
    out = scored.drop("others", "strings").join(rare, "row", "left").join(rest, "row", "left")
    end_gain = float(np.log10((ends + SMOOTH) / SMOOTH)) if ends else 0.0
    return out.select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("n_tokens") * float(np.log10(SMOOTH / unit)) + F.col("common_gain")
         + F.coalesce("rare_gain", F.lit(0.0)) + end_gain).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))
