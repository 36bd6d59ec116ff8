"""Quality rules: surface counts and a hashed n-gram likelihood ratio.

The ratio compares two multinomials over ``buckets`` hashed word unigrams
and bigrams: the *target* (documents labelled good, at most ``TARGET_DOCS``
of them, drawn by hash) and the *raw* corpus (every document), both smoothed alike.  A document's verdict is
its log-likelihood ratio per n-gram against a fixed threshold, so the
same document under the same model always gets the same answer.

All work is DataFrame expressions.  Counting explodes n-gram buckets and
sums them with partial aggregation, so a task shuffles at most
``buckets`` rows however frequent an n-gram is; the model is ``buckets``
numbers whatever the size of the corpus and reaches the scoring pass as
a scalar subquery.  The ids of the target sample are broadcast (that many
at most).  Scoring is one scan without a shuffle.

Defined results: a NULL or blank text has no words, zero counts and
fails the base rules; with no labelled target the ratio is 0 for every
document and only the base rules decide; a repeated label counts once, a
repeated row each time; an empty table gives an empty result; other
columns are ignored (``filter_documents`` returns them untouched).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, materialise

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BUCKETS = 1 << 16
PSEUDO = 8.0
TARGET_DOCS = 50_000
THRESHOLD = -0.12


def _words(text: Column) -> Column:
    """The words of ``text`` in order; cheaper than matching each of them."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _bucket(h: Column, buckets: int) -> Column:
    """``h`` modulo ``buckets``, never negative."""
    low = h.bitwiseAND(F.lit(buckets - 1)) if not buckets & (buckets - 1) else F.pmod(h, F.lit(buckets))
    return low.cast("int")


def _pairs(hashes: Column) -> Column:
    """Hash of every word and its next one, from word hashes.

    ``let``: a filter that the optimizer pushes down would else compute the hashes for each element.
    """
    return let(hashes, lambda h: F.transform(
        F.slice(h, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0))),
        lambda a, i: F.xxhash64(a, F.get(h, i + 1))))


def _repeated_words(hashes: Column, pairs: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash (of their first pair and last word);
    sorting (hash, position) puts equal windows side by side.
    """
    windows = let(hashes, lambda h: F.transform(
        F.slice(pairs, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0))),
        lambda ab, i: F.xxhash64(ab, F.get(h, i + 2))))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        hits = let(placed, lambda p: F.filter(
            F.zip_with(p, F.slice(p, F.lit(2), F.size(p)),        # the next in order, NULL at the end
                       lambda x, y: F.struct(x["w"].alias("w"), x["i"].alias("i"),
                                             y["w"].alias("nw"), y["i"].alias("ni"))),
            lambda e: e["w"] == e["nw"]))
        return F.size(F.array_distinct(F.flatten(F.transform(hits, lambda e: F.array(
            e["i"], e["i"] + 1, e["i"] + 2, e["ni"], e["ni"] + 1, e["ni"] + 2)))))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0))
               .otherwise(covered(w)))


def _duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line; most texts have no equal lines at all."""
    worded = lambda lines: F.filter(lines, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    surplus = lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
    return let(F.array_remove(F.split(text, "\n", -1), ""), lambda lines: F.when(
        surplus(lines) == 0, F.lit(0)).otherwise(let(worded(lines), surplus)))


def target_sample(good_ids: DataFrame, most: int = TARGET_DOCS) -> DataFrame:
    """At most ``most`` of the good ids (column ``id``), drawn by their hashes alone.

    Of many more ids a class of hashes, sized for a fifth more than ``most``, is looked
    at first; of those the least hashes are taken."""
    ids = good_ids.select(F.col(good_ids.columns[0]).alias("id")).filter("id is not null").distinct()
    total = ids.count()
    place = F.xxhash64("id")
    if total > most:          # first thin out, so that the sort sees little more than it returns
        share = int(min(1.0, 1.2 * most / total) * (1 << 20))
        ids = ids.filter(F.pmod(place, F.lit(1 << 20)) < share)
    return ids.orderBy(place, "id").limit(most)


def ratio_model(corpus: DataFrame, good_ids: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", buckets: int = BUCKETS,
                pseudo: float = PSEUDO, target_docs: int = TARGET_DOCS) -> DataFrame:
    """One row, ``weights``: log target over raw probability of each bucket.

    Raw counts are scaled to the size of the target and both sides get
    ``pseudo`` extra counts, so a bucket seen a few times says little.

    ``good_ids(id)`` names the good documents.  Raw counts cover every
    document of ``corpus``, target counts at most ``target_docs`` good ones.
    """
    good = F.broadcast(target_sample(good_ids, target_docs)).withColumn("good", F.lit(1))
    flagged = corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(good, "id", "left")
    # each word as a row, so that hashing and counting are compiled code; posexplode_outer: posexplode
    # would add a filter that cuts the texts a second time
    placed = flagged.select("good", _words(F.col("text")).alias("words")) \
        .select("good", "words", F.posexplode_outer("words").alias("at", "word"))
    following = F.get("words", F.col("at") + 1)
    grams = F.array(
        F.when(F.col("word").isNotNull(), _bucket(F.xxhash64("word"), buckets)),
        F.when(following.isNotNull(), _bucket(F.xxhash64(F.xxhash64("word"), F.xxhash64(following)), buckets)))
    counts = (placed.select("good", F.explode_outer(grams).alias("bucket")).filter("bucket IS NOT NULL")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("target")))
    table = (corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(counts, "bucket", "left")
             .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"),
                     F.coalesce("target", F.lit(0)).alias("target")))
    dense = table.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("cells"),
                      F.sum("raw").alias("raw_total"), F.sum("target").alias("target_total"))
    share = F.col("target_total") / F.col("raw_total")
    weight = lambda c: F.when(F.col("target_total") == 0, F.lit(0.0)).otherwise(
        F.log((c["target"] + pseudo) / (c["raw"] * share + pseudo)))
    return materialise(dense.select(F.transform("cells", weight).alias("weights")), "ratio")


def _score(hashes: Column, pairs: Column, weights: Column, buckets: int) -> Column:
    """Mean weight of the text's n-grams; 0 for a text without words."""
    total = lambda begin, grams: F.aggregate(
        grams, begin, lambda acc, h: acc + F.get(weights, _bucket(h, buckets)))
    n = F.size(hashes)
    return F.when(n == 0, F.lit(0.0)).otherwise(
        (total(F.lit(0.0), hashes) + total(F.lit(0.0), pairs)) / (2 * n - 1))


def measured(docs: DataFrame, model: DataFrame, text_col: str = "text",
             threshold: float = THRESHOLD, buckets: int = BUCKETS,
             prefix: str = "") -> DataFrame:
    """``docs`` with the counts, ``ratio``, ``base_failed`` and ``kept`` (names under ``prefix``)."""
    p = prefix
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = "__quality_work_"
    out = (docs.withColumn(f"{own}words", _words(F.col(text_col)))
           .withColumn(f"{own}hashes", _hashes(F.col(f"{own}words")))
           .withColumn(f"{own}pairs", _pairs(F.col(f"{own}hashes"))))
    words, hashes, pairs = (F.col(f"{own}{c}") for c in ("words", "hashes", "pairs"))
    out = out.withColumns({
        f"{p}n_words": F.size(words).cast("long"),
        f"{p}word_chars": F.length(F.array_join(words, "")).cast("long"),
        f"{p}n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        f"{p}n_dup_lines": _duplicate_lines(text).cast("long"),
        f"{p}n_repeat_words": _repeated_words(hashes, pairs).cast("long")}).drop(f"{own}words")
    # a subquery may not stand inside a higher-order function; as a column of its
    # own, used once, the optimizer folds it into the expression that reads it
    out = (out.withColumn(f"{own}weights", model.select("weights").scalar())
           .withColumn(f"{p}ratio", _score(hashes, pairs, F.col(f"{own}weights"), buckets))
           .drop(*[f"{own}{c}" for c in ("hashes", "pairs", "weights")]))
    failed = (F.col(f"{p}n_words") < MIN_WORDS) | \
        (100 * F.col(f"{p}n_repeat_words") > 50 * F.col(f"{p}n_words"))
    return (out.withColumn(f"{p}base_failed", failed)
            .withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & (F.col(f"{p}ratio") >= threshold)))


def filter_documents(docs: DataFrame, good_ids: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    model = ratio_model(docs, good_ids, id_col, text_col)
    tag = "__quality_"
    out = measured(docs, model, text_col, threshold, prefix=tag)
    # the verdict passes through a generator of one row, below which the optimizer pushes no
    # filter: the filter reads the verdict instead of computing all measures again
    return out.withColumn(f"{tag}verdict", F.explode_outer(F.array(f"{tag}kept"))) \
        .filter(F.col(f"{tag}verdict")).select(docs.columns)
