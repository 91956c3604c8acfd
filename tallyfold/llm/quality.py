"""Quality rules: base counts, and a log-likelihood ratio of hashed n-grams.

Method: words and word pairs are hashed into buckets. Two multinomials over the buckets are
counted, one over all documents and one over all trusted ones. A document's score is the mean,
over its n-grams, of the logarithm of how much likelier the bucket is in trusted text. A
document under the threshold is rejected.

All of it is built of Spark's own functions. The corpus is only counted, into as many rows
as there are buckets, and a document is scored where it is read, without a shuffle.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import cut, words_of

BUCKETS = 1 << 15
#: Ids of trusted documents that are sent to all tasks; more of them are joined by a shuffle of the texts.
BROADCAST_IDS = 1_000_000
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often `body` uses it.

    A plain column would not do inside the functions of array elements: when Spark moves a
    filter or merges projections, it puts the column's expression in its place there.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of words that the text has twice or more."""

    def hashes(w):
        # Each word is hashed once, not once for each window that it is in.
        places = F.sequence(F.lit(0), F.size(w) - window)
        windows = lambda h: F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
        return F.when(F.size(w) > window, let(F.transform(w, lambda x: F.xxhash64(x)), windows))

    def covered(found):
        # Sorted with their places, equal windows are neighbours.
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(p):
            same = lambda k, j: F.get(p, k)["h"].eqNullSafe(F.get(p, j)["h"])
            twice = F.filter(p, lambda x, k: same(k, k + 1) | ((k > 0) & same(k, k - 1)))
            starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
            nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
            step = lambda a, s: F.struct((a["n"] + s + window - F.greatest(a["stop"], s)).alias("n"), (s + window).alias("stop"))
            return F.aggregate(starts, nothing, step, lambda a: a["n"])

        return let(pairs, count)

    some = let(let(words, hashes), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)))
    return F.coalesce(some, F.lit(0)).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """The documents with their words (`_words`), the counts of the base rules, and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.col("_words")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counted = docs.withColumn("_words", words_of(F.col("text"))).withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(words),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def buckets(words: Column, count: int = BUCKETS) -> Column:
    """The buckets of all words and of all pairs of neighbouring words."""
    place = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(count)).cast("int")

    def both(w):
        size = F.size(w)
        pairs = F.zip_with(F.slice(w, 1, F.greatest(size - 1, F.lit(0))), F.slice(w, 2, size), lambda a, b: place(a, b))
        return F.concat(F.transform(w, lambda x: place(x)), pairs)

    return let(words, both)


@dataclass
class Model:
    """Log ratios of the buckets, and the least score that is kept."""

    ratios: list[float]
    threshold: float

    def score(self, words: Column) -> Column:
        """The mean log ratio of the n-grams; 0 without any."""
        # One literal that Spark folds, instead of a literal for each bucket.
        text = ",".join(f"{r:.4g}" for r in self.ratios)
        ratios = F.split(F.lit(text), ",").cast("array<double>")
        total = lambda g: F.aggregate(g, F.lit(0.0), lambda a, k: a + F.get(ratios, k)) / F.greatest(F.size(g), F.lit(1))
        return F.coalesce(let(buckets(words, len(self.ratios)), total), F.lit(0.0))


def _half(doc_id: Column) -> Column:
    """The half of the labelled documents: 0 is for the trusted counts, 1 for the threshold."""
    return F.pmod(F.xxhash64(doc_id, F.lit(1)), F.lit(2))


def _counts(docs: DataFrame, labels: DataFrame, count: int) -> tuple[list[int], list[int]]:
    """N-grams of each bucket in all documents and in the trusted ones, counted in one pass.

    One row for each bucket reaches the driver, whatever the data.
    """
    trusted = labels.where((F.col("quality") == 1) & (_half(F.col("doc_id")) == 0)).select("doc_id", F.lit(1).alias("trusted")).distinct()
    if trusted.count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    grams = marked.select("trusted", F.explode(buckets(words_of(F.col("text")), count)).alias("bucket"))
    found = {r.bucket: (r.n, r.good) for r in grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count("trusted").alias("good")).collect()}
    nothing = 0, 0
    return [found.get(k, nothing)[0] for k in range(count)], [found.get(k, nothing)[1] for k in range(count)]


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, quality) of all documents for the threshold; one with both labels counts for each."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (_half(F.col("doc_id")) == 1))
    known = known.select("doc_id", "quality").distinct()
    if known.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", "quality")


def _best_cut(scores: DataFrame) -> float:
    """The score that separates best: fewest errors as shares of their label; of equals the lowest.

    `scores` has (quality, score). Equal scores are counted together, and ranges of scores are
    added up side by side, so neither a task nor the driver gets them all.
    """
    counted = scores.groupBy("score").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    ranged = cut(counted.repartitionByRange("score").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("part").collect()
    all_good, all_bad = sum(r.good for r in parts), sum(r.bad for r in parts)
    if not all_good or not all_bad:
        return -math.inf
    before, good, bad = [], 0, 0
    for r in parts:
        before.append((r.part, good, bad))
        good, bad = good + r.good, bad + r.bad
    offsets = F.broadcast(scores.sparkSession.createDataFrame(before, "part int, good_before long, bad_before long"))
    own = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = lambda name: F.col(f"{name}_before") + F.coalesce(F.sum(name).over(own), F.lit(0))
    lost = below("good") / F.lit(all_good) + 1 - below("bad") / F.lit(all_bad)
    best = ranged.join(offsets, "part").select("score", lost.alias("lost")).orderBy("lost", "score").first().score
    under = ranged.where((F.col("bad") > 0) & (F.col("score") < best)).agg(F.max("score")).first()[0]
    return best if under is None else (best + under) / 2


def fit(docs: DataFrame, labels: DataFrame, count: int = BUCKETS) -> Model:
    """Counts over all documents and over all trusted ones, and a threshold from all that are kept for it.

    Trusted documents are those of quality 1 in one half of the labelled ones, by a hash of
    their id. The threshold is the score that best tells documents of quality 1 from those of
    quality 0 among all those of the other half that pass the base rules: a score learned from a
    document would flatter it. Without documents of both labels, nothing is rejected by score.
    """
    corpus, trusted = _counts(docs, labels, count)
    share = lambda c, total: [math.log((n + 1) / (total + count)) for n in c]
    ratios = [t - c for t, c in zip(share(trusted, sum(trusted)), share(corpus, sum(corpus)), strict=True)] if any(trusted) else [0.0] * count
    model = Model(ratios, -math.inf)
    # Behind a generator, or Spark would move the filter on the counts of a text below the join.
    score = F.when(~F.col("base_failed"), model.score(F.col("_words")))
    judged = base_counts(_labelled(docs, labels)).select("quality", F.explode(F.array(score)).alias("score"))
    model.threshold = _best_cut(judged.where("score IS NOT NULL"))
    return model


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with the base counts, base_failed, quality_score and kept.

    A null text counts as empty: no words, so base_failed and not kept. Whole texts are
    counted. Rows are judged one by one, so repeated rows and null ids are no special case;
    an empty table gives an empty result. A column of `docs` that has the name of one of
    these is replaced.
    """
    counted = base_counts(docs).withColumn("quality_score", model.score(F.col("_words")))
    kept = ~F.col("base_failed") & (F.col("quality_score") >= F.lit(model.threshold))
    return counted.withColumn("kept", kept).drop("_words")


def kept_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are kept, with all their columns as they are, whatever their names."""
    return judge(docs.select("text", F.struct("*").alias("_document")), model).where("kept").select("_document.*")
