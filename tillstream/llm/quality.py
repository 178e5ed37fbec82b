"""Quality rules: a hashed n-gram log-likelihood ratio decides, after plain counts.

Only DataFrame functions.  Words and pairs of words are hashed into buckets.  One pass
over all documents counts the buckets of the raw corpus and of the trusted documents; the
score of a document is the mean, over its n-grams, of log(trusted share / raw share).
Trusted shares are smoothed towards the raw ones and ratios are whole millionths, so sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.store import written

BUCKETS = 1 << 16
SENT = 1_000_000  # trusted ids that are sent to every task, at most; more meet their documents in a shuffle
KEEP_TRUSTED = 0.998  # share of the trusted documents that the threshold keeps
PRIOR = 1000  # n-grams of the raw corpus that the trusted counts are smoothed with
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _features(h: Column) -> Column:
    """Buckets of the words and pairs of neighbouring words, given the hashes of the words."""
    bucket = lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int")
    pairs = F.transform(h, lambda x, i: bucket(F.xxhash64(x, F.get(h, i + 1))))
    return F.concat(F.transform(h, bucket), F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of all good and not toxic documents."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return good.where("doc_id is not null and q = 1 and t = 0").select("doc_id")


def flagged(docs: DataFrame, trusted: DataFrame, sent: int = SENT) -> DataFrame:
    """docs with a column _t, 1 for trusted documents and else null."""
    marks = trusted.withColumn("_t", F.lit(1))
    return docs.join(F.broadcast(marks) if trusted.count() <= sent else marks.hint("merge"), "doc_id", "left")


def bucket_ratios(marked: DataFrame) -> DataFrame:
    """One row a bucket of flagged documents: bucket, ratio (millionths of log(trusted share / raw share))."""
    text = F.coalesce("text", F.lit(""))
    grams = marked.select(F.explode(_let(_hashes(_words(text)), _features)).alias("bucket"), "_t")
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_t").alias("good"))
    counts = written(counts, "buckets")  # at most BUCKETS rows
    totals = counts.agg(F.sum("raw").alias("raw_all"), F.sum("good").alias("good_all"))
    raw = F.col("raw") / F.col("raw_all")
    ratio = F.log((F.col("good") + PRIOR * raw) / (F.col("good_all") + PRIOR)) - F.log(raw)
    return counts.join(F.broadcast(totals), F.lit(True)).select(
        "bucket", F.when(F.col("good_all") > 0, F.round(ratio * 1_000_000)).otherwise(0).cast("int").alias("ratio")
    )


def _repeats(h: Column) -> Column:
    """Words that lie in a window of three words which the text has twice or more, given their hashes."""

    def marked(g: Column) -> Column:
        """g: hashes of windows.  Places of repeated ones, ascending, then the union of their words."""
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda k, j: F.get(s, k)["h"] == F.get(s, j)["h"]
            found = F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)), x["i"]),
                ),
                lambda i: i.isNotNull(),
            )
            return F.sort_array(found)

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda done, n: done + n)

        return _let(_let(pairs, places), covered)

    def counted(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(marked(g))

    each = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
    return _let(F.slice(each, 1, F.greatest(F.size(h) - 2, F.lit(0))), counted)


def _score(h: Column, ratios: Column) -> Column:
    """Mean ratio of a text's n-grams, given the hashes of its words; null without words."""

    def mean(buckets: Column) -> Column:
        total = F.aggregate(buckets, F.lit(0).cast("long"), lambda done, b: done + F.get(ratios, b))
        return F.when(F.size(buckets) > 0, total / F.size(buckets))

    return _let(_features(h), mean)


def low_quantile(values: DataFrame, share: float) -> float | None:
    """The quantile of a table of one column without nulls, interpolated; None without rows.

    Only the rows below it are gathered, so share should be small.
    """
    n = values.count()
    if not n:
        return None
    at = share * (n - 1)
    low = math.floor(at)
    near = [r[0] for r in values.orderBy(*values.columns).offset(low).limit(2).collect()]
    if len(near) == 1 or near[0] == near[1] or low == at:
        return near[0]
    return (low + 1 - at) * near[0] + (at - low) * near[1]


def rate(docs: DataFrame, labels: DataFrame, name: str = "rated", sent: int = SENT) -> DataFrame:
    """docs with a struct column `name` put last (it must be free):

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept.

    All good and not toxic documents are trusted; their ids are sent to every task if there
    are at most `sent`.  The threshold is the score that KEEP_TRUSTED of them reach; every
    document is held against it.  A text without words fails the base.  Without trusted
    documents the base alone decides.  A null text has no words.  Repeated rows get equal
    values; a null doc_id is never trusted; other columns are kept as they are.
    """
    marked = flagged(docs.select("doc_id", "text"), written(trusted_ids(labels), "trusted"), sent)
    ratios = bucket_ratios(marked)
    table = [0] * BUCKETS
    for bucket, ratio in ratios.collect():  # at most BUCKETS rows
        table[bucket] = ratio
    lookup = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")  # folded to one constant
    text = F.coalesce("text", F.lit(""))
    known = marked.where("_t = 1").select(_let(_hashes(_words(text)), lambda h: _score(h, lookup)).alias("score"))
    threshold = low_quantile(written(known.where("score is not null"), "scores"), 1 - KEEP_TRUSTED)

    lines = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))

    def count(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            _let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _let(_hashes(words), lambda h: F.struct(_repeats(h).alias("n"), _score(h, lookup).alias("s"))).alias("by_hash"),
        )

    def judged(c: Column) -> Column:
        repeated, score = c["by_hash"]["n"], c["by_hash"]["s"]
        failed = (c["n_words"] < 50) | (100 * repeated > 50 * c["n_words"])
        good = F.lit(True) if threshold is None else F.coalesce(score >= threshold, F.lit(False))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
        return F.struct(
            *[c[n].alias(n) for n in names], repeated.alias("n_repeat_words"), score.alias("score"),
            failed.alias("base_failed"), (~failed & good).alias("kept"),
        )

    return docs.select("*", _let(_let(_words(text), count), judged).alias(name))
