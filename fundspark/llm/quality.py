"""Quality rules: base counts, and a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into ``BUCKETS`` counters. One multinomial comes from the trusted
documents (every row labelled 1), one from all documents. A document's score is the mean over its
n-grams of log(p_trusted / p_all). Documents that were counted as trusted score higher than others like
them, the more so the smaller the corpus, so the threshold takes each trusted row by the score that it
has where its own fold of the trusted rows is not counted (``FOLDS`` of them, by the hash of the key):
between these scores of all trusted rows and the scores of all rejected rows, where the rates kept of the
two differ most; without rejected rows it is the lowest of the trusted ones. So every labelled row counts
and every labelled row decides. The trusted rows of the first fold have that score in the result as well,
so that rates kept can be read off rows whose label is not in their score. All of it is DataFrame
expressions: one aggregation to ``BUCKETS`` rows, which stay in the shared folder, then the n-grams of
every document looked up once in the broadcast counters; the scores stay in the shared folder, and the
threshold is read off them by sums over ranges of the score. Counters and one row of figures per document
are shuffled; the texts are only where more than ``BROADCAST_KEYS`` trusted keys have to find theirs.

Defined results: a null text counts as empty; an empty text fails the base rule (no words) and has
score 0; repeated rows get equal results; an empty table gives an empty table. Without trusted rows
every ratio is 0 and only the base rule decides, as it does where all trusted rows are of one fold. Only
the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_small
from .shared import materialise, ranked

BUCKETS = 131072  # power of two, independent of the data: the bound of the broadcast table
FOLDS = 5  # a trusted row is weighed by the counts of the other folds
BROADCAST_KEYS = 200_000  # trusted keys beyond this meet the documents in a shuffle
PLACES = 64  # documents without a key are dealt over these in that shuffle
CHUNKS = 10_000  # ranges of the score per unit: of scores of nine digits, at most 100,000 in each
WINDOW = 8
BREAKS = "[ \\t\\n\\u000B\\f\\r]+"


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), BREAKS), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def paired(hashes: Column, step: int) -> Column:
    """Hash of each entry with the one ``step`` places on (alone where there is none)."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def ngram_buckets(words: Column, pairs: Column) -> Column:
    """One counter per word and one per word with its successor (or the end of the text)."""
    mask = F.lit(BUCKETS - 1).cast("long")
    return F.transform(F.concat(words, pairs), lambda h: h.bitwiseAND(mask).cast("int"))


def base_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, ``_words`` and ``_pairs`` (hashes) and the base counts of every row.

    Each step is a projection of its own, so that an array several expressions use is computed once.
    """
    body = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(body, "\\n"), lambda x: F.rlike(x, F.lit("[^ \\t\\n\\u000B\\f\\r]")))
    one = docs.select(F.col(key), F.col(text).alias("_text"), word_hashes(F.col(text)).alias("_words"))
    two = one.select(
        key, "_words", paired(F.col("_words"), 1).alias("_pairs"), lines.alias("_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(body, " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    kept = [key, "_words", "_pairs", "n_words", "word_chars", "n_symbols"]
    duplicates = (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines")
    three = two.select(*kept, duplicates, paired(F.col("_pairs"), 2).alias("_four"))
    kept.append("n_dup_lines")
    # The hash of a window of eight words is that of its two halves; the last seven starts have none.
    whole = F.size("_words") - (WINDOW - 1)
    windows = F.when(whole > 0, F.slice(paired(F.col("_four"), 4), 1, whole)).otherwise(F.array().cast("array<bigint>"))
    four = three.select(*kept, windows.alias("_windows"))
    # Only a text with a repeated window sorts its windows; neighbours of equal value are repeats.
    by_value = F.array_sort(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    five = four.select(*kept, F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), by_value).alias("_sorted"))
    at = lambda i: F.get(F.col("_sorted"), i)["h"]
    again = lambda x, i: (F.coalesce(x["h"] == at(i + 1), F.lit(False))) | F.coalesce(x["h"] == at(i - 1), F.lit(False))
    places = F.array_sort(F.transform(F.filter(F.col("_sorted"), again), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum"), i.alias("last")),
        lambda acc: acc["sum"],
    )
    return five.select(*kept, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def keys_of(rows: DataFrame, key: str) -> DataFrame:
    """``_key`` of all rows that have one, each key once."""
    return rows.select(F.col(key).alias("_key")).where("_key is not null").distinct()


def fold_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("fold")), F.lit(FOLDS)).cast("int")


def held_out() -> Column:
    return fold_of(F.col("_key")) == 0


def with_trust(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` and ``_trusted``, whether their ``_key`` is one of ``keys``."""
    known = keys.withColumns({"_trusted": F.lit(True), "_place": F.lit(0)})
    place = F.when(F.col("_key").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(PLACES)).cast("int")).otherwise(0)
    met = rows.withColumn("_place", place).join(broadcast_if_small(known, BROADCAST_KEYS), ["_key", "_place"], "left")
    return met.select(*rows.columns, F.coalesce("_trusted", F.lit(False)).alias("_trusted"))


def ratio_table(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(b, ratio, others)``: log(p_trusted / p_all) of every counter that occurs, at most ``BUCKETS``
    rows in the shared folder; both are smoothed by one count per ``BUCKETS``. ``trusted`` has the keys
    (``_key``) of the trusted rows; all of them count. ``others`` has the ratio without each fold of the
    trusted rows, null where no trusted row is left."""
    rows = with_trust(docs.select(F.col(key).alias("_key"), F.col(text).alias("_body")), trusted)
    # The words are a projection of their own, so that they are computed once.
    fold = F.when(F.col("_trusted"), fold_of(F.col("_key"))).alias("_fold")
    rows = rows.select(word_hashes(F.col("_body")).alias("_words"), fold)
    rows = rows.select(ngram_buckets(F.col("_words"), paired(F.col("_words"), 1)).alias("_b"), "_fold")
    folds = [f"t{k}" for k in range(FOLDS)]
    counts = (
        # The outer form: for the plain one the optimiser would compute the arrays in a filter as well.
        rows.select(F.explode_outer("_b").alias("b"), "_fold")
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("_fold") == k, 1)).alias(t) for k, t in enumerate(folds)])
    )
    counts = materialise(counts.where("b is not null"), "counters")
    every, *hits = (x or 0 for x in counts.agg(F.sum("n"), *[F.sum(t) for t in folds]).first())
    if not sum(hits):
        nothing = F.array_repeat(F.lit(None).cast("double"), FOLDS)
        return counts.select("b", F.lit(0.0).alias("ratio"), nothing.alias("others"))
    share = (F.col("n") + 1) / F.lit(float(every + BUCKETS))

    def ratio(parts: list[int]) -> Column:
        # The trusted counts are smoothed towards the corpus, so that a rare counter has a ratio near 0.
        of = sum(hits[k] for k in parts)
        if not of:
            return F.lit(None).cast("double")
        t, prior = sum((F.col(folds[k]) for k in parts), F.lit(0)), 0.1 * of
        return F.round(F.log((t + prior * share) / (of + prior) / share), 6)

    others = F.array(*[ratio([i for i in range(FOLDS) if i != k]) for k in range(FOLDS)])
    return counts.select("b", ratio([*range(FOLDS)]).alias("ratio"), others.alias("others"))


def log_ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """The ratios of all counters as a list, those that do not occur with ratio 0."""
    found = ratio_table(docs, keys_of(trusted, key), key, text).select("b", "ratio").toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS)
    out[found.column("b").to_numpy()] = found.column("ratio").to_numpy()
    return out.tolist()


def best_threshold(good: list[float], bad: list[float]) -> float:
    """The score from which rows are kept: in the middle of the gap, between neighbouring scores, that
    separates the two labels best (the lowest of equals). For lists; ``best_cut`` is the same on rows."""
    if not good:
        return float("-inf")
    if not bad:
        return min(good)
    good_scores, bad_scores = np.sort(good), np.sort(bad)
    cuts = np.unique([*good, *bad])
    kept = lambda x: 1 - np.searchsorted(x, cuts, side="left") / len(x)
    best = int(np.argmax(np.round(kept(good_scores) - kept(bad_scores), 12)))
    return float(cuts[best] if best == 0 else (cuts[best - 1] + cuts[best]) / 2)


def best_cut(scores: DataFrame) -> float:
    """``best_threshold`` of the rows ``(score, _good)``, 1 for a trusted and 0 for a rejected one. Equal
    scores become one row; the sums below each come from ranges of the score, none held by one task."""
    cuts = scores.groupBy("score").agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad"))
    cuts = materialise(cuts, "cuts")
    good, bad, least = cuts.agg(F.sum("good"), F.sum("bad"), F.min(F.when(F.col("good") > 0, F.col("score")))).first()
    if not good:
        return float("-inf")
    if not bad:
        return least
    # The difference of the rates kept, times both counts: a sum over the cuts below, in whole numbers.
    gain = F.col("bad") * F.lit(good) - F.col("good") * F.lit(bad)
    placed = ranked(cuts, [], ["score"], gain, chunk=F.floor(F.col("score") * CHUNKS))
    best = placed.orderBy(F.col("_before").desc(), "score").first()["score"]
    below = cuts.where(F.col("score") < best).agg(F.max("score")).first()[0]
    return best if below is None else (below + best) / 2


def threshold_of(scored: DataFrame, trusted: DataFrame, rejected: DataFrame | None, key: str = "doc_id") -> float:
    """The threshold that all trusted rows and all rejected rows give, of those that pass the base rule.
    ``scored`` has ``_key``, base_failed and ``_apart``, null where nothing is known of the row; a
    repeated key counts by its lowest score. ``trusted`` has the keys (``_key``) of the trusted rows."""
    labelled = trusted.select("_key", F.lit(1).alias("_good"))
    if rejected is not None:
        labelled = labelled.unionByName(keys_of(rejected, key).withColumn("_good", F.lit(0)))
    known = scored.where(~F.col("base_failed") & F.col("_apart").isNotNull())
    lowest = known.groupBy("_key").agg(F.min("_apart").alias("score"))
    return best_cut(lowest.join(labelled, "_key"))


def judge(docs: DataFrame, ratios: DataFrame, key: str = "doc_id", text: str = "text", label_key: str | None = None) -> DataFrame:
    """Key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, and
    ``_others``: the score without the fold of ``label_key`` (``key`` if not given), or null.

    The n-grams of a row become rows for the lookup and are summed again in the task that made them;
    one row per document is shuffled. A counter that ``ratios`` lacks has ratio 0.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = base_counts(docs, key, text).withColumn("_at", F.monotonically_increasing_id())
    base = base.withColumn("_fold", fold_of(F.col(label_key or key)))
    grams = base.select("_at", key, "_fold", *counts, F.explode_outer(F.concat("_words", "_pairs")).alias("_h"))
    table = ratios.select(F.col("b").alias("_b"), F.col("ratio").alias("_ratio"), F.col("others").alias("_others"))
    table = F.broadcast(table)  # at most BUCKETS rows
    met = grams.withColumn("_b", F.col("_h").bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")).join(table, "_b", "left")
    sums = [F.sum("_ratio").alias("_sum"), F.sum(F.get("_others", "_fold")).alias("_rest"), F.count("_h").alias("_n")]
    summed = met.groupBy("_at", key, *counts).agg(*sums)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    score = F.coalesce(F.round(F.try_divide(F.coalesce("_sum", F.lit(0.0)), F.col("_n")), 9), F.lit(0.0))
    others = F.round(F.try_divide(F.col("_rest"), F.col("_n")), 9)
    return summed.select(key, *counts, failed.alias("base_failed"), score.alias("score"), others.alias("_others"))


def unbiased(judged: DataFrame, trusted: DataFrame) -> DataFrame:
    """``judged`` with ``_apart``, the score by the labels of other rows, for ``_others``: the score itself
    of a row that is not trusted. The trusted rows of the first fold have it as their score."""
    rows = with_trust(judged, trusted)
    score = F.when(F.col("_trusted") & held_out(), F.coalesce("_others", F.lit(0.0))).otherwise(F.col("score"))
    apart = F.when(F.col("_trusted"), F.col("_others")).otherwise(F.col("score"))
    return rows.withColumns({"score": score, "_apart": apart}).drop("_others", "_trusted")


def passes(threshold: float) -> Column:
    return ~F.col("base_failed") & (F.col("score") >= threshold)


def quality_rules(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", rejected: DataFrame | None = None
) -> DataFrame:
    """What ``judge`` finds of every row, and ``kept``."""
    keys = materialise(keys_of(trusted, key), "trusted")
    judged = judge(docs, ratio_table(docs, keys, key, text), key, text).withColumn("_key", F.col(key))
    scored = materialise(unbiased(judged, keys), "scores")
    threshold = threshold_of(scored, keys, rejected, key)
    return scored.drop("_key", "_apart").withColumn("kept", passes(threshold))


def keep_good(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", rejected: DataFrame | None = None
) -> DataFrame:
    """The rows of ``docs`` that are kept, with exactly the columns of ``docs``. Rows are told apart by
    two hashes of key and text; the hashes of the rejected ones are written first, so that the planner
    knows their size and moves the texts only if they are many."""
    keys = materialise(keys_of(trusted, key), "trusted")
    row = F.struct(F.xxhash64(key, text).alias("a"), F.xxhash64(text, key).alias("b"))
    named = docs.select(F.struct(F.col(key).alias("key"), row.alias("row")).alias("_id"), F.col(text).alias("_body"))
    judged = judge(named, ratio_table(docs, keys, key, text), "_id", "_body", label_key="_id.key")
    judged = judged.select(F.col("_id.key").alias("_key"), F.col("_id.row").alias("_row"), "base_failed", "score", "_others")
    scored = materialise(unbiased(judged, keys), "scores")
    threshold = threshold_of(scored, keys, rejected, key)
    gone = materialise(scored.where(~passes(threshold)).select("_row").distinct(), "rejected")
    return docs.join(gone, row == gone["_row"], "left_anti")
