"""Quality rules: hashed n-gram log-likelihood ratio (operator 5).

Two multinomials over ``BUCKETS`` hash buckets of word 1- and 2-grams are
compared: the trusted target (labelled good rows) and the raw corpus (all
rows). A text's score is the mean over its n-grams of log(p_target / p_raw);
a text is kept when it passes the base rules and its score reaches one
threshold that is set from held-out labelled rows.

Toxic rows are judged by the same buckets, as a mean over a whole text hides
few words: buckets of the words and of their first ``PREFIX`` bytes (which
inflected words share), and the multinomial of the rows labelled toxic against
that of all rows, each row counting a bucket once. A bucket is evidence when at
least ``TOXIC_ROWS`` and a share of the toxic rows hold it and it is e times as
frequent there, so that chance finds weigh nothing. A text's toxic score is the
largest mean log ratio over ``WINDOW`` words in a row, with a threshold of its
own; a text above it is not kept.

All labelled rows take part: of their ranks by a hash of doc_id a third fits the
target and the toxic evidence, a third sets the thresholds, and a third is left
for judging them. They stay in tables; the thresholds come from running counts over sorted
scores. The raw counts and the scores cover every row and whole texts.
The model is three arrays of BUCKETS doubles (1.5 MB), whatever the corpus size.

Words are compared by 64-bit codes; the counts of repeated windows compare
codes within one text. Texts are worked on a few megabytes at a time.

Defined cases: a null or empty text has no words and fails the base rule; a
null doc_id is scored like any other; repeated rows count as often as they
occur and each is returned; with no labelled good row, or none to set the
threshold, the base rules alone decide; with no toxic row in either third no
text counts as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import map_batches, small_side
from tessera.llm.words import Words, all_codes, all_prefixes
from tessera.operators.numbering import numbered
from tessera.session import Scratch
from tessera.sources.local import literal_table

BUCKETS = 1 << 16
SMALL_ROWS = 1_000_000  # labelled rows that may be broadcast (id and flags)
MIN_WORDS = 50
KEEP_OF_TRUSTED = 0.995
PRIOR = BUCKETS // 8  # n-grams that the raw shares count as in the target
WINDOW, PREFIX = 100, 5  # words, bytes
TOXIC_SHARE, TOXIC_ROWS, TOXIC_RATIO = 0.03, 3, 1.0  # rows that hold a bucket of evidence, and its log ratio, at least
SLICE = 4 << 20  # bytes of rows held as Python values at a time
SYMBOLS = "#*$%&|<>"
COUNTS = ("raw", "target", "raw_rows", "toxic_rows")
METRICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, toxic_score double"

def ngram_buckets(codes: np.ndarray) -> np.ndarray:
    """Buckets of all 1-grams, then of all 2-grams."""
    mix, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(48)
    pairs = (codes[:-1] * mix + codes[1:]) * mix
    return np.concatenate([(codes * mix) >> shift, pairs >> shift]).astype(np.int64)


def base_metrics(text: str, codes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if len(codes) > 3:
        # numbered in three steps, so that windows are compared whole
        at = np.unique(codes, return_inverse=True)[1]
        pair = np.unique(at[:-1] * len(codes) + at[1:], return_inverse=True)[1]
        _, which, times = np.unique(pair[:-1] * len(codes) + at[2:], return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[which] > 1)
        hit = np.zeros(len(codes), bool)
        for k in range(3):
            hit[again + k] = True
        repeated = int(hit.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def word_buckets(text: str | None, codes: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each word's bucket, and that of its first bytes, which lie above."""
    found = all_prefixes(text, words, PREFIX)
    return ngram_buckets(codes)[: len(codes)], ngram_buckets(found)[: len(found)] + BUCKETS


def toxic_score(each: np.ndarray) -> float:
    """The largest mean of the words' values over WINDOW words in a row (over
    all words of a shorter text, and as many zeros as it lacks)."""
    if not each.any():
        return 0.0
    sums = np.concatenate([[0.0], np.cumsum(each)])
    width = min(WINDOW, len(each))
    return float((sums[width:] - sums[:-width]).max() / WINDOW)


@dataclass
class Model:
    """Log ratios of the target and of toxic evidence, with their cuts."""
    ratios: np.ndarray
    odds: np.ndarray
    least: float = -np.inf   # score
    most: float = np.inf     # toxic score

    def scores(self, text: str | None, codes: np.ndarray, words: Words) -> tuple[float, float]:
        if not len(codes):
            return 0.0, 0.0
        one, start = word_buckets(text, codes, words)
        return float(self.ratios[ngram_buckets(codes)].mean()), toxic_score(self.odds[one] + self.odds[start])

    def keeps(self, text: str | None, words: Words) -> bool:
        codes = all_codes(text, words)
        if base_failed(len(codes), base_metrics(text or "", codes)[3]):
            return False
        score, toxic = self.scores(text, codes, words)
        return score >= self.least and toxic <= self.most


def corpus_counts(docs: DataFrame, trusted: Column | set[int], toxic: Column | set[int]) -> DataFrame:
    """(bucket, raw, target, raw_rows, toxic_rows): n-gram counts over every
    row and over the rows that are ``trusted`` (a condition, or ids), and the
    numbers of all rows and of the ``toxic`` ones that hold a word's bucket or its
    beginning's. One dense vector each a task is combined before the shuffle."""
    marks = [which if isinstance(which, Column) else F.col("doc_id").isin(*which) for which in (trusted, toxic)]

    def count(batches):
        words = Words()
        total = np.zeros((4, 2 * BUCKETS), np.int64)
        for batch in batches:
            for text, trusted, toxic in zip(batch.text, batch.trusted, batch.toxic):
                codes = all_codes(text, words)
                if not len(codes):
                    continue
                grams, held = ngram_buckets(codes), np.unique(np.concatenate(word_buckets(text, codes, words)))
                np.add.at(total[0], grams, 1)
                total[2][held] += 1
                if trusted:
                    np.add.at(total[1], grams, 1)
                if toxic:
                    total[3][held] += 1
        used = np.flatnonzero(total.any(axis=0))
        yield dict(zip(("bucket", *COUNTS), (used, *total[:, used])))

    marked = docs.select("text", *[F.coalesce(m, F.lit(False)).alias(n) for m, n in zip(marks, ("trusted", "toxic"))])
    parts = map_batches(marked, count, "bucket long, " + ", ".join(f"{c} long" for c in COUNTS), SLICE)
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in COUNTS])


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    q = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target + PRIOR * q) / (target.sum() + PRIOR) / q)


def toxic_odds(raw_rows: np.ndarray, toxic_rows: np.ndarray, toxic: int) -> np.ndarray:
    """Log ratios of the buckets that are evidence, 0 for the others."""
    out = np.zeros(2 * BUCKETS)
    held = toxic_rows >= max(TOXIC_ROWS, TOXIC_SHARE * toxic)
    if held.any():
        out[held] = np.log(toxic_rows[held] / toxic_rows.sum() / (raw_rows[held] / raw_rows.sum()))
    return np.where(out >= TOXIC_RATIO, out, 0.0)


def scored(docs: DataFrame, fitted: Model) -> DataFrame:
    """Base metrics, length-normalised log-likelihood ratio and toxic score of
    every row."""
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def score(batches):
        words, fitted = Words(), model.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                codes = all_codes(text, words)
                rows.append((doc_id, len(codes), *base_metrics(text or "", codes), *fitted.scores(text, codes, words)))
            yield rows

    return map_batches(docs.select("doc_id", "text"), score, METRICS, SLICE)


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut that best separates held-out good scores from bad ones while at
    least KEEP_OF_TRUSTED of the good pass; of equals, the lowest cut; halfway
    to the next lower score, so that near ties pass."""
    if not len(good):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    highest = good[int(np.floor((1 - KEEP_OF_TRUSTED) * len(good)))]
    cuts = np.unique(np.concatenate([good[good <= highest], [good[0]]]))
    won = np.searchsorted(bad, cuts) / max(1, len(bad)) - np.searchsorted(good, cuts) / len(good)
    cut = cuts[int(np.argmax(won))]
    below = np.concatenate([bad[bad < cut], good[good < cut]])
    return float((cut + below.max()) / 2) if len(below) else float(cut) - 1e-9


def cut_of(judged: DataFrame, score: str, bad: str, scratch: Scratch) -> float:
    """:func:`threshold` of a table with the columns ``score``, ``good`` and
    ``bad``, from running counts over its sorted scores."""
    each = judged.groupBy(F.col(score).alias("s")).agg(F.count_if("good").alias("g"), F.count_if(bad).alias("b")).where("g + b > 0")
    each = each.repartitionByRange("s").sortWithinPartitions("s").withColumn("part", F.spark_partition_id())
    rows = scratch.write(each, f"cuts-{score}")
    sums = sorted(tuple(r) for r in rows.groupBy("part").agg(F.sum("g"), F.sum("b")).collect())  # one row a partition
    n_good, n_bad = sum(g for _, g, _ in sums), sum(b for *_, b in sums)
    if not n_good:
        return -np.inf
    starts = [(p, sum(g for _, g, _ in sums[:k]), sum(b for *_, b in sums[:k])) for k, (p, *_) in enumerate(sums)]
    starts = literal_table(judged.sparkSession, starts, StructType.fromDDL("part int, g0 long, b0 long"))
    before = W.partitionBy("part").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    below = rows.join(F.broadcast(starts), "part").select(
        "s", "g", *[(F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"{c}0")).alias(f"{c}_below") for c in ("g", "b")])
    cuts = below.where(F.expr("g > 0") & (F.col("g_below") <= int(np.floor((1 - KEEP_OF_TRUSTED) * n_good))))
    won = F.col("b_below") / F.lit(float(max(1, n_bad))) - F.col("g_below") / F.lit(float(n_good))
    cut = cuts.orderBy(won.desc(), "s").first()["s"]
    lower = rows.where(F.col("s") < F.lit(cut)).agg(F.max("s")).first()[0]
    return cut - 1e-9 if lower is None else (cut + lower) / 2


def placed(labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, good, bad, toxic, place) of every labelled id, its place in the
    order of the ids' hash."""
    each = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.expr("quality = 1 AND coalesce(toxic, 0) = 0")).alias("good"), F.max(F.expr("quality = 0")).alias("bad"),
        F.max(F.expr("coalesce(toxic, 0) = 1")).alias("toxic"))
    return numbered(each, [F.xxhash64("doc_id"), "doc_id"], "place", scratch, "labels")


def labelled(labels: DataFrame) -> list[tuple[int, bool, bool, bool]]:
    """(doc_id, good, bad, toxic) in order of place, as a list, to judge small label sets by."""
    rows = placed(labels, Scratch(labels.sparkSession)).orderBy("place").drop("place").collect()
    return [(int(r.doc_id), bool(r.good), bool(r.bad), bool(r.toxic)) for r in rows]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    scratch = Scratch(docs.sparkSession)
    rows = placed(labels, scratch)
    # the last third takes no part
    first, second = [scratch.write(rows.where(F.col("place") % 3 == k).drop("place"), f"third-{k}") for k in range(2)]
    marked = docs.select("doc_id", "text").join(small_side(first, SMALL_ROWS), "doc_id", "left")
    counts = np.zeros((4, 2 * BUCKETS))
    for bucket, *found in corpus_counts(marked, F.col("good"), F.col("toxic")).collect():  # at most 2 * BUCKETS rows
        counts[:, bucket] = found
    n_toxic = first.where("toxic").count()
    model = Model(log_ratios(counts[0, :BUCKETS], counts[1, :BUCKETS]), toxic_odds(counts[2], counts[3], n_toxic))
    ids = small_side(second, SMALL_ROWS)
    judged = scored(docs.join(ids.select("doc_id"), "doc_id", "left_semi"), model).join(ids, "doc_id")
    passed = judged.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    # one score an id, however often its row is repeated
    passed = passed.groupBy("doc_id").agg(
        F.min("score").alias("score"), (-F.max("toxic_score")).alias("mild"), *[F.min(c).alias(c) for c in ("good", "bad", "toxic")])
    passed = scratch.write(passed, "judged")
    model.least = cut_of(passed, "score", "bad", scratch)
    if not passed.where("toxic").isEmpty():
        model.most = -cut_of(passed, "mild", "toxic", scratch)
    scratch.drop(*list(scratch.paths))
    return model


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base metrics, score, toxic_score, base_failed and kept for
    every row."""
    model = fit(docs, labels)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    passed = (F.col("score") >= F.lit(model.least)) & (F.col("toxic_score") <= F.lit(model.most))
    return scored(docs, model).withColumn("base_failed", failed).withColumn("kept", ~failed & passed)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that quality() keeps, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("boolean")
    def kept(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words()
        for texts in batches:
            yield pd.Series([model.value.keeps(t, words) for t in texts], dtype=bool)

    return docs.where(kept("text"))
