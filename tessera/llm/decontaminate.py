"""Benchmark decontamination by a prefix-filtered set join (operator 7).

A benchmark item gives one window for every run of ``WINDOW`` words (an item
of fewer words is one window). A document contains a window only if it holds
all of its shingles (two words, or the word of a one-word window), so for
containment 1 the necessary prefix of a window is its single rarest shingle.
Shingles are ordered by their count over all documents, documents meet
windows on that one shingle, the match's place and the lengths bound where
the window would lie, and the words there are compared exactly.

DataFrame functions only. The documents are cut into words once: that pass
keeps every place that holds a shingle of some window, and each document's
length. Counts, prefixes and candidates come from there, and only candidate
documents are read again for the comparison. Shingles are joined in blocks of
at most ``BLOCK`` so that what is broadcast is bounded; a larger benchmark
takes more passes over the documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A first
match on wholly lower-cased words is looser than that and is then confirmed.

Defined cases: a null or empty text has no words and no hits; items without
words give no window; equal windows of several items count for all of them;
repeated documents are returned once each, with equal results; rows with one
doc_id and different texts are judged apart; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import row_key, small_side
from tessera.session import Scratch

WINDOW = 10
BLOCK = 100_000
KEYS, CANDIDATES = 1_000_000, 500_000  # rows of some 16 bytes that may be broadcast
STOP, END = "\0", 0  # no word is STOP; END is its token
# A-Z are still upper case here, so they are left out of the separators
OTHERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str):
    """Replacing a pattern and splitting at spaces takes half the time of
    extracting words."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), F.lit(OTHERS), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def _plain(words):
    """Words joined by spaces, A-Z in lower case."""
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def _token(first: str, second: str):
    return F.expr(f"xxhash64(lower({first}), lower({second}))")


def windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, len, body) and which items have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), _words("text").alias("words")).where("size(words) > 0")
    placed = items.select("item", "words", F.explode(F.expr(f"sequence(0, greatest(size(words) - {WINDOW}, 0))")).alias("at"))
    cut = placed.select("item", F.expr(f"slice(words, at + 1, {WINDOW})").alias("part"))
    named = cut.select("item", F.size("part").alias("len"), _plain(F.col("part")).alias("body"))
    named = named.withColumn("win", F.xxhash64("body"))
    return named.select("win", "len", "body").distinct(), named.where("item IS NOT NULL").select("win", "item").distinct()


def window_tokens(wins: DataFrame) -> DataFrame:
    """(win, len, off, token): every shingle of every window."""
    split = wins.withColumn("words", F.split("body", " "))
    off = split.select("win", "len", "words", F.explode(F.expr("sequence(0, greatest(len - 2, 0))")).alias("off"))
    return off.select("win", "len", "off", _token("words[off]", "get(words, off + 1)").alias("token"))


def document_tokens(docs: DataFrame, singles: bool) -> DataFrame:
    """(doc_id, key, pos, token): every place of every document with its
    shingle; with one-word windows about, also with its word alone. A last
    place, after the words, has the token END."""
    held = docs.select("doc_id", row_key().alias("key"), F.concat(_words("text"), F.array(F.lit(STOP))).alias("words"))
    at = held.select("doc_id", "key", "words", F.posexplode("words").alias("pos", "word"))
    stop = F.col("word") == STOP
    pairs = at.select("doc_id", "key", "pos", F.when(stop, F.lit(END)).otherwise(_token("word", "get(words, pos + 1)")).alias("token"))
    if not singles:
        return pairs
    alone = at.where(~stop).select("doc_id", "key", "pos", F.expr("xxhash64(lower(word), lower(CAST(NULL AS STRING)))").alias("token"))
    return pairs.unionByName(alone)


def places(docs: DataFrame, tokens: DataFrame, singles: bool, blocks: int) -> DataFrame:
    """The places of ``document_tokens`` that hold a token of a window or END."""
    found = None
    for k in range(blocks):
        part = tokens.select("token").where(F.expr(f"pmod(token, {blocks}) = {k}")).distinct()
        if k == 0:  # with the first block come the lengths
            part = part.unionByName(part.sparkSession.range(1).select(F.lit(END).cast("long").alias("token")))
        met = document_tokens(docs, singles).join(F.broadcast(part), "token", "left_semi")
        met = met.select(F.when(F.col("token") == END, F.col("doc_id")).alias("doc_id"), "key", "pos", "token")
        found = met if found is None else found.unionByName(met)
    return found


def prefixes(tokens: DataFrame, met: DataFrame) -> DataFrame:
    """(win, len, off, token), one row a window: its rarest shingle over all
    documents."""
    counts = met.where(F.col("token") != END).groupBy("token").agg(F.count("*").alias("times"))
    # a window with a shingle that no document has cannot occur
    ranked = tokens.join(counts, "token", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    rarest = F.min_by(F.struct("len", "off", "token", "times"), F.struct("times", "token", "off"))
    return ranked.groupBy("win").agg(rarest.alias("p")).select("win", "p.*").where("times > 0").drop("times")


def occurrences(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, start, len, win) of every occurrence of a window, the items of
    the windows, and (doc_id, key, n_words) of every document row."""
    wins, items = windows(benchmark)
    wins, items = scratch.write(wins, "windows"), scratch.write(items, "window-items")
    tokens = scratch.write(window_tokens(wins), "window-tokens")
    singles = not tokens.where("len = 1").isEmpty()
    blocks = max(1, -(-tokens.count() // BLOCK))
    met = scratch.write(places(docs, tokens, singles, blocks), "places")
    chosen = scratch.write(prefixes(tokens, met), "prefixes")
    sizes = met.where(F.col("token") == END).select("doc_id", "key", F.col("pos").cast("long").alias("n_words"))
    placed = met.where(F.col("token") != END).select("key", "pos", "token").join(small_side(chosen, BLOCK), "token")
    grouped = placed.where("pos >= off").groupBy("key").agg(F.collect_set(F.struct((F.col("pos") - F.col("off")).alias("start"), "len", "win")).alias("c"))
    candidates = scratch.write(grouped, "candidates").withColumnRenamed("key", "_key")
    n = candidates.agg(F.sum(F.size("c"))).first()[0] or 0
    candidates = F.broadcast(candidates) if n <= CANDIDATES else candidates
    some = docs.select(row_key().alias("key"), _words("text").alias("words")).join(candidates, F.col("key") == F.col("_key"))
    # the words at a place name a window; that they are it is compared after
    fits = F.filter("c", lambda x: (x["start"] + x["len"] <= F.size("words")) & (F.xxhash64(_plain(F.slice("words", x["start"] + 1, x["len"]))) == x["win"]))
    met_at = some.select("key", "words", F.explode(fits).alias("x")).select(
        "key", "x.start", "x.len", "x.win", _plain(F.expr("slice(words, x.start + 1, x.len)")).alias("said"))
    hits = met_at.join(small_side(wins.select("win", "body"), BLOCK), "win").where("said = body").select("key", "start", "len", "win")
    return scratch.write(hits, "occurrences"), items, sizes


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every
    document row."""
    hits, items, sizes = occurrences(docs, benchmark, Scratch(docs.sparkSession))
    spans = hits.groupBy("key", "start").agg(F.max(F.expr("start + len")).alias("end"))
    before = W.partitionBy("key").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    reach = spans.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = reach.groupBy("key").agg(F.sum(F.expr("greatest(0, end - greatest(start, reach))")).alias("n_hit"))
    named = hits.select("key", "win").distinct().join(small_side(items, BLOCK), "win").select("key", "item").distinct()
    listed = named.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("list"))
    out = sizes.join(covered, "key", "left").join(listed, "key", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("list"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "list"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any occurrence, with all their columns."""
    scratch = Scratch(docs.sparkSession)
    hits = occurrences(docs, benchmark, scratch)[0]
    hit = scratch.write(hits.select(F.col("key").alias("_key")).distinct(), "contaminated")
    return docs.withColumn("_key", row_key()).join(small_side(hit, KEYS), "_key", "left_anti").drop("_key")
