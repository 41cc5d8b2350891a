"""Ranked lexical search, reversed (operator 13).

The items are few and the documents many, so the inverted index is that of the
items: it is broadcast, every document's term counts stream through it once,
and each task keeps a bounded heap of the best documents of each item. The
heaps of all tasks are merged, those of a group of tasks first.

1. One pass counts the documents with terms, their terms, and in how many
   documents each of the items' terms occurs (one vector a task).
2. The items' postings (term -> items, with the times they repeat it) and the
   terms' weights are broadcast; a task scores a few documents at a time
   against all items and keeps ``TOP`` of each.

The index holds at most ``INDEX_BYTES`` of item text. More items are dealt into
blocks by hash, until no block holds more (or has one item only), and each
block takes the two passes, so memory is bounded for any number of items.

Scores are integers: a term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))),
and every item repeat of the term adds
weight * (10^9 tf div (1000 tf + 8 m)), m = 25 + (75 n N) div L.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
Defined cases: null or empty text has no terms and is no document of N; an item
without terms has no rows; every row of the items is an item of its own, every
row of the documents a document; of equal scores the smaller doc_id is first, a
null one last; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import map_batches

TOP = 10
INDEX_BYTES = 16 << 20
CELLS = 1 << 21  # scores (documents x items) held at a time
POSTINGS = 1 << 21  # postings expanded at a time
SLICE = 4 << 20
TASKS = 512  # tasks whose heaps are merged first
EXACT = 1 << 53  # sums of doubles below it are exact integers
OTHERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
NO_ID = np.iinfo(np.int64).max


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(OTHERS).split() if text else []


class Index:
    """Postings of some items: term -> items and repeats."""

    def __init__(self, texts: list[str | None]):
        self.terms: dict[bytes, int] = {}
        rows: dict[tuple[int, int], int] = {}
        for item, text in enumerate(texts):
            for t in terms(text):
                at = self.terms.setdefault(t, len(self.terms)), item
                rows[at] = rows.get(at, 0) + 1
        self.items = len(texts)
        pairs = sorted(rows)
        self.first = np.searchsorted([t for t, _ in pairs], np.arange(len(self.terms) + 1))
        self.item = np.array([i for _, i in pairs], np.int64)
        self.times = np.array([rows[p] for p in pairs], np.int64)

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """Terms of each text, and (text, term, tf) for the index's terms."""
        sizes, held = [], []
        for text in texts:
            own = terms(text)
            sizes.append(len(own))
            held.append(np.fromiter(map(self.terms.get, own, repeat(-1)), np.int64, len(own)))
        which = np.repeat(np.arange(len(texts)), sizes)
        flat = np.concatenate(held) if held else np.zeros(0, np.int64)
        known = flat >= 0
        keys, tf = np.unique(which[known] * max(1, len(self.terms)) + flat[known], return_counts=True)
        text, term = np.divmod(keys, max(1, len(self.terms)))
        return np.array(sizes, np.int64), text, term, tf


def length_terms(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of these sizes, in whole numbers of any size."""
    if len(sizes) and 75 * int(sizes.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(n) * n_docs // n_terms for n in sizes], np.int64)
    return 25 + 75 * sizes * n_docs // max(1, n_terms)


def blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """The items with a block number, and how many blocks there are."""
    own = items.select("item_id", "text", F.xxhash64("item_id", "text").alias("_h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("_n"))
    size = own.agg(F.sum("_n")).first()[0] or 0
    count = max(1, -(-size // INDEX_BYTES))
    while True:
        dealt = own.withColumn("_block", F.pmod("_h", F.lit(count)))
        sizes = dealt.groupBy("_block").agg(F.sum("_n").alias("n"), F.countDistinct("_h").alias("items"))
        if sizes.where((F.col("n") > INDEX_BYTES) & (F.col("items") > 1)).isEmpty():
            return dealt, count
        count *= 2


def statistics(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """N, L and df: one row a term of the index comes to the driver."""
    model = docs.sparkSession.sparkContext.broadcast(index)
    size = len(index.terms)

    def count(batches):
        total, df = np.zeros(2, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            sizes, _, term, _ = model.value.counts(batch.text)
            total += [np.count_nonzero(sizes), sizes.sum()]
            df += np.bincount(term, minlength=size)
        used = np.flatnonzero(df)
        yield {"term": np.concatenate([[-2, -1], used]), "n": np.concatenate([total, df[used]])}

    found = map_batches(docs.select("text"), count, "term long, n long", SLICE).groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r.term: r.n for r in found}
    model.unpersist()
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(size)], np.int64)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def scores(index: Index, gain: np.ndarray, sizes: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of all texts (rows) for all items; ``gain`` is weight * repeats
    of each posting."""
    out = np.zeros(len(sizes) * index.items, np.int64)
    share = 1_000_000_000 * tf // (1000 * tf + 8 * m[text])
    # a text's postings of one item add up to less than 10^6 * the item's gains
    exact = 1_000_000 * float(np.bincount(index.item, weights=gain, minlength=1).max()) < EXACT if len(gain) else True
    length = index.first[term + 1] - index.first[term]
    edges = np.concatenate([[0], np.cumsum(length)])
    at = 0
    while at < len(term):
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + POSTINGS, "right")) - 1)
        n = length[at:end]
        posting = np.repeat(index.first[term[at:end]] - (edges[at:end] - edges[at]), n) + np.arange(edges[end] - edges[at])
        cell = np.repeat(text[at:end], n) * index.items + index.item[posting]
        value = np.repeat(share[at:end], n) * gain[posting]
        if exact:
            out += np.bincount(cell, weights=value, minlength=len(out)).astype(np.int64)
        else:
            np.add.at(out, cell, value)
        at = end
    return out.reshape(len(sizes), index.items)


class Heaps:
    """The TOP best documents of each item so far."""

    def __init__(self, items: int):
        self.least = np.zeros(items, np.int64)  # a score at or below 0 never enters
        self.rows = np.zeros((0, 3), np.int64)  # item, -score, doc_id

    def add(self, found: np.ndarray, ids: np.ndarray) -> None:
        text, item = np.nonzero((found >= self.least) & (found > 0))
        if not len(text):
            return
        rows = np.concatenate([self.rows, np.stack([item, -found[text, item], ids[text]], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])
        first = np.flatnonzero(new)
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        self.rows = rows[place < TOP]
        full = rows[place == TOP - 1]
        self.least[full[:, 0]] = -full[:, 1]


def heaps(docs: DataFrame, index: Index, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score): every task's heaps."""
    gain = weight[np.repeat(np.arange(len(index.terms)), np.diff(index.first))] * index.times
    model = docs.sparkSession.sparkContext.broadcast((index, gain))
    step = max(1, CELLS // max(1, index.items))

    def rank(batches):
        index, gain = model.value
        best = Heaps(index.items)
        for batch in batches:
            for at in range(0, len(batch.text), step):
                sizes, text, term, tf = index.counts(batch.text[at : at + step])
                ids = np.array([NO_ID if d is None else d for d in batch.doc_id[at : at + step]], np.int64)
                best.add(scores(index, gain, sizes, text, term, tf, length_terms(sizes, n_docs, n_terms)), ids)
        ids = [None if d == NO_ID else d for d in best.rows[:, 2].tolist()]
        yield {"item": best.rows[:, 0], "doc_id": ids, "score": -best.rows[:, 1]}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rank, "item int, doc_id long, score long", SLICE)


def best_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(f"rank <= {TOP}")


def search_block(docs: DataFrame, items: list, kind: str) -> DataFrame:
    """item_id, rank, doc_id, score for the gathered ``items``."""
    index = Index([r.text for r in items])
    n_docs, n_terms, df = statistics(docs, index)
    found = heaps(docs, index, weights(n_docs, df), n_docs, n_terms)
    some = best_of(found.withColumn("part", F.floor(F.spark_partition_id() / TASKS)), ["item", "part"])
    best = best_of(some.drop("part", "rank"), ["item"])
    names = docs.sparkSession.createDataFrame([(k, r.item_id) for k, r in enumerate(items)], f"item int, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's TOP best documents
    with a score above 0."""
    dealt, count = blocks(items)
    kind = items.schema["item_id"].dataType.simpleString()
    out = None
    for k in range(count):
        own = dealt.where(F.col("_block") == k).select("item_id", "text").collect()  # INDEX_BYTES of text, or one item
        if own or out is None:
            found = search_block(docs, own, kind)
            out = found if out is None else out.unionByName(found)
    return out
