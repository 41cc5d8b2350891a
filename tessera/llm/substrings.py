"""Repeated 200-byte strings by bucket-pointer refinement (operator 8).

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
is removed. Sorting all suffixes would shuffle many times the corpus, so the
refinement runs on sampled suffixes and opens every position only where
buckets stay mixed:

1. Initial buckets: q-grams of ``GRAM`` bytes. Each window of LENGTH bytes is
   represented by the smallest bucket identifier among its q-grams (leftmost
   of equals). Equal windows choose the same q-gram at the same distance, so
   a window can repeat only if its representative's bucket is shared. Windows
   in a row with one representative form a run.
2. First refinement: a run's identifier extends its bucket by all bytes that
   the run's windows cover. Runs with equal identifiers repeat as a whole.
3. Second refinement, for buckets that hold several run identifiers: one run
   of each is opened to its positions, and these are sorted on identifiers
   of LENGTH bytes, made by doubling: the identifier of 2 * GRAM bytes joins
   those at p and p + GRAM, and that of LENGTH bytes joins two of these.

Rows sent to the shuffle are at most two of each run identifier and Arrow
batch, so a passage that a third of the texts share doesn't meet in one task.
Identifiers are 64-bit hashes (n identifiers: some n^2 / 2^65 false matches).
Equal texts are one text; one that occurs twice goes as a whole.

Defined cases: null text is empty; texts under LENGTH bytes stay whole; equal
rows give equal results; null ids are returned; texts of any length are
worked through in pieces of ``PIECE`` windows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import map_batches
from tessera.session import Scratch

LENGTH, GRAM = 200, 64
PIECE = 1 << 18
SMALL_ROWS = 1_000_000  # runs or spans that may be broadcast (some 16 MB)
RUNS = "g long, e long, key long, at long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Hasher:
    """Identifiers of byte strings by a polynomial over random byte values."""

    def __init__(self):
        rng = np.random.default_rng(8)
        self.values = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        factor = int(rng.integers(1 << 62, 1 << 63)) | 1
        size = PIECE + LENGTH
        self.up = self.powers(factor, size)
        self.down = self.powers(pow(factor, -1, 1 << 64), size)

    @staticmethod
    def powers(factor: int, size: int) -> np.ndarray:
        out = np.full(size, factor, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def prefix(self, data: bytes) -> np.ndarray:
        values = self.values[np.frombuffer(data, np.uint8)]
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((prefix[end] - prefix[start]) * self.down[start])

    def grams(self, prefix: np.ndarray) -> np.ndarray:
        n = len(prefix) - GRAM
        return mixed((prefix[GRAM:] - prefix[:n]) * self.down[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mixed(x * np.uint64(0x9E3779B97F4A7C15) + y)


def smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest identifier (by its high bits, leftmost of equals)
    in each window of ``width``."""
    low = np.uint64((1 << 20) - 1)
    best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    count, k = len(grams) - width + 1, 1
    while 2 * k <= width:
        best = np.minimum(best[:-k], best[k:])
        k *= 2
    return (np.minimum(best[:count], best[width - k : width - k + count]) & low).astype(np.int64)


def pieces(data: bytes):
    """(offset, bytes) with every window of the text in exactly one piece."""
    for at in range(0, len(data) - LENGTH + 1, PIECE):
        yield at, data[at : at + PIECE + LENGTH - 1]


def runs(data: bytes, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, run identifier and place (first window << 8 | windows - 1)."""
    out = []
    for offset, part in pieces(data):
        prefix = hasher.prefix(part)
        grams = hasher.grams(prefix)
        chosen = smallest(grams, LENGTH - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        shape = (chosen[first] - first) * 512 + (last - first)
        ids = joined(hasher.spans(prefix, first, last + LENGTH), shape.astype(np.uint64))
        out.append((grams[chosen[first]], ids, ((first + offset) << 8 | (last - first)).astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def positions(data: bytes, places: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of the given runs, and their LENGTH-byte identifiers."""
    starts, ids = [], []
    firsts = places >> 8
    for offset, part in pieces(data):
        own = places[(firsts >= offset) & (firsts < offset + PIECE)]
        if len(own):
            grams = hasher.grams(hasher.prefix(part))
            at = np.concatenate([np.arange(p >> 8, (p >> 8) + (p & 255) + 1) for p in own.tolist()]) - offset
            double = lambda p: joined(grams[p], grams[p + GRAM])
            starts.append(at + offset)
            ids.append(joined(double(at), double(at + LENGTH - 2 * GRAM)))
    return np.concatenate(starts), np.concatenate(ids)


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal spans of (start, end) rows; spans that touch are one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([spans[first, 0], reach[last]], axis=1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _all_runs(texts: DataFrame, reduce: bool) -> DataFrame:
    """Runs of every text; with ``reduce`` a batch sends only the first and
    the last member of each run identifier."""

    def find(batches):
        hasher = Hasher()
        for batch in batches:
            found = [(key, runs(t.encode(), hasher)) for key, t in zip(batch.key, batch.text)]
            if not found:
                continue
            g, e, at = (np.concatenate([f[1][k] for f in found]) for k in range(3))
            key = np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1][0]) for f in found])
            if reduce:
                order = np.lexsort((at, key, e))
                new = np.concatenate([[True], e[order][1:] != e[order][:-1]])
                edge = order[new | np.concatenate([new[1:], [True]])]
                g, e, at, key = g[edge], e[edge], at[edge], key[edge]
            yield {"g": _signed(g), "e": _signed(e), "key": key, "at": at}

    return map_batches(texts.select("key", "text"), find, RUNS)


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, spans array<struct<start, end>>) of the texts that lose bytes."""
    texts = docs.where(F.octet_length("text") >= LENGTH).select(F.xxhash64("text").alias("key"), "text")
    ids = _all_runs(texts, True).repartition("g").groupBy("g", "e").agg(
        F.min("key").alias("k0"), F.max("key").alias("k1"), F.min("at").alias("a0"), F.max("at").alias("a1"), F.max_by("at", "key").alias("at"))
    sized = ids.withColumn("kinds", F.count("*").over(W.partitionBy("g"))).withColumn("again", F.expr("k0 <> k1 OR a0 <> a1"))
    refined = scratch.write(sized.where("again OR kinds > 1").select("g", "e", F.col("k1").alias("key"), "at", "kinds", "again"), "buckets")
    # whole runs that repeat
    again = refined.where("again").select("g", "e")
    whole = _all_runs(texts, False).join(again, ["g", "e"], "left_semi").select("key", F.expr("shiftright(at, 8)").alias("start"), F.expr(f"shiftright(at, 8) + (at & 255L) + {LENGTH}").alias("end"))
    # mixed buckets, opened to their positions
    opened = refined.where("kinds > 1").groupBy("key").agg(F.collect_list(F.struct("at", "again")).alias("places"))
    opened = scratch.write(opened, "opened")
    n = opened.agg(F.sum(F.size("places"))).first()[0] or 0
    some = texts.join(F.broadcast(opened) if n <= SMALL_ROWS else opened, "key")

    def open_runs(batches):
        hasher = Hasher()
        for batch in batches:
            parts: list = []
            for key, text, places in zip(batch.key, batch.text, batch.places):
                for again in (False, True):
                    at = np.array([p["at"] for p in places if p["again"] == again], np.int64)
                    if len(at):
                        starts, names = positions(text.encode(), np.sort(at), hasher)
                        parts.append((_signed(names), np.full(len(starts), key), starts, np.full(len(starts), again)))
            if parts:
                yield dict(zip(("h", "key", "start", "again"), (np.concatenate(x) for x in zip(*parts))))

    single = map_batches(some.select("key", "text", "places"), open_runs, "h long, key long, start long, again boolean")
    same = W.partitionBy("h")
    pairs = single.withColumn("many", (F.min("key").over(same) != F.max("key").over(same)) | (F.min("start").over(same) != F.max("start").over(same)))
    alone = pairs.where("many AND NOT again").select("key", "start", (F.col("start") + LENGTH).alias("end"))
    copies = texts.groupBy("key").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size")).where("n > 1")
    entire = copies.select("key", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))
    listed = whole.unionByName(alone).unionByName(entire).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def merge(batches):
        for batch in batches:
            found = [merged(np.array([(s["start"], s["end"]) for s in spans], np.int64)) for spans in batch.spans]
            yield {"key": batch.key, "spans": [[{"start": int(a), "end": int(b)} for a, b in f] for f in found]}

    return scratch.write(map_batches(listed, merge, "key long, spans array<struct<start: long, end: long>>"), "spans")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    scratch = Scratch(docs.sparkSession)
    spans = repeated_spans(docs, scratch)
    n = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    scratch.drop("buckets", "opened")
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    own = own.join(F.broadcast(spans) if n <= SMALL_ROWS else spans, "key", "left")

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.doc_id, batch.text, batch.spans):
                data, digest, at, gone = text.encode(), hashlib.sha256(), 0, 0
                spans = [] if spans is None else spans
                for span in spans:
                    digest.update(data[at : span["start"]])
                    at = span["end"]
                    gone += span["end"] - span["start"]
                digest.update(data[at:])
                rows.append((doc_id, len(data), gone, len(spans), digest.hexdigest()))
            yield rows

    return map_batches(own.select("doc_id", "text", "spans"), cut, RESULT)
