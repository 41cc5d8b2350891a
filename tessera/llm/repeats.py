"""Repeated word windows behind a count-min prefilter (operator 11).

A window is ``WINDOW`` consecutive words of one document; every word covered
by a window that also starts anywhere else is removed. All windows of a
corpus are several times its size, so they are not grouped:

1. Every task sketches its windows: each window falls into one cell of each of
   ``ROWS`` rows, and a cell counts none, one or more. A task sends the cells
   it used, a block of ``CELLS`` at a time; the blocks of all tasks are merged
   as a sorted stream, one block in memory at a time.
2. A window whose cells all say "more" is estimated repeated. An estimate is
   never below the true count, so no repeated window is lost.
3. Only those windows are grouped, exactly, by 128-bit names (two independent
   64-bit hashes of the words). Each Arrow batch sends a name once.
4. The places of those windows are joined with the names that occur twice.
   Names that repeat within a batch are known there and need no join.

Of equal texts one takes part, as one that occurs twice; these lose all their
words anyway.

The sketch has some two cells a window in each row, at most ``MOST``
cells in all: one bit each (64 MB) is what the driver gathers and broadcasts,
whatever the corpus size. Beyond it the estimates get looser, so more windows
are grouped; the result stays the same, and the cost stays linear with at
most all windows grouped.

Texts are named by two 64-bit hashes. Defined cases: null text has no words;
texts of fewer than WINDOW words lose nothing; equal rows give equal results;
null ids are returned; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.common import batches_of, map_batches, small_side
from tessera.llm.words import Words, cut
from tessera.session import Scratch

WINDOW = 35
ROWS = 2
CELLS = 1 << 20  # cells of a block
MOST = 1 << 29  # cells of the sketch
LEAST = 1 << 22
BYTES_A_WORD = 6
SLICE = 1 << 20  # bytes of rows held as Python values at a time
BATCH = 1 << 22  # bytes of rows that Spark sends to a task's Python at a time
HELD = 1 << 20  # windows a task sketches before it sends their cells
SMALL_ROWS = 1_000_000  # spans, or names of copies, that may be broadcast (some 24 MB)
NAMES = 100_000  # names of repeated windows that may be broadcast (some 2 MB)
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def joined(x: np.ndarray, y: np.ndarray, factor: int) -> np.ndarray:
    out = x * np.uint64(factor) + y
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def window_names(codes: np.ndarray, factor: int) -> np.ndarray:
    """Hashes of all windows, from hashes of 1, 2, 4, ... words."""
    count = len(codes) - WINDOW + 1
    power, done, out = codes, 0, None
    for bit in range(WINDOW.bit_length()):
        if WINDOW >> bit & 1:
            part = power[done : done + count]
            out = part if out is None else joined(out, part, factor)
            done += 1 << bit
        if WINDOW >> (bit + 1):
            power = joined(power[: -(1 << bit)], power[1 << bit :], factor + 2 * bit + 2)
    return joined(out, np.uint64(WINDOW), factor)


FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def windows(texts: list, words: Words, lanes: int = 2):
    """(text number, first word, names...) of all windows of ``texts``: short
    texts by the group, long ones alone."""

    def found(numbers: list[int], sizes: np.ndarray, codes: np.ndarray):
        first = np.cumsum(sizes) - sizes
        which = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.arange(codes.shape[1]) - first[which]
        inside = np.flatnonzero((pos + WINDOW <= sizes[which])[: codes.shape[1] - WINDOW + 1])
        names = [window_names(codes[k], FACTORS[k])[inside] for k in range(lanes)]
        return np.array(numbers, np.int64)[which[inside]], pos[inside], *names

    def group(held: list[tuple[int, bytes]]):
        start, codes = words.codes(b"\n".join(data for _, data in held), lanes)
        offset = np.cumsum([0] + [len(data) + 1 for _, data in held])
        sizes = np.diff(np.searchsorted(start, offset))
        if codes.shape[1] >= WINDOW:
            yield found([t for t, _ in held], sizes, codes)

    held, size = [], 0
    for t, text in enumerate(texts):
        if not text or len(text) < 2 * WINDOW - 1:
            continue
        data = text.encode()
        if len(data) > w.PART:
            codes = np.concatenate([words.codes(part, lanes)[1] for part in cut(data)], axis=1)
            if codes.shape[1] >= WINDOW:
                yield found([t], np.array([codes.shape[1]]), codes)
            continue
        if size + len(data) + 1 > w.PART:
            yield from group(held)
            held, size = [], 0
        held.append((t, data))
        size += len(data) + 1
    if held:
        yield from group(held)


def cells_of(name: np.ndarray, row: int, width: int) -> np.ndarray:
    """The windows' cells in a row: other bits of a mixed name for each."""
    mixed = name * np.uint64(FACTORS[row % 2] + 4 * row)
    return (mixed >> np.uint64(20)) % np.uint64(width)


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers below 2^32 as compressed differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(values.astype(np.uint32), prepend=np.uint32(0)).tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32), dtype=np.int64)


def sketch_width(docs: DataFrame) -> int:
    """Cells of a row, in whole blocks: the same share of the corpus at any
    size, up to the bound."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    want = -(-2 * size // BYTES_A_WORD // CELLS) * CELLS
    return min(MOST // ROWS, max(LEAST // ROWS, want))


def partial_sketches(docs: DataFrame, width: int) -> DataFrame:
    """(block, used, more): the cells of a block that some windows of a task
    used, and those that more than one used."""

    def sketch(batches):
        words, held, size = Words(), [], 0

        def blocks():
            name = np.concatenate(held)
            for row in range(ROWS):
                cell = np.sort(cells_of(name, row, width).astype(np.uint32))
                new = np.concatenate([[True], cell[1:] != cell[:-1]])
                more = np.unique(cell[~new])
                used = cell[new]
                edges = np.arange(0, width + 1, CELLS)
                at, of = np.searchsorted(used, edges), np.searchsorted(more, edges)
                for b in np.flatnonzero(np.diff(at)).tolist():
                    low = np.uint32(b * CELLS)
                    yield row * (width // CELLS) + b, pack(used[at[b] : at[b + 1]] - low), pack(more[of[b] : of[b + 1]] - low)

        for batch in batches:
            for _, _, name in windows(batch.text, words, 1):
                held.append(name)
                size += len(name)
                if size >= HELD:
                    yield list(blocks())
                    held, size = [], 0
        if size:
            yield list(blocks())

    return map_batches(docs.select("text"), sketch, "block int, used binary, more binary", SLICE)


def merged_sketch(partial: DataFrame) -> DataFrame:
    """(block, more): a bit for each cell that more than one window used."""

    def merge(batches):
        current, used, more = None, None, None
        for batch in batches:
            done = []
            for block, one, two in zip(batch.block, batch.used, batch.more):
                if block != current:
                    if current is not None:
                        done.append((current, np.packbits(more).tobytes()))
                    current, used, more = block, np.zeros(CELLS, bool), np.zeros(CELLS, bool)
                cells = unpack(one)
                more[cells[used[cells]]] = True
                more[unpack(two)] = True
                used[cells] = True
            yield done
        if current is not None:
            yield [(current, np.packbits(more).tobytes())]

    return map_batches(partial.repartition("block").sortWithinPartitions("block"), merge, "block int, more binary")


def gather(sketch: DataFrame, width: int) -> np.ndarray:
    """The whole sketch, at most MOST bits, as bytes of eight cells."""
    out = np.zeros(ROWS * width // 8, np.uint8)
    for block, more in sketch.toLocalIterator():
        out[block * (CELLS // 8) : (block + 1) * (CELLS // 8)] = np.frombuffer(more, np.uint8)
    return out


def estimated_repeated(name: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Whether every row's cell says more than one."""
    out = np.ones(len(name), bool)
    for row in range(ROWS):
        cell = cells_of(name, row, width) + np.uint64(row * width)
        out &= (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def candidates(docs: DataFrame, model, width: int, places: bool) -> DataFrame:
    """The windows estimated repeated. Without ``places`` (h1, h2, n): each
    batch sends a name once, with n = 2 if it holds the window twice or in a
    text that has a copy. With them (h1, h2, t1, t2, at, known): every place in
    texts without copies, known where the batch itself shows that the window
    repeats."""

    def find(batches):
        words, bits = Words(), model.value
        for batch in batches:
            for text, pos, h1, h2 in windows(batch.text, words):
                hot = np.flatnonzero(estimated_repeated(h1, bits, width))
                if not len(hot):
                    continue
                text, pos, h1, h2 = text[hot], pos[hot], h1[hot], h2[hot]
                order = np.lexsort((h2, h1))
                a, b = h1[order], h2[order]
                new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                if not places:
                    times = np.diff(np.append(np.flatnonzero(new), len(a)))
                    times += np.add.reduceat(np.array(batch.copy)[text[order]], np.flatnonzero(new), dtype=np.int64)
                    yield {"h1": _signed(a[new]), "h2": _signed(b[new]), "n": np.minimum(times, 2)}
                    continue
                again = np.empty(len(a), bool)
                again[order] = ~(new & np.append(new[1:], True))
                names = {(batch.t1[t], batch.t2[t]): t for t in np.unique(text).tolist() if not batch.copy[t]}
                own = np.isin(text, list(names.values()))  # one of the batch's equal texts
                text, pos, h1, h2, again = text[own], pos[own], h1[own], h2[own], again[own]
                t1, t2 = (np.array(x, np.int64) for x in (batch.t1, batch.t2))
                yield {"h1": _signed(h1), "h2": _signed(h2), "t1": t1[text], "t2": t2[text], "at": pos, "known": again}

    if not places:
        return map_batches(docs.select("text", "copy"), find, "h1 long, h2 long, n int", SLICE)
    return map_batches(docs.select("text", "copy", "t1", "t2"), find, "h1 long, h2 long, t1 long, t2 long, at long, known boolean", SLICE)


def named(docs: DataFrame) -> DataFrame:
    """``text`` with the two hashes that name it."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return own.select("*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(11), "text").alias("t2"))


def merged(starts: np.ndarray) -> list[dict]:
    """Maximal runs of words that windows at the sorted ``starts`` cover."""
    first = np.concatenate([[True], np.diff(starts) > WINDOW])
    last = np.append(first[1:], True)
    return [{"start": a, "end": b} for a, b in zip(starts[first].tolist(), (starts[last] + WINDOW).tolist())]


def one_of_copies(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``texts`` with the column copy, less all but one (or those of one
    doc_id) of equal texts, and the names (t1, t2) of texts that occur twice. Beyond
    SMALL_ROWS such names all texts stay: the result is the same."""
    groups = texts.where(F.octet_length("text") >= 2 * WINDOW - 1).groupBy("t1", "t2")
    twice = groups.agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1").select("t1", "t2", "first")
    twice = scratch.write(twice, "copies")
    if twice.count() > SMALL_ROWS:
        return texts.withColumn("copy", F.lit(False)), twice.limit(0)
    joined_ = texts.join(F.broadcast(twice.withColumn("copy", F.lit(True))), ["t1", "t2"], "left")
    one = joined_.where("copy IS NULL OR doc_id <=> first").withColumn("copy", F.col("copy").isNotNull())
    return one.drop("first"), twice


def repeated_spans(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(t1, t2, spans array<struct<start, end>>) of the texts of ``texts`` (with
    copy) without copies that lose words, as a written table; spans are of words."""
    spark = texts.sparkSession
    width = sketch_width(texts)
    sketch = scratch.write(merged_sketch(partial_sketches(texts, width)), "sketch")
    model = spark.sparkContext.broadcast(gather(sketch, width))
    found = candidates(texts, model, width, False).groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    repeated = scratch.write(found.where("n > 1").select("h1", "h2"), "repeated")
    places = candidates(texts, model, width, True)
    alone = places.where("NOT known").join(small_side(repeated, NAMES), ["h1", "h2"]).select("t1", "t2", "at")
    hit = alone.unionByName(places.where("known").select("t1", "t2", "at")).distinct()
    listed = hit.groupBy("t1", "t2").agg(F.sort_array(F.collect_list("at")).alias("at"))

    def merge(batches):
        for batch in batches:
            yield {"t1": batch.t1, "t2": batch.t2, "spans": [merged(np.array(x, np.int64)) for x in batch.at]}

    spans = scratch.write(map_batches(listed, merge, "t1 long, t2 long, spans array<struct<start: long, end: long>>", SLICE), "spans")
    model.unpersist()
    scratch.drop("sketch", "repeated")
    return spans


def with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text ("" for null), the spans of words that go, if any, and
    whether the text occurs twice."""
    texts, scratch = named(docs), Scratch(docs.sparkSession)
    one, twice = one_of_copies(texts, scratch)
    with batches_of(docs.sparkSession, BATCH):
        spans = repeated_spans(one, scratch)
    n = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    both = texts.join(F.broadcast(spans) if n <= SMALL_ROWS else spans, ["t1", "t2"], "left")
    both = both.join(F.broadcast(twice.select("t1", "t2", F.lit(True).alias("copy"))), ["t1", "t2"], "left")
    return both.select("doc_id", "text", "spans", F.col("copy").isNotNull().alias("copy"))


def kept_words(text: str, spans: list | None, copy: bool) -> tuple[list[bytes], int, int]:
    """The parts of a text that stay, their words joined by one space, and the
    counts of all words and of those that go."""
    at, gone, out = 0, 0, []
    spans = spans or []
    for part in cut(text.encode()):
        words = part.split()
        done = 0
        for span in spans:
            a, b = min(max(span["start"] - at, 0), len(words)), min(max(span["end"] - at, 0), len(words))
            if b > a:
                out.append(b" ".join(words[done:a]))
                gone += b - a
                done = b
        out.append(b" ".join(words[done:]))
        at += len(words)
    if copy and at >= WINDOW:
        return [], at, at
    return list(filter(None, out)), at, gone


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (the words that stay, joined by one space), n_words,
    n_removed of every row."""

    def cut_out(batches):
        for batch in batches:
            rows = []
            for doc_id, text, spans, copy in zip(batch.doc_id, batch.text, batch.spans, batch.copy):
                kept, n, gone = kept_words(text, spans, copy)
                rows.append((doc_id, b" ".join(kept).decode(), n, gone))
            yield rows

    return map_batches(with_spans(docs), cut_out, "doc_id long, text string, n_words long, n_removed long", SLICE)


def dedup_windows(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""

    def digest(batches):
        for batch in batches:
            rows = []
            for doc_id, text, spans, copy in zip(batch.doc_id, batch.text, batch.spans, batch.copy):
                kept, n, gone = kept_words(text, spans, copy)
                rows.append((doc_id, n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield rows

    found = with_spans(docs)
    with batches_of(docs.sparkSession, BATCH):
        return Scratch(docs.sparkSession).write(map_batches(found, digest, RESULT, SLICE), "digests")
