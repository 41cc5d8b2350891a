"""Fill-in-middle transformation on a piece table (operator 12).

A document is a list of descriptors (buffer, start, length) over two immutable
buffers: its text and the sentinels. Cutting splits descriptors, arrangements
permute them and put sentinel descriptors between, and neither copies text.
Rendering and hashing stream the descriptors. Restoring makes a piece table
over the output, finds the sentinels there and applies the inverse
permutation.

Units are words with the blanks before them, and blanks at the end. Cuts and
the form follow from hashes of ``seed:doc_id`` alone: h1 to h4 are the first
four 32-bit groups of its SHA-256. The prefix ends after min(h1, h2) mod
(n + 1) units, the middle after the larger; h3 leaves ``100 - rate`` in a
hundred documents plain, and h4 makes ``spm`` in a hundred of the others
suffix-prefix-middle, the rest prefix-suffix-middle. Empty texts and texts
that hold a sentinel stay plain, so every output can be undone.

Every row is worked on alone, with no shuffle. Defined cases: null text counts
as empty; a null doc_id hashes as ``seed:`` without a number; equal rows give
equal results; extra columns are kept by ``fill_in_middle`` and ignored by
``digests``; a text of any length is one row's work.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches

SEED, RATE, SPM = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARKS = 0, 1  # buffers
SLICE = 8 << 20
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

Piece = tuple[int, int, int]  # buffer, start, length

#: the order of the parts prefix, middle, suffix in each form, with the
#: sentinel that goes before each
ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}


def unit_ends(text: str) -> np.ndarray:
    """Where each unit ends, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    return np.append(ends, len(codes)) if len(codes) and blank[-1] else ends


def split_at(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after ``at`` code points; the one that
    holds the place is split."""
    left: list[Piece] = []
    for k, (buffer, start, length) in enumerate(pieces):
        if at < length:
            if at:
                left.append((buffer, start, at))
            return left, [(buffer, start + at, length - at), *pieces[k + 1 :]]
        left.append((buffer, start, length))
        at -= length
    return left, []


def mark(sentinel: str) -> Piece:
    return MARKS, SENTINELS.index(sentinel), len(sentinel)


def stream(pieces: list[Piece], buffers: tuple[str, str]):
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(pieces: list[Piece], buffers: tuple[str, str]) -> str:
    out = hashlib.sha256()
    for part in stream(pieces, buffers):
        out.update(part.encode())
    return out.hexdigest()


@dataclass
class Rules:
    seed: int = SEED
    rate: int = RATE
    spm: int = SPM

    def numbers(self, doc_id: int | None) -> list[int]:
        name = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(name[k : k + 8], 16) for k in range(0, 32, 8)]

    def arrange(self, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, list[Piece]]:
        """Units, form, code points of prefix and middle, descriptors."""
        ends = unit_ends(text)
        h1, h2, h3, h4 = self.numbers(doc_id)
        whole: list[Piece] = [(TEXT, 0, len(text))] if text else []
        if not text or h3 % 100 >= self.rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
            return len(ends), "plain", None, None, whole
        bounds = np.concatenate([[0], ends])
        first, second = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
        a, b = int(bounds[first]), int(bounds[second])
        prefix, rest = split_at(whole, a)
        middle, suffix = split_at(rest, b - a)
        parts = (prefix, middle, suffix)
        form = "spm" if h4 % 100 < self.spm else "psm"
        return len(ends), form, a, b - a, [p for s, k in ORDER[form] for p in (mark(s), *parts[k])]


def restored(output: str, form: str) -> list[Piece]:
    """Descriptors over ``output`` that give the text back: the parts between
    the sentinels, put back in order. No part holds a sentinel, and none can
    arise where a part and a sentinel meet, as "<" is only their first sign."""
    if form == "plain":
        return [(TEXT, 0, len(output))] if output else []
    parts: list[list[Piece]] = [[], [], []]
    marks = []
    at = 0
    for sentinel, _ in ORDER[form]:
        at = output.index(sentinel, at)
        marks.append((at, at + len(sentinel)))
        at += len(sentinel)
    for k, (_, part) in enumerate(ORDER[form]):
        start, end = marks[k][1], marks[k + 1][0] if k + 1 < len(marks) else len(output)
        parts[part] = [(TEXT, start, end - start)] if end > start else []
    return [p for part in parts for p in part]


def fill_in_middle(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``docs`` with the columns output, form, n_units, prefix_chars and
    middle_chars in place of any of these names."""
    rules = rules or Rules()

    @F.udf("struct<output string, form string, n_units long, prefix_chars long, middle_chars long>", useArrow=True)
    def transform(doc_id, text):
        text = text or ""
        n, form, a, b, pieces = rules.arrange(doc_id, text)
        return "".join(stream(pieces, (text, SENTINELS))), form, n, a, b

    made = docs.withColumn("_made", transform(F.col("doc_id").cast("long"), "text"))
    names = ("output", "form", "n_units", "prefix_chars", "middle_chars")
    return made.select(*[c for c in docs.columns if c not in names], *[F.col(f"_made.{c}").alias(c) for c in names])


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (output, form) with the column restored."""

    @F.udf("string", useArrow=True)
    def undo(output, form):
        return "".join(stream(restored(output, form), (output, SENTINELS)))

    return outputs.withColumn("restored", undo("output", "form"))


def digests(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Per row: units, form, sizes, the hash of the output's descriptors, and
    the hash of the text rebuilt from the rendered output."""
    rules = rules or Rules()

    def work(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                text = text or ""
                n, form, a, b, pieces = rules.arrange(doc_id, text)
                buffers = text, SENTINELS
                output = "".join(stream(pieces, buffers))
                rows.append((doc_id, n, form, a, b, digest(pieces, buffers), digest(restored(output, form), (output, SENTINELS))))
            yield rows

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, RESULT, SLICE)
