"""Token counts by a count-only Viterbi over a unigram vocabulary (operator 6).

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
character; the recurrence carries only the best score and the piece count up
to there, no path. Ties follow the unigram tokenizer: a candidate replaces
the best one only when its score is strictly higher, candidates coming in
order of their start. A character that no piece spells costs the lowest
score less 10 and counts as its UTF-8 bytes (byte fallback).

Pieces and scores come from a given sentencepiece file, as they stand; all
its pieces are vocabulary strings. The text gets one leading word mark and
spaces become word marks. Pieces never continue past the start of a word, so
texts are cut there and a word's result is reused.

Defined cases: null or empty text has 0 tokens; repeated rows and null ids
are returned as they are; whole texts are counted, however long.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from tessera.llm.common import map_batches

UNKNOWN_PENALTY = 10.0
MARK = "\u2581"
MEMO_WORDS, MEMO_CHARS = 300_000, 48


def load_vocabulary(model_file: str) -> list[tuple[str, float]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = dict(vocabulary)
        if any(MARK in p.lstrip(MARK) for p in self.pieces) or any("\n" in p for p in self.pieces):
            raise ValueError("a piece continues past the start of a word")
        self.unknown = min(self.pieces.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cut = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, chunk: str) -> tuple[int, float]:
        """Piece count and score of the best segmentation of one chunk."""
        score, count = [0.0] * (len(chunk) + 1), [0] * (len(chunk) + 1)
        matches, known = self.automaton.iter(chunk), self.pieces
        at, (length, gain) = next(matches, (-1, (0, 0.0)))
        for end, char in enumerate(chunk):
            top = None
            while at == end:  # longest piece, so earliest start, first
                total = score[end + 1 - length] + gain
                if top is None or total > top:
                    top, n = total, count[end + 1 - length] + 1
                at, (length, gain) = next(matches, (-1, (0, 0.0)))
            if char not in known:
                total = score[end] + self.unknown
                if top is None or total > top:
                    top, n = total, count[end] + len(char.encode())
            score[end + 1], count[end + 1] = top, n
        return count[-1], score[-1]

    def tokens(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        total, score, memo = 0, 0.0, self.memo
        for chunk in self.cut.findall(MARK + text.replace(" ", MARK)):
            found = memo.get(chunk)
            if found is None:
                found = self.best(chunk)
                if len(chunk) <= MEMO_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[chunk] = found
            total += found[0]
            score += found[1]
        return total, score


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, n_tokens, best_score) of every row. The vocabulary, a fixed
    table of some 10^4 strings, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.tokens(t) for t in batch.text]
            yield {"doc_id": batch.doc_id, "n_tokens": [n for n, _ in found], "best_score": [s for _, s in found]}

    return map_batches(docs.select("doc_id", "text"), count, "doc_id long, n_tokens long, best_score double")
