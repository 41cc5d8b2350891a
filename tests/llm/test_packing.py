import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


def pieces_of(rows):
    own, out = Tokenizer.from_file(FILE), []
    for doc_id, text in rows:
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        lengths = [len(ids) % 2048 or 2048] + [2048] * ((len(ids) - 1) // 2048)
        start = 0
        for k, n in enumerate(lengths):
            out.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            start += n
        assert start == len(ids)
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = packing.best_fit_packing(docs, FILE).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == pieces_of(rows)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins), -(-sum(r.length for r in got) // 2048)


def test_whole_and_near_the_bound(docs):
    n, bound = check(docs)
    assert n <= bound + 1


def test_dirty_rows(dirty):
    check(dirty)


def test_empty_table(empty):
    assert packing.best_fit_packing(empty, FILE).count() == 0


def test_special_strings_are_the_tokenizers_own(spark):
    check(spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|endoftext|"), (3, "\u00a0\u0000 \n\n  x"), (4, "🙂" * 50)], "doc_id long, text string"))


def test_search_is_no_worse_than_best_fit(spark):
    rng = random.Random(1)
    for seed in range(3):
        size = sorted((rng.randint(200, 1400) for _ in range(300)), reverse=True)
        start = ([], [])
        packing.best_fit(*start, range(len(size)), size, 2048)
        bins, free = packing.evolve(size, [], 2048, seed)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert [2048 - sum(size[i] for i in b) for b in bins] == free and min(free) >= 0
        assert len(bins) <= len(start[0])


def test_crossover_keeps_every_piece_once():
    rng = random.Random(5)
    size = [rng.randint(1, 2000) for _ in range(120)]
    one, two = ([], []), ([], [])
    packing.best_fit(*one, range(120), size, 2048)
    two = packing.mutate(one, size, 2048, rng)
    for _ in range(20):
        child = packing.crossover(one, two, size, 2048, rng)
        assert sorted(i for b in child[0] for i in b) == list(range(120))
        assert all(sum(size[i] for i in b) + f == 2048 for b, f in zip(*child))
        one, two = two, child
