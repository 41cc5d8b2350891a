import math
import re
from collections import Counter

import pytest

from tessera.llm import search

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(TABLE))


def brute(docs, items):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        own, found = terms(text), []
        for d, tf, n in held:
            if not n:
                continue
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in own if tf[t])
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(found[:10])]
    return sorted(out, key=repr)


def check(docs, bench):
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert sorted((tuple(r) for r in search.ranked_search(docs, bench).collect()), key=repr) == want
    return want


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(1, "quick fox FOX fox é"), (2, "w1 w2 w3 w29999"), (3, None), (4, ""), (5, "!!"), (None, "two"), (6, "nobodyhasthis"), (7, "line the lazy"), (8, "x" * 700)],
        "item_id long, text string").selectExpr("*", "1 AS item", "2 AS rank", "3 AS score")


def test_equals_brute_force(docs, bench):
    assert len(check(docs, bench)) > 0


def test_dirty_rows_and_items(dirty, odd):
    check(dirty, odd)


def test_ties_go_by_doc_id_and_nulls_last(spark):
    docs = spark.createDataFrame([(9 - k if k < 9 else None, "same text here") for k in range(14)] + [(50, "other")], "doc_id long, text string")
    got = check(docs.repartition(4), spark.createDataFrame([("a", "text"), ("b", "other other")], "item_id string, text string"))
    assert [r[2] for r in got if r[0] == "a" and r[1] <= 2] == [1, 2] and len(got) == 11


def test_blocks_small_steps_and_many_tasks_give_the_same(docs, bench, monkeypatch):
    monkeypatch.setattr(search, "INDEX_BYTES", 3000)
    monkeypatch.setattr(search, "CELLS", 100)
    monkeypatch.setattr(search, "POSTINGS", 50)
    monkeypatch.setattr(search, "TASKS", 2)
    monkeypatch.setattr(search, "SLICE", 5000)
    assert search.blocks(bench)[1] > 1
    check(docs.repartition(6), bench)


def test_integer_sums_beyond_doubles(docs, bench, monkeypatch):
    monkeypatch.setattr(search, "EXACT", 0)
    check(docs, bench)


def test_lengths_beyond_64_bits():
    import numpy as np

    sizes = np.array([3, 1 << 40], np.int64)
    assert search.length_terms(sizes, 1 << 40, 1 << 50).tolist() == [25 + 75 * int(n) * (1 << 40) // (1 << 50) for n in sizes]


def test_empty_tables(docs, bench, empty):
    assert search.ranked_search(empty, bench).count() == 0
    assert search.ranked_search(docs, bench.limit(0)).count() == 0
