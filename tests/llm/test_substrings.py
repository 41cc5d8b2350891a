import hashlib

from tessera.llm import substrings


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    seen, many = set(), set()
    for b in data:
        for k in range(len(b) - 199):
            (many if b[k : k + 200] in seen else seen).add(b[k : k + 200])
    out = []
    for (doc_id, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if b[k : k + 200] in many:
                gone[k : k + 200] = b"\1" * 200
        spans = bytes(gone).count(b"\0\1") + (gone[:1] == b"\1")
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert sorted((tuple(r) for r in substrings.dedup_substrings(docs).collect()), key=repr) == want
    return sum(r[2] for r in want)


def test_equals_brute_force(docs):
    assert check(docs) > 0


def test_dirty_rows(dirty):
    assert check(dirty) > 0


def test_overlaps_periods_and_borders(spark):
    import random

    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(1500))
    wide = "".join(rng.choice("abcdefgh") for _ in range(1500))
    rows = [(1, "a" * 199), (2, "b" * 200), (3, "c" * 201), (4, "ab" * 300), (5, text), (6, text[100:300]), (7, text[101:300]), (8, "x" + text[700:]),
            (9, wide + wide), (10, wide[:199] + "!" + wide[200:]), (11, "é" * 99 + wide[:1]), (12, "é" * 150), (13, "q" + "é" * 150)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_long_texts_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 300)
    import random

    rng = random.Random(4)
    one = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, one), (2, one[:1500] + "#" + one[1500:]), (3, one[777:1400])]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_empty_table(empty):
    assert substrings.dedup_substrings(empty).count() == 0
