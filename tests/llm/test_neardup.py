from collections import Counter, defaultdict

from tessera.llm import neardup


def brute_components(rows):
    """doc_id -> component over (doc_id, text) rows, by exact set similarity."""
    sets = [set(neardup.shingles(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, k in common.items():
            if 100 * k >= 75 * len(s | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((d, n, c, d == c) for d, n, c in brute_components(rows)), key=repr)
    assert sorted((tuple(r) for r in neardup.near_duplicates(docs).collect()), key=repr) == want


def test_equals_brute_force(docs):
    check(docs)


def test_dirty_rows(dirty):
    check(dirty)


def test_empty_table(empty):
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_one(empty).columns == empty.columns


def test_shingles_follow_the_contract():
    assert len(neardup.shingles("A b\x0bC d e f")) == 1  # a no-break space is part of a word
    assert (neardup.shingles("A B c d e") == neardup.shingles("a  b\tc\nd e ")).all()
    assert (neardup.shingles("É b") != neardup.shingles("é b")).all()
    assert len(neardup.shingles(" \n")) == 0 and len(neardup.shingles("x")) == 1


def test_large_group_of_variants_branches(spark):
    """A group far above what one node compares at once: a base, variants at
    different distances, some linked with the base alone, and texts that only
    share a passage."""
    import random

    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for d in range(1, 400):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(1, 6)):
            words[at] = f"e{d}-{at}"
        rows.append((d, " ".join(words)))
    rows += [(1000 + d, " ".join(base[:30] + [f"o{d}-{i}" for i in range(90)])) for d in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))


def test_keep_one_leaves_one_row_a_group(dirty):
    kept = neardup.keep_one(dirty)
    assert kept.columns == dirty.columns
    texts = [(r.doc_id, r.text and r.text[:20]) for r in kept.collect()]
    assert len([t for t in texts if t[1] and t[1].startswith("The quick")]) >= 1
    assert {t[0] for t in texts if not t[1]} == {1, 2, None}
    assert neardup.near_duplicates(kept).where("n_shingles > 0 AND NOT kept").count() == 0


def test_keep_one_leaves_exactly_one_row_of_repeated_rows(spark, dirty):
    rows = [(r.doc_id, r.text) for r in neardup.keep_one(dirty).collect()]
    worded = [r for r in rows if r[1] and r[1].strip()]
    assert len(worded) == len(set(worded))
    text = "alpha " + " ".join(f"n{i}" for i in range(20))
    rows = [(None, text, "a"), (None, text, "a"), (None, text + " eta", "b"), (5, "one two three four five six", "c")]
    rows += [(5, "one two three four five six", s) for s in "cde"] + [(5, "six words under the same id", "f"), (8, None, "g"), (8, None, "g")]
    found = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in found) == [(0, "alp"), (5, "one"), (5, "six"), (8, ""), (8, "")]
