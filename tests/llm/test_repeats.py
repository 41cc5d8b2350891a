import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import repeats, words as parts

WINDOW = 35


def words(text):
    return (text or "").encode().split()


def brute(rows):
    held = [words(t) for _, t in rows]
    times = Counter(tuple(w[k : k + WINDOW]) for w in held for k in range(len(w) - WINDOW + 1))
    out = []
    for (doc_id, _), w in zip(rows, held):
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if times[tuple(w[k : k + WINDOW])] > 1:
                gone.update(range(k, k + WINDOW))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs):
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in repeats.dedup_windows(docs).collect()), key=repr) == want
    return sum(r[2] for r in want)


def test_equals_brute_force(docs):
    assert check(docs) > 0


def test_dirty_rows(dirty):
    assert check(dirty) > 0


def test_borders_overlaps_and_periods(spark):
    rng = random.Random(1)
    few = [rng.choice("ab") for _ in range(900)]
    wide = [f"w{rng.randrange(500)}" for _ in range(900)]
    texts = [
        " ".join(["a"] * 34), " ".join(["b"] * 35), " ".join(["c"] * 36), " ".join(few), " ".join(few[50:85]), " ".join(few[51:85]),
        " ".join(wide), "\n".join(wide[100:135]), "\t ".join(wide[200:236] + ["x"]), " ".join(["y", *wide[300:334]]), " ".join(wide[400:470] + ["z"] + wide[470:520]),
        "é " + " ".join(wide[600:640]), " " + " ".join(["A"] + wide[700:735]), " ".join([w.upper() for w in wide[:80]])]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_long_texts_and_full_sketches(spark, docs, monkeypatch):
    """Texts read in several slices, several sketches a task, and a sketch so
    full that nearly every window is estimated repeated."""
    monkeypatch.setattr(repeats, "SLICE", 4096)
    monkeypatch.setattr(parts, "PART", 2048)
    monkeypatch.setattr(repeats, "HELD", 5000)
    monkeypatch.setattr(repeats, "CELLS", 1 << 10)
    monkeypatch.setattr(repeats, "LEAST", 1 << 11)
    monkeypatch.setattr(repeats, "MOST", 1 << 12)
    monkeypatch.setattr(repeats, "SMALL_ROWS", 0)
    monkeypatch.setattr(repeats, "NAMES", 0)
    assert check(docs.repartition(5)) > 0


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 2000)
    monkeypatch.setattr(parts, "PART", 2000)
    rng = random.Random(5)
    long = ["".join(rng.choice("01") for _ in range(n)) for n in (400, 600, 1999, 2000, 2001, 9000)]
    plain = [f"v{rng.randrange(90)}" for _ in range(300)]
    texts = [" ".join(plain[:100] + long + plain[100:]), " \n ".join(plain[90:100] + long + plain[100:130]), "  " + "\t".join(long * 20) + "  ",
             " ".join(plain[90:100] + long[:-1] + [long[-1] + "1"] + plain[100:130]), long[-1]]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_many_copies_and_no_room_for_their_names(spark, docs, monkeypatch):
    some = docs.limit(30)
    many = some.unionByName(some).unionByName(some).unionByName(docs)
    check(many.repartition(3))
    monkeypatch.setattr(repeats, "SMALL_ROWS", 2)
    check(many.repartition(3))


def test_estimates_never_fall_below_counts(spark, docs):
    texts = repeats.named(docs).withColumn("copy", F.lit(False))
    width = repeats.sketch_width(texts)
    bits = repeats.gather(repeats.merged_sketch(repeats.partial_sketches(texts, width)), width)
    import numpy as np

    found = [x for x in repeats.windows([r.text for r in docs.collect()], repeats.Words(), 1)]
    names = np.concatenate([x[2] for x in found])
    _, which, times = np.unique(names, return_inverse=True, return_counts=True)
    said = repeats.estimated_repeated(names, bits, width)
    assert said[times[which] > 1].all()
    assert said[times[which] == 1].mean() < 0.1


def test_kept_words_and_texts(spark, docs):
    rows = {(r.doc_id, r.n_words, r.n_removed): r.text for r in repeats.without_repeats(docs).collect()}
    for r in repeats.dedup_windows(docs).collect():
        assert hashlib.sha256(rows[r.doc_id, r.n_words, r.n_removed].encode()).hexdigest() == r.kept_sha256


def test_empty_table(empty):
    assert repeats.dedup_windows(empty).count() == 0


def test_python_gets_bounded_batches(spark, monkeypatch):
    """Long rows come by the bytes, not by 10000; the setting is as before afterwards."""
    from tessera.llm import common

    plain, sizes = repeats.map_batches, []

    def watched(df, work, schema, *rest):
        def measure(batches):
            for batch in batches:
                yield type(batch).from_pydict({"n": [batch.nbytes]})

        sizes.extend(r.n for r in df.mapInArrow(measure, "n long").collect())
        return plain(df, work, schema, *rest)

    rows = [(k, " ".join(f"w{k}x{j}" for j in range(20_000))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(repeats, "map_batches", watched)
    before = spark.conf.get(common.BATCH_BYTES, None)
    found = repeats.dedup_windows(docs).collect()
    assert spark.conf.get(common.BATCH_BYTES, None) == before
    assert len(found) == 60 and not any(r.n_removed for r in found)
    assert 0 < max(sizes) <= 2 * repeats.BATCH
