import re
from collections import Counter, defaultdict

import numpy as np

from tessera.llm import quality, words
from tessera.llm.words import Words, all_codes


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def rows_of(found):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found.collect()), key=repr)


def test_base_metrics_and_scores_equal_brute_force(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = quality.quality(docs, labels)
    assert rows_of(found) == sorted(((d, *base(t)) for d, t in rows), key=repr)
    model = quality.fit(docs, labels)
    for r in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", dict(rows)[r.doc_id])
        ones = [bucket(w) for w in words]
        twos = [bucket(*p) for p in zip(words, words[1:])]
        assert abs(r.score - np.mean(model.ratios[ones + twos])) < 1e-9
        each = [model.odds[bucket(x)] + model.odds[quality.BUCKETS + beginning(x)] for x in words]
        width = min(100, len(words))
        toxic = max(sum(each[k : k + width]) for k in range(len(words) - width + 1)) / 100
        assert abs(r.toxic_score - toxic) < 1e-9
        assert r.kept == (not r.base_failed and r.score >= model.least and r.toxic_score <= model.most)


WORDS = Words()


def bucket(*words):
    """The bucket of a 1-gram or 2-gram."""
    if isinstance(words[0], bytes):  # maybe half a character
        return int(quality.ngram_buckets(WORDS.codes(words[0], 1)[1][0])[-1])
    return int(quality.ngram_buckets(all_codes(" ".join(words), WORDS))[-1])


def beginning(word):
    return bucket(word.encode()[:5]) if len(word.encode()) > 5 else bucket(word)


def test_counts_cover_every_row(spark, docs):
    got = {r.bucket: r[1:] for r in quality.corpus_counts(docs, {0, 1}, {1, 5}).collect()}
    want = defaultdict(lambda: [0, 0, 0, 0])
    for r in docs.collect():
        words = (r.text or "").split()
        own = Counter([bucket(w) for w in words] + [bucket(*p) for p in zip(words, words[1:])])
        for b, n in own.items():
            want[b][0] += n
            want[b][1] += n * (r.doc_id in (0, 1))
        for b in {bucket(w) for w in words} | {quality.BUCKETS + beginning(w) for w in words}:
            want[b][2] += 1
            want[b][3] += r.doc_id in (1, 5)
    assert got == {b: tuple(n) for b, n in want.items()}


def test_odds_need_rows_and_a_ratio():
    raw, toxic = np.zeros(2 * quality.BUCKETS), np.zeros(2 * quality.BUCKETS)
    raw[:5], toxic[:5] = [5000, 50, 1000, 50, 5000], [3, 3, 20, 2, 20]
    odds = quality.toxic_odds(raw, toxic, 20)
    assert (odds[:5] > 0).tolist() == [False, True, True, False, False] and not odds[5:].any()
    assert not quality.toxic_odds(raw, toxic * 0, 0).any()


def test_separates_labels_of_a_small_sample(spark):
    """Some 350 labelled rows: 18 toxic ones fit, so toxic rows are caught in part."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.quality(docs, labels).where("NOT base_failed").join(labels, "doc_id").toPandas()
    good, bad = judged[(judged.quality == 1) & (judged.toxic == 0)], judged[judged.quality == 0]
    print(f"kept: good {good.kept.mean():.4f}, bad {bad.kept.mean():.4f}, toxic {judged[judged.toxic == 1].kept.mean():.4f}")
    assert good.kept.mean() >= 0.99 and bad.kept.mean() <= 0.1


def test_dirty_rows(spark, dirty, empty):
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, None), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text) for r in dirty.collect()]
    assert rows_of(quality.quality(dirty, labels)) == sorted(((d, *base(t)) for d, t in rows), key=repr)
    none = labels.limit(0)
    found = quality.quality(dirty, none)
    assert found.where("kept = base_failed").count() == 0
    assert quality.quality(empty, labels).count() == 0
    kept = quality.keep(dirty, none)
    assert kept.columns == dirty.columns and kept.count() == found.where("kept").count()


def test_threshold():
    cut = quality.threshold(np.array([1.0, 2.0, 3.0]), np.array([-2.0, -1.0]))
    assert -1 < cut < 1
    assert quality.threshold(np.array([]), np.array([1.0])) == -np.inf
    good = np.concatenate([np.full(999, 1.0), [-5.0]])
    assert quality.threshold(good, np.full(1000, -4.0)) > -4


def held_out(spark, sf):
    """Judged rows of the third of the labels that neither fits nor sets cuts."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    last = [d for d, *_ in quality.labelled(labels)[2::3]]
    judged = quality.quality(docs, labels).where("NOT base_failed").join(labels, "doc_id").toPandas()
    return judged[judged.doc_id.isin(last)]


def test_held_out_rows(spark):
    held = held_out(spark, "sf0.1")
    good, bad = held[(held.quality == 1) & (held.toxic == 0)], held[held.quality == 0]
    toxic = held[(held.quality == 1) & (held.toxic == 1)]
    print(f"kept: good {good.kept.mean():.4f} of {len(good)}, bad {bad.kept.mean():.4f} of {len(bad)}, toxic {toxic.kept.mean():.4f} of {len(toxic)}")
    assert good.kept.mean() >= 0.99 and bad.kept.mean() <= 0.05 and toxic.kept.mean() <= 0.1


def test_toxic_score():
    each = np.zeros(quality.WINDOW + 30)
    each[[0, -2, -1]] = 2.0, 3.0, 1.0
    assert quality.toxic_score(each) == 4.0 / quality.WINDOW
    assert quality.toxic_score(each[-5:]) == 4.0 / quality.WINDOW
    assert quality.toxic_score(each[:0]) == 0.0


def test_long_texts_in_parts_give_the_same(monkeypatch):
    text = " ".join(f"wörd{i}" for i in range(900)) + " " + "x" * 3000 + " end"
    whole = all_codes(text, WORDS).tolist(), quality.word_buckets(text, all_codes(text, WORDS), WORDS)[1].tolist()
    monkeypatch.setattr(words, "PART", 1000)
    few = words.Words()
    codes = all_codes(text, few)
    assert len(codes) == 902 and codes.tolist() == whole[0] and quality.word_buckets(text, codes, few)[1].tolist() == whole[1]


def test_every_label_takes_part(spark):
    """More labels than any sample: all have a place, and cuts of a table are those of the arrays."""
    from tessera.session import Scratch

    scratch = Scratch(spark)
    labels = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 5 > 0 AS INT) AS quality", "CAST(id % 11 = 0 AS INT) AS toxic")
    places = quality.placed(labels, scratch).toPandas()
    assert sorted(places.place) == list(range(30_000)) and sorted(places.doc_id) == list(range(30_000))
    judged = labels.selectExpr("round(sin(doc_id) + 2 * quality, 3) AS score", "quality = 1 AND toxic = 0 AS good", "quality = 0 AS bad")
    rows = judged.repartition(7).toPandas()
    for some in (judged, judged.where("score > 2.9 OR bad"), judged.where("good").limit(3), judged.where("bad")):
        rows = some.toPandas()
        assert quality.cut_of(some, "score", "bad", scratch) == quality.threshold(rows[rows.good].score.to_numpy(), rows[rows.bad].score.to_numpy())


def test_the_fit_reads_the_table_of_labels(spark, monkeypatch):
    """No list of labelled rows in the driver."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    monkeypatch.setattr(quality, "labelled", None)
    model = quality.fit(docs, labels)
    monkeypatch.setattr(quality, "SMALL_ROWS", 0)  # the same by shuffled joins
    again = quality.fit(docs, labels)
    assert (model.ratios == again.ratios).all() and (model.odds == again.odds).all() and (model.least, model.most) == (again.least, again.most)
