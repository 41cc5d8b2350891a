import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n, name = len(units), sha("42:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(name[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def check(docs):
    want = sorted((brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted((tuple(r) for r in middle.digests(docs).collect()), key=repr) == want
    return {r[2] for r in want}


def test_equals_brute_force(docs):
    assert check(docs) == {"plain", "spm", "psm"}


def test_dirty_rows(dirty):
    check(dirty)


def test_sentinels_blanks_and_wide_characters(spark):
    texts = ["<P> here", "a <S>", "x<M>", "<", "< P>", "a<", "<<", "<P", "P>", " ", "\n\n", " lead", "trail ", "𝄞 é ü 𝄞", "a\x00b", "one"]
    rows = [(100 * k + j, t) for k, t in enumerate(texts) for j in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_texts_go_out_and_come_back(spark, docs):
    made = middle.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "output", "form", "n_units", "prefix_chars", "middle_chars"]
    back = middle.restore(made)
    assert back.where("restored <> coalesce(text, '')").count() == 0
    assert back.where("form <> 'plain' AND output = text").count() == 0
    want = {(r.doc_id, r.output_sha256) for r in middle.digests(docs).collect()}
    assert {(r.doc_id, sha(r.output)) for r in made.collect()} == want


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 7)], "doc_id long, text string, form string, output int")
    made = middle.fill_in_middle(docs)
    assert len(set(made.columns)) == len(made.columns) == 7
    assert middle.restore(made).first().restored == "a b c"


def test_other_rules(spark, docs):
    made = middle.fill_in_middle(docs, middle.Rules(seed=7, rate=100, spm=0))
    assert made.where("form = 'spm'").count() == 0
    assert made.where("form = 'plain' AND length(text) > 0 AND NOT text RLIKE '<[PSM]>'").count() == 0


def test_empty_table(empty):
    assert middle.digests(empty).count() == 0
    assert middle.fill_in_middle(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab<PSM> \n>é𝄞", max_size=60), st.integers(0, 1 << 40))
def test_round_trip(text, doc_id):
    rules = middle.Rules(rate=100)
    n, form, a, b, pieces = rules.arrange(doc_id, text)
    assert n == len(UNITS.findall(text))
    out = "".join(middle.stream(pieces, (text, middle.SENTINELS)))
    assert "".join(middle.stream(middle.restored(out, form), (out, middle.SENTINELS))) == text


@given(st.text(max_size=30), st.integers(0, 30), st.integers(0, 30))
def test_cutting_splits_descriptors_only(text, a, b):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    left, rest = middle.split_at([(0, 0, len(text))] if text else [], a)
    mid, right = middle.split_at(rest, b - a)
    assert ["".join(middle.stream(p, (text, ""))) for p in (left, mid, right)] == [text[:a], text[a:b], text[b:]]
    assert all(n > 0 for p in (left, mid, right) for _, _, n in p)
