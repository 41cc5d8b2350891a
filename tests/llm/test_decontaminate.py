import hashlib
import re
from collections import defaultdict

from tessera.llm import decontaminate

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TABLE))


def brute(docs, items):
    wins = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(10, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            wins[tuple(own[k : k + size])] |= {str(item)} if item is not None else set()
    sizes, out = {len(w) for w in wins}, []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in wins:
                    hit.update(range(k, k + size))
                    found |= wins[tuple(own[k : k + size])]
        name = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), name, bool(hit)))
    return sorted(out, key=repr)


def check(docs, bench):
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    got = decontaminate.decontaminate(docs, bench)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def test_equals_brute_force(spark, docs):
    want = check(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    assert any(r[5] for r in want)


def test_dirty_rows_and_items(spark, dirty):
    bench = spark.createDataFrame(
        [(1, "Fox jumps over THE lazy dog"), (2, "fox, jumps; over the lazy dog"), (3, None), (4, ""), (5, "wizards"),
         (6, " ".join(f"w{i}" for i in range(500, 530))), (None, "brown fox"), (10, "two"), (7, "İé K"), (7, "nobody has this item")],
        "item_id long, text string").selectExpr("*", "1 AS win", "2 AS token")
    want = check(dirty, bench)
    assert any(r[3] >= 2 for r in want)


def test_case_rule_is_ascii_only(spark):
    docs = spark.createDataFrame([(1, "É B"), (2, "é b"), (3, "É b"), (4, "K b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "é B"), (2, "k b")], "item_id long, text string")
    check(docs, bench)


def test_blocks_give_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 200)
    check(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench).where("contaminated").count() == 0
    assert decontaminate.clean(docs, bench).count() == docs.count()


def test_clean_removes_contaminated_rows(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.decontaminate(docs, bench).where("contaminated").collect()}
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - hit


def test_no_python_in_the_plan(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = decontaminate.decontaminate(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
