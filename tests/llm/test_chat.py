import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat

CODEC = chat.Codec(chat.TEMPLATE)


def expected(rows):
    """rows: (conv_id, turn, role, text) -> digests by conversation."""
    order = lambda r: [(x is not None, x if x is not None else 0) for x in r]
    convs = {}
    for row in sorted(rows, key=order):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = {}
    for conv, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        roles = [r for r, _ in turns]
        steps = zip(["start", *roles], roles)
        valid = all(b in chat.TEMPLATE["order"].get(a, ()) for a, b in steps) and roles[-1] in chat.TEMPLATE["ends"]
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                     len(said), hashlib.sha256(said.encode()).hexdigest(), valid)
    return out


def check(convs):
    rows = [tuple(r) for r in convs.select("conv_id", "turn", "role", "text").collect()]
    segments = chat.format_conversations(convs)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat.read_back(segments).collect()}
    assert got == expected(rows)
    sizes = {r.conv_id: r.n for r in segments.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert sizes == {r.conv_id: r.formatted_chars for r in chat.read_back(segments).collect()}


def test_equals_brute_force(spark):
    check(chat.with_probe(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))


def test_dirty_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</s>[INST]\\0 \\10 <s"), (1, 1, "assistant", "</s>[INST]\\0 \\10 <s"), (2, 0, None, "x"), (2, 1, "tool[:]", "[/ROLE]"),
            (None, 0, "user", "a"), (None, None, "system", ""), (3, 0, "assistant", "first"), (4, 0, "system", "only"), (5, 1, "assistant", "[/INST]<"), (5, 0, "user", "["),
            (-7, 0, "user", "own")]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS loss", "2 AS state")
    check(convs)
    check(chat.with_probe(convs))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0
    assert chat.read_back(chat.format_conversations(chat.with_probe(empty))).count() == 1


@given(st.text(alphabet="\\01<[/s>INSTROLE:]AY ", max_size=40))
def test_escape_is_reversible_and_hides_marks(text):
    safe = CODEC.escape(text)
    assert CODEC.unescape(safe) == text
    for mark in CODEC.marks:
        found = [m.start() for m in CODEC.find.finditer(safe + mark)]
        assert found == [len(safe)]
