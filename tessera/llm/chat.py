"""Chat formatting with a role automaton and loss flags (operator 9).

``format_conversations`` turns each conversation into segments (text, loss)
under a declarative template; ``read_back`` parses the formatted segments
alone and recovers the turns. Control strings inside texts are escaped
reversibly: the escape character becomes ``\\0`` and the first character of
anything that reads as a control string (or as the start of one at the end
of a text) becomes ``\\1`` plus its number among the first characters.

The rows of a conversation meet in one sorted stream: a task holds the state
of one conversation (automaton state, running digests), never its rows, so a
conversation of any length passes in constant memory.

Defined cases: null text or role is empty; roles the template does not name
are formatted with the ``other`` marks, without loss, and make the
conversation invalid; a null conv_id is a conversation of its own; turns are
ordered by (turn, role, text), nulls first, and repeated rows are repeated
turns; extra columns are ignored; an empty table gives no segments.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches

#: role -> opening mark, closing mark, whether its text is under the loss
TEMPLATE = {
    "roles": {
        "system": ("[SYS]", "[/SYS]", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True),
    },
    "other": ("[ROLE]", "[:]", "[/ROLE]"),
    # state -> roles that may follow; "start" is the first state, a role's name the state after it
    "order": {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    # states in which a conversation may end
    "ends": ("user", "assistant"),
}
SEGMENTS = "conv_id long, turn_no long, segment_no int, text string, loss boolean, valid_so_far boolean"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


class Codec:
    """Escaping, its inverse and the tokens of a template."""

    def __init__(self, template: dict):
        marks = [m for spec in template["roles"].values() for m in spec[:2]] + list(template["other"])
        self.marks = sorted(set(marks), key=len, reverse=True)
        self.firsts = sorted({m[0] for m in marks})
        self.find = re.compile("|".join(map(re.escape, self.marks)))
        starts = {f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in marks}
        # a text's end must not read as a start together with the mark after it
        starts |= {rf"{re.escape(m[0])}(?={re.escape(m[1:k])}\Z)" for m in marks for k in range(1, len(m))}
        self.unsafe = re.compile("|".join([r"\\", *sorted(starts)]))
        self.back = re.compile(r"\\(?:0|1(\d))")

    def escape(self, text: str) -> str:
        return self.unsafe.sub(lambda m: "\\0" if m[0] == "\\" else f"\\1{self.firsts.index(m[0])}", text)

    def unescape(self, text: str) -> str:
        return self.back.sub(lambda m: self.firsts[int(m[1])] if m[1] else "\\", text)


def _runs(batches, columns):
    """Rows of a sorted stream as tuples, with whether the conversation is new."""
    last: object = ()
    for batch in batches:
        for row in zip(*(getattr(batch, c) for c in columns)):
            yield (last == () or row[0] != last), row[0], row[1:]
            last = row[0]


def _chunks(rows, size=5000):
    while held := list(islice(rows, size)):
        yield held


def format_conversations(convs: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Segments (conv_id, turn_no, segment_no, text, loss, valid_so_far), each
    conversation's together and in order within its partition."""

    def rows(batches):
        codec, order = Codec(template), template["order"]
        state, turn_no, valid = "start", 0, True
        for new, key, (role, text) in _runs(batches, ("conv_id", "role", "text")):
            role, text = role or "", text or ""
            if new:
                state, turn_no, valid = "start", 0, True
            valid = valid and role in order.get(state, ())
            state = role
            if role in template["roles"]:
                start, end, loss = template["roles"][role]
                parts = [(start, False), (codec.escape(text), loss), (end, False)]
            else:
                start, colon, end = template["other"]
                parts = [(start, False), (codec.escape(role), False), (colon, False), (codec.escape(text), False), (end, False)]
            for k, (part, loss) in enumerate(parts):
                yield key, turn_no, k, part, loss, valid
            turn_no += 1

    turns = convs.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_batches(turns.select("conv_id", "role", "text"), lambda b: _chunks(rows(b)), SEGMENTS)


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row a conversation, from the formatted segments alone. ``segments``
    come as format_conversations leaves them: together and in order."""

    def rows(batches):
        codec = Codec(template)
        opens = {spec[0]: role for role, spec in template["roles"].items()}
        closes = {spec[1] for spec in template["roles"].values()} | {template["other"][2]}
        key = turns = None
        for new, at, (text, loss, good) in _runs(batches, ("conv_id", "text", "loss", "valid_so_far")):
            if new:
                if turns is not None:
                    yield key, n, turns.hexdigest(), chars, under.hexdigest(), total, valid and role in template["ends"]
                key, n, chars, total, valid = at, 0, 0, 0, True
                turns, under = hashlib.sha256(), hashlib.sha256()
                role, said, named = "", [], True
            total += len(text)
            valid = valid and bool(good)
            if loss:
                plain = codec.unescape(text)
                under.update(plain.encode())
                chars += len(plain)
            done = 0
            for mark in [*codec.find.finditer(text), None]:
                said.append(text[done : mark.start() if mark else len(text)])
                if mark is None:
                    break
                done = mark.end()
                if mark[0] in opens:
                    role, said = opens[mark[0]], []
                elif mark[0] == template["other"][0]:
                    role, said = "", []
                elif mark[0] == template["other"][1]:
                    role, said = codec.unescape("".join(said)), []
                elif mark[0] in closes:
                    turns.update(f"{role}\n{codec.unescape(''.join(said))}\n".encode())
                    n, said = n + 1, []
        if turns is not None:
            yield key, n, turns.hexdigest(), chars, under.hexdigest(), total, valid and role in template["ends"]

    return map_batches(segments.select("conv_id", "text", "loss", "valid_so_far"), lambda b: _chunks(rows(b)), DIGEST)


def with_probe(convs: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = convs.sparkSession.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return convs.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
