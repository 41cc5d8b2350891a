"""Best-fit packing by a grouping genetic algorithm (operator 3).

Every document becomes token ids plus one end id; only longer ones are cut
into full pieces, with the remainder first. Full pieces are sequences of
their own. The others are packed by islands: an island is a bounded, hashed
share of the pieces with a population of packings of its own. Crossover
injects whole well-filled bins of one parent into the other, drops the bins
that hold duplicates and best-fits the displaced pieces; the grouping fitness
rewards full bins. Between epochs elites migrate: the bins of an island's
elite that are nearly full become sequences, the others travel as bins to an
island of the next epoch, which starts from them and from the pieces they
hold. Islands keep about ISLAND pieces each, so their number grows with the
input, and no island sees more.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed once each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches
from tessera.session import Scratch

CAPACITY = 2048
END_ID = 0
ISLAND = 2000
POPULATION, CHILDREN = 6, 24
NEARLY_FULL = 4  # free tokens of a bin that leaves with an elite
EPOCHS = 3
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", island long, bin long, offset long, free long"


def byte_table() -> dict[str, int]:
    """Printable stand-in -> byte, the rule of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE tokenizer file. tiktoken runs the same merges
    several times faster; texts with a special token's string go to the
    tokenizer itself, which treats them its own way."""

    def __init__(self, file_text: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec, table = json.loads(file_text), byte_table()
        self.special = [x["content"] for x in spec["added_tokens"]]
        ranks = {bytes(table[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value of byte-level tokenizers
        self.fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_str(file_text)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([END_ID], "<u4")
        if any(s in text for s in self.special):
            found = self.exact.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        found.append(END_ID)
        return np.array(found, "<u4")


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens, the remainder first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, a fixed size

    def pieces(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                ids = encoder.ids(text)
                for k, (start, length) in enumerate(cut(len(ids))):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            yield rows

    return map_batches(docs.select("doc_id", "text"), pieces, PIECES)


# ------------------------------------------------------------ the algorithm

def best_fit(bins: list[list[int]], free: list[int], items: list[int], size: list[int], capacity: int) -> None:
    """Put each item, largest first, where it leaves the least room."""
    room = sorted((f, b) for b, f in enumerate(free) if f > 0)
    for item in sorted(items, key=lambda i: (-size[i], i)):
        at = bisect_left(room, (size[item], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
            free.append(capacity)
        bins[b].append(item)
        free[b] = left - size[item]
        if free[b] > 0:
            insort(room, (free[b], b))


def fitness(free: list[int], capacity: int) -> float:
    """Grouping fitness: mean squared fill, higher for fewer and fuller bins."""
    return sum(((capacity - f) / capacity) ** 2 for f in free) / max(1, len(free))


def crossover(one, two, size: list[int], capacity: int, rng: random.Random):
    """Bins of ``two`` that are well filled go whole into a copy of ``one``;
    bins of ``one`` that hold any of their items go; what they held besides
    is best-fitted again."""
    order = sorted(range(len(two[0])), key=lambda b: (two[1][b], b))
    best = order[: max(1, len(order) * 6 // 10)]
    chosen = rng.sample(best, rng.randint(1, max(1, len(best) * 2 // 3)))
    given = {i for b in chosen for i in two[0][b]}
    bins, free, displaced = [list(two[0][b]) for b in chosen], [two[1][b] for b in chosen], []
    for items, f in zip(*one):
        if given.isdisjoint(items):
            bins.append(list(items))
            free.append(f)
        else:
            displaced += [i for i in items if i not in given]
    best_fit(bins, free, displaced, size, capacity)
    return bins, free


def mutate(one, size: list[int], capacity: int, rng: random.Random):
    """Open the emptiest bins and a few at random, and best-fit their items."""
    order = sorted(range(len(one[0])), key=lambda b: (-one[1][b], b))
    few = max(2, len(order) // 20)
    opened = {*order[:few], *rng.sample(order, min(few, len(order)))}
    bins = [list(x) for b, x in enumerate(one[0]) if b not in opened]
    free = [f for b, f in enumerate(one[1]) if b not in opened]
    items = [i for b in opened for i in one[0][b]]
    rng.shuffle(items)
    room = {b: f for b, f in enumerate(free) if f > 0}
    half = items[: len(items) // 2]
    for item in half:  # first fit in random order varies the search
        b = next((b for b, f in room.items() if f >= size[item]), None)
        if b is None:
            b = len(bins)
            bins.append([])
            free.append(capacity)
            room[b] = capacity
        bins[b].append(item)
        free[b] -= size[item]
        room[b] = free[b]
    best_fit(bins, free, items[len(items) // 2 :], size, capacity)
    return bins, free


def evolve(size: list[int], inherited: list[list[int]], capacity: int, seed: int):
    """The best packing (bins, free) an island finds."""
    rng = random.Random(seed)
    everything = list(range(len(size)))
    start: tuple = ([], [])
    best_fit(*start, everything, size, capacity)
    population = [start]
    if inherited:
        population.append(([list(b) for b in inherited], [capacity - sum(size[i] for i in b) for b in inherited]))
    bound = -(-sum(size) // capacity)
    while len(population) < POPULATION:
        population.append(mutate(population[0], size, capacity, rng))
    score = lambda p: (-len(p[0]), fitness(p[1], capacity))
    population.sort(key=score, reverse=True)
    for _ in range(CHILDREN):
        if len(population[0][0]) <= bound and len(size) < 50:
            break
        one, two = rng.sample(population, 2)
        child = crossover(one, two, size, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, size, capacity, rng)
        if score(child) > score(population[-1]):
            population[-1] = child
            population.sort(key=score, reverse=True)
    return population[0]


def _island(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    size = [int(x) for x in pdf.length]
    inherited = [list(g) for k, g in pdf.groupby("origin").indices.items() if k >= 0]
    inherited = inherited if sum(map(len, inherited)) == len(pdf) else []
    bins, free = evolve(size, inherited, CAPACITY, int(pdf.island.iloc[0]))
    at, offset, room = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
    for b, items in enumerate(bins):
        place = 0
        for i in sorted(items):
            at[i], offset[i], room[i] = b, place, free[b]
            place += size[i]
    return pdf.assign(bin=at, offset=offset, free=room)[[*(x.split()[0] for x in PACKED.split(", "))]]


def pack(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """``pieces`` (a written table) with sequence_id and offset. An epoch's
    islands are numbered apart, full pieces get negative ids."""
    done = [
        pieces.where(F.col("length") == CAPACITY)
        .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    ]
    names = [x.split()[0] for x in PIECES.split(", ")]
    left = pieces.where(F.col("length") < CAPACITY).withColumn("origin", F.lit(-1).cast("long"))
    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    for epoch in range(EPOCHS):
        n = left.count()
        if not n:
            break
        islands = -(-n // ISLAND)
        # equal rows may be many: their place among the rows of a task spreads them
        mixed = F.xxhash64(spread, F.monotonically_increasing_id(), F.lit(epoch)) if epoch == 0 else F.xxhash64("origin", F.lit(epoch))
        dealt = scratch.write(left.withColumn("island", F.pmod(mixed, F.lit(islands)) + (epoch << 40)), f"dealt-{epoch}")
        # as text, ids pass pandas unchanged beside nulls
        found = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("island").applyInPandas(_island, PACKED.replace("doc_id long", "doc_id string"))
        packed = scratch.write(found.withColumn("doc_id", F.col("doc_id").cast("long")), f"packed-{epoch}")
        scratch.drop(f"dealt-{epoch}")
        number = F.col("island") * (1 << 16) + F.col("bin")
        ready = packed if epoch == EPOCHS - 1 else packed.where(F.col("free") <= NEARLY_FULL)
        done.append(ready.select(*names, number.alias("sequence_id"), "offset"))
        left = packed.where(F.col("free") > NEARLY_FULL).select(*names, number.alias("origin"))
    out = done[0].select(*names, "sequence_id", "offset")
    for part in done[1:]:
        out = out.unionByName(part.select(*names, "sequence_id", "offset"))
    return out


def best_fit_packing(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of
    every piece of every row."""
    scratch = Scratch(docs.sparkSession)
    return pack(scratch.write(token_pieces(docs, tokenizer_file), "pieces"), scratch)
