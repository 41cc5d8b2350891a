"""Near duplicates by a chosen-path set similarity join (operator 1).

A document's set is its distinct 5-word shingles; two documents are linked
when 100 * |intersection| >= 75 * |union|. Documents with equal sets form one
class, which takes part once. Every class is embedded as ``COORDS`` minwise
tokens. Each of ``TREES`` independent trees starts from one token: the
classes that share it form a node. A node of few members is compared
exhaustively. A larger one is branched by two pairs of tokens chosen by its
own hash. A pair of similarity 0.75 shares the root with probability 0.75 and a
path of one, two or three levels with 0.81, 0.70 or 0.63, so all trees miss it
with 1 in 10,000, 2,000 or 600; a more similar one, less.

As in the published algorithm, a class that is similar to its whole node is
compared with all of the node at once: the hub, found by agreement with the
majority of the node's sketch bits. The members that resemble it are its family.
Members linked with the hub are connected through it; the others of a family
of up to ``FAMILY`` members are compared with the whole family. Pairs within
one label (linked, or compared) are done, and a node is done when one label
is left, which ends the branching of groups of variants. A larger family
keeps its unlinked members apart and goes on branching.

Candidates pass a sketch (two bits a token; a linked pair fails it with
about 3 in 100,000) and are then confirmed on full sets.

All tables are keyed by 64-bit hashes of sets; intermediate ones are written
to the shared folder. Only ids behind a counted bound are broadcast.

Defined cases: fewer than five words are one shingle; null or empty text has
an empty set, is linked with nothing and is its own component; repeated rows
are returned once each and share a class; a null doc_id can be a member but
never the name of a component that has another id.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, map_batches, row_key, small_side
from tessera.session import Scratch

WORDS = 5
COORDS, TREES = 128, 10
SKETCH_BITS = 57  # differing bits of 256 that a candidate may have: mean 32, deviation 6.3 at the threshold
PAIRS_PER_ROW = (32, 256)  # a root, and a deeper node, is compared at once up to so many pairs a member
FAMILY = 4096  # members that are compared with each other around one hub
FAMILY_BITS = 72  # differing bits of a member from the hub: a similarity of some 0.45
SPREAD = 16  # parts that the comparisons of a family are dealt to
BROADCAST_IDS = 1_000_000  # 8 MB of ids; beyond it the same join shuffles
SKETCH = "doc_id long, row long, n_shingles long, v long, sig array<int>, s0 long, s1 long, s2 long, s3 long"
BITS = ["s0", "s1", "s2", "s3"]


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(WORDS, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in spans), np.uint64))


def multipliers() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 31, COORDS, np.uint32) * np.uint32(2) + np.uint32(1)


def minwise(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The set's minwise tokens: smallest product under each multiplier."""
    short = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    low = np.full(COORDS, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(short), 2048):
        np.minimum(low, (factors[:, None] * short[None, k : k + 2048]).min(axis=1), out=low)
    return low


def bit_sketch(sig: np.ndarray) -> np.ndarray:
    """Two mixed bits of each token, as four longs."""
    mixed = (sig * np.uint32(0x9E3779B1)) >> np.uint32(30)
    bits = np.stack([mixed & 1, mixed >> 1], axis=1).astype(np.uint8).ravel()
    return np.packbits(bits).view("<i8")


def sketches(docs: DataFrame) -> DataFrame:
    def sketch(batches):
        factors = multipliers()
        for batch in batches:
            rows = []
            for doc_id, row, text in zip(batch.doc_id, batch.row, batch.text):
                found = shingles(text)
                if not len(found):
                    rows.append((doc_id, row, 0, None, None, None, None, None, None))
                    continue
                sig = minwise(found, factors)
                v = xxhash.xxh3_64_intdigest(found.tobytes())
                rows.append((doc_id, row, len(found), v - (1 << 64) if v >> 63 else v, sig.view(np.int32), *bit_sketch(sig).tolist()))
            yield rows

    return map_batches(docs.select("doc_id", row_key().alias("row"), "text"), sketch, SKETCH)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, shingles) of the documents with the ids of ``wanted``."""
    wanted = wanted.select(F.col("doc_id").alias("_id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    chosen = docs.select("doc_id", "text").join(wanted, F.expr("doc_id <=> _id"), "left_semi").select("text")

    def sets(batches):
        for batch in batches:
            found = [shingles(t) for t in batch.text]
            names = [xxhash.xxh3_64_intdigest(f.tobytes()) for f in found]
            yield {"v": np.array(names, np.uint64).view(np.int64), "shingles": [f.view(np.int64) for f in found]}

    return map_batches(chosen, sets, "v long, shingles array<bigint>")


#: 100 * i >= 75 * (na + nb - i), with the intersection taken once
LINKED = "7L * size(array_intersect(sa, sb)) >= 3L * (size(sa) + size(sb))"


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of linked classes, by their full sets."""
    both = (
        pairs.join(sets.select(F.col("v").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("v").alias("b"), F.col("shingles").alias("sb")), "b")
    )
    return both.where(LINKED).select("a", "b").distinct()


def family_links(members: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) within families (hub, v, n, sketch) other than with the
    hub: the members not linked with it against all members. The full sets
    travel with the rows, once a member, and only linked pairs come out."""
    with_hub = links.select(F.col("a").alias("hub"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("hub"), F.col("a").alias("v")))
    whole = members.join(sets.dropDuplicates(["v"]), "v")
    apart = whole.where("v <> hub").join(with_hub, ["hub", "v"], "left_anti")
    one = apart.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).withColumnRenamed("shingles", "sa").alias("x")
    two = whole.join(with_hub.withColumn("joined", F.lit(True)), ["hub", "v"], "left").withColumn(
        "part", F.expr(f"pmod(v, {SPREAD})").cast("int")).withColumnRenamed("shingles", "sb").alias("y")
    # of two members apart, the pair is met once
    pairs = one.join(two, F.expr("x.hub = y.hub AND x.part = y.part AND y.v <> y.hub AND x.v <> y.v AND (y.joined OR x.v < y.v)") & alike("x", "y") & F.expr(LINKED))
    return pairs.select(F.expr("least(x.v, y.v)").alias("a"), F.expr("greatest(x.v, y.v)").alias("b")).distinct()


def differing(one: str, two: str) -> str:
    return "(" + " + ".join(f"bit_count({one}.{s} ^ {two}.{s})" for s in BITS) + ")"


def alike(one: str, two: str):
    """Whether sizes and sketches leave a link possible."""
    return F.expr(f"100 * least({one}.n, {two}.n) >= 75 * greatest({one}.n, {two}.n) AND {differing(one, two)} <= {SKETCH_BITS}")


def compare_small(small: DataFrame) -> DataFrame:
    """Candidate pairs of different groups within each node. The rows outside
    a node's largest group meet all rows, so the work is a small multiple of
    the pairs that count, which is linear in the node's rows."""
    one, two = small.where("g <> top").alias("x"), small.alias("y")
    pairs = one.join(two, F.expr("x.node = y.node AND x.g <> y.g AND (y.g = y.top OR x.v < y.v)") & alike("x", "y"))
    return pairs.select(F.expr("least(x.v, y.v)").alias("a"), F.expr("greatest(x.v, y.v)").alias("b")).distinct()


def node_sizes(rows: DataFrame) -> DataFrame:
    """(node, m rows, cross pairs of different groups, top group) of the nodes
    that still have pairs."""
    groups = rows.groupBy("node", "g").agg(F.count("*").alias("c"))
    sized = groups.groupBy("node").agg(
        F.sum("c").alias("m"), F.sum(F.expr("CAST(c AS DOUBLE) * c")).alias("q"), F.max(F.struct("c", "g")).alias("t"))
    return sized.select("node", "m", F.expr("(CAST(m AS DOUBLE) * m - q) / 2").alias("cross"), F.col("t.g").alias("top")).where("cross > 0")


def hubs_of(full: DataFrame) -> DataFrame:
    """One row a node: its class nearest to the node's majority in the first
    64 sketch bits, among those with a label of their own. Two grouped
    aggregates, combined before the shuffle."""
    ones = [F.sum(F.expr(f"shiftrightunsigned(s0, {j}) & 1L")).alias(f"b{j}") for j in range(64)]
    sums = full.groupBy("node").agg(F.count("*").alias("rows"), *ones)
    bits = " | ".join(f"IF(2 * b{j} > rows, shiftleft(1L, {j}), 0L)" for j in range(64))
    modes = sums.select("node", F.expr(bits).alias("mode"))
    score = F.expr("64 - bit_count(s0 ^ mode)").alias("score")
    best = full.where("g = v").join(modes, "node").groupBy("node").agg(F.max(F.struct(score, "v", "n", *BITS)).alias("h"))
    return best.select("node", "h.*")


def children(rows: DataFrame) -> DataFrame:
    """Every row under two pairs of tokens that its node's hash chooses (an
    odd step through the COORDS tokens, so all four differ). A pair of
    similarity 0.75 shares 1.1 children on average, one of 0.7 less than one, so
    that the rows of pairs below the threshold die out."""
    at = [F.expr(f"CAST(pmod(pmod(xxhash64(node, 1), {COORDS}) + {j} * (2 * pmod(xxhash64(node, 2), {COORDS // 2}) + 1), {COORDS}) AS INT)")
          for j in range(4)]
    pairs = [F.xxhash64("node", F.lit(k), F.col("sig")[at[2 * k]], F.col("sig")[at[2 * k + 1]]) for k in range(2)]
    return rows.select("v", "n", *BITS, "g", F.explode(F.array(*pairs)).alias("node"))


def links(docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Linked pairs (a, b) of classes, enough of them to connect every
    component."""
    roots = [F.struct(F.xxhash64(F.lit(t), F.col("sig")[t]).alias("node")) for t in range(TREES)]
    rows = classes.select("v", "n", *BITS, F.col("v").alias("g"), F.inline(F.array(*roots)))
    found, depth = [], 0
    while True:
        sized = scratch.write(rows.join(node_sizes(rows), "node"), f"nodes-{depth}")
        scratch.drop(f"rows-{depth}")
        most = PAIRS_PER_ROW[depth > 0]
        pairs = compare_small(sized.where(f"cross <= {most} * m"))
        large = sized.where(f"cross > {most} * m")
        last = large.isEmpty()
        if not last:
            full = scratch.write(large.join(classes.select("v", "sig"), "v"), f"large-{depth}")
            near = full.alias("x").join(hubs_of(full).alias("y"), F.expr(f"x.node = y.node AND {differing('x', 'y')} <= {FAMILY_BITS}"))
            bits = [F.col(f"x.{c}") for c in ("v", "n", *BITS, "g")]
            near = scratch.write(near.select("x.node", *bits, F.col("y.v").alias("hub"), alike("x", "y").alias("alike")), f"near-{depth}")
            spokes = near.where("alike AND v <> hub").select(F.least("v", "hub").alias("a"), F.greatest("v", "hub").alias("b"))
            members = near.select("hub", "v", "n", *BITS).dropDuplicates(["hub", "v"])
            sizes = members.groupBy("hub").agg((F.count("*") <= FAMILY).alias("whole"))
            members = scratch.write(members.join(sizes, "hub"), f"families-{depth}")
            pairs = pairs.unionByName(spokes)
        pairs = scratch.write(pairs.distinct(), f"pairs-{depth}")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("v"))
        if not last:
            ids = ids.unionByName(members.where("whole").select("v"))
        wanted = scratch.write(classes.join(ids.distinct(), "v").select("doc_id"), f"wanted-{depth}")
        sets = scratch.write(full_sets(docs, wanted), f"sets-{depth}")
        linked = scratch.write(confirmed(pairs, sets), "links")
        found.append(linked)
        if last:
            scratch.drop(f"nodes-{depth}", f"pairs-{depth}", f"sets-{depth}", f"wanted-{depth}")
            break
        found.append(scratch.write(family_links(members.where("whole"), linked, sets), "links"))
        spoke = linked.select("a", "b", F.lit(True).alias("linked"))
        judged = near.join(members.select("hub", "v", "whole"), ["hub", "v"]).join(spoke, F.expr("a = least(v, hub) AND b = greatest(v, hub)"), "left")
        label = judged.where("whole OR (linked AND g = v)").select("node", "v", "hub")
        rows = scratch.write(children(full.join(label, ["node", "v"], "left").withColumn("g", F.coalesce("hub", "g"))), f"rows-{depth + 1}")
        scratch.drop(*(f"{t}-{depth}" for t in ("nodes", "large", "near", "families", "pairs", "sets", "wanted")))
        depth += 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.distinct()


def near_duplicates(docs: DataFrame, key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; with ``key`` also
    the key of the row and the component's root, which only rows without words
    lack."""
    scratch = Scratch(docs.sparkSession)
    own = scratch.write(sketches(docs), "sketches")
    first = [F.first(c).alias(c) for c in ("sig", *BITS)]
    classes = scratch.write(
        own.where("v IS NOT NULL").groupBy("v").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), *first), "classes")
    roots = components(links(docs, classes, scratch), scratch)
    named = classes.select("v", "doc_id").join(roots.withColumnRenamed("id", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    names = scratch.write(named.join(least, "root").select("v", "root", "component_id"), "names")
    out = own.select("doc_id", "row", "n_shingles", "v").join(names, "v", "left")
    component = F.coalesce("component_id", "doc_id")
    out = out.select("doc_id", "row", "root", "n_shingles", component.alias("component_id"), F.expr("doc_id <=> coalesce(component_id, doc_id)").alias("kept"))
    return out if key else out.drop("row", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that of its smallest doc_id, with all
    columns: of rows with one id the smallest row key, of rows equal in id and
    text the smallest hash of all columns. Rows without words stay."""
    scratch = Scratch(docs.sparkSession)
    judged = scratch.write(near_duplicates(docs, key=True), "judged")
    words = judged.where("n_shingles > 0")
    gone = words.where("NOT kept").select("row").distinct()
    # of several rows with the kept id all go and one comes back
    twice = words.where("kept").groupBy("root").agg(F.count("*").alias("n"), F.min("row").alias("least")).where("n > 1")
    keyed = docs.withColumn("_row", row_key())
    rest = keyed.join(small_side(gone.withColumnRenamed("row", "_row"), BROADCAST_IDS), "_row", "left_anti")
    twice = scratch.write(twice, "twice")
    if twice.isEmpty():
        return rest.drop("_row")
    alike = scratch.write(words.where("kept").join(twice, "root").select(F.col("row").alias("_row")).distinct(), "alike")
    rest = rest.join(small_side(alike, BROADCAST_IDS), "_row", "left_anti").drop("_row")
    back = keyed.join(small_side(twice.select(F.col("least").alias("_row")), BROADCAST_IDS), "_row", "left_semi")
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_one")
    return rest.unionByName(back.groupBy("_row").agg(one).select("_one.*"))
