"""Near-duplicates by exact similarity: texts whose distinct five-word shingles agree to 0.8 or more are linked, and links form components.

Candidates come from a prefix filter.  All shingles have one order; of a text with n shingles the first n - ceil(0.8 n) + 1 are its
prefix, and two texts that agree to 0.8 share a shingle of both prefixes.  So no pair escapes, whatever the edits are; any order gives
the same links.  The order keeps shared passages out of the prefixes, whatever the size of the corpus: shingles whose hash lies in a BAND are
counted over all texts and stand first, the rarest foremost; the others follow by hash.  The band holds twice as many shingles as a prefix, so
texts send their part of it, and what is missing to a prefix where they are short.  Pairs are dropped before the check only where sizes
and places in the order rule the similarity out.

Texts that share a prefix shingle are a bucket, ranked by how much of their prefix others have, so that an original comes before copies
that agree with it but not with each other.  First every text meets the head that it shares most buckets with, again and again while that
finds links; that joins most groups at a pair a text.  Then rounds compare the first rank of each bucket with all later ones, then ranks 2 to 16, then 17 to 256, and so on.
A bucket ends when what is left of it is one component; pairs within a component and pairs already compared are left out.  In the rounds
a text also carries a sketch, the parity of its shingles on each of some hundred bits: sets that differ in d shingles differ in at most
d bits, so pairs whose sketches differ in more than the similarity allows are ruled out where they meet, without their shingles.  After the last
round every pair of a bucket is in one component, was compared or ruled out.  Texts that consist of frequent shingles without being similar
cost a look at two sketches a pair; there is no cap.

Texts that are the same words are one node from the start, so copies never meet each other.

Results: texts without words are one node.  A missing id is larger than every other; the pipeline names rows without an id by their text.  Texts
of fewer than five words are compared whole.  Nodes and shingles are 64-bit hashes of the words; the check compares their upper 32 bits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from warchest.llm.common import SPOOLED, col, map_texts, spool, tidy
from warchest.llm.simhash import components

SHINGLE = 5
SIMILARITY = 0.8
#: Part of all shingles, by hash, that are counted over all texts.
BAND = 0.4
#: Rounds in which every text meets one head.
HEADS = 6
#: A round goes so many times as far down the ranks as the one before.
REACH = 16
#: Words of 64 bits in a sketch.
SKETCH = 8
#: Bits of the filter that leaves texts nobody asked for out of a check; a text let through in vain is dropped by a join.
FILTER = 1 << 26
#: Keeps rounding from making a bound too strict.
SLACK = 1e-6


def node_of(words: list[bytes]) -> int:
    from xxhash import xxh3_64_intdigest

    n = xxh3_64_intdigest(b" ".join(words))
    return n - (1 << 64) if n >> 63 else n


def shingles_of(words: list[bytes], shingle: int) -> np.ndarray:
    """The distinct shingles, sorted."""
    from xxhash import xxh3_64_intdigest

    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n, width = max(1, len(words) - shingle + 1), min(shingle, len(words))
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = (x ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    return np.unique(x.view(np.int64))


def in_filter(node: int, wanted: np.ndarray) -> bool:
    at = node % FILTER
    return bool(int(wanted[at >> 5]) >> (at & 31) & 1)


def shingler(shingle: int, wanted: np.ndarray) -> Callable[[list], list[list]]:
    """A text's node and the upper 32 bits of its distinct shingles; none for nodes the filter `wanted` leaves out."""

    def one(text: bytes | None) -> tuple[int, np.ndarray | None]:
        words = (text or b"").lower().split()
        node = node_of(words)
        return node, np.unique((shingles_of(words, shingle) >> 32).astype(np.int32)) if in_filter(node, wanted) else None

    return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]


def namer() -> Callable[[list], list[list]]:
    """A text's node."""
    return lambda texts: [[node_of((t or b"").lower().split()) for t in texts]]


def prefix_size(n: int, similarity: float) -> int:
    return n - ceil(similarity * n - SLACK) + 1


#: Signed hashes below it are the band.
EDGE = int(BAND * 2**64) - 2**63


def marker(shingle: int, similarity: float) -> Callable[[list], list[list]]:
    """A text's node, its number of shingles, how many lie in the band, and its first shingles by hash: the band, and beyond it up to the size
    of the prefix."""

    def one(text: bytes | None) -> tuple[int, int, int, np.ndarray]:
        words = (text or b"").lower().split()
        x = shingles_of(words, shingle)
        k = int(np.searchsorted(x, EDGE))
        return node_of(words), len(x), k, x[: max(k, prefix_size(len(x), similarity))]

    return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]


def filter_of(nodes: DataFrame) -> np.ndarray:
    """Bits of the nodes; a text let through in vain is dropped by a join."""
    bits = nodes.select(F.pmod("node", F.lit(FILTER)).alias("at")).groupBy(F.shiftright("at", 5).alias("word"))
    bits = bits.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(31).cast("int"))).alias("bits")).toArrow()
    wanted = np.zeros(FILTER >> 5, np.uint32)
    wanted[bits["word"].to_numpy()] = bits["bits"].to_numpy().astype(np.uint32)
    return wanted


def prefixes(docs: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(token, node, n, pos): the shingles of the prefixes, as far as another text may have them, pos their place in the order."""
    whole = T.IntegerType()
    made = [T.StructField("node", T.LongType(), False), T.StructField("n", whole, False), T.StructField("k", whole, False),
            T.StructField("first", T.ArrayType(T.LongType()), False)]
    texts = map_texts(docs, "text", [], made, lambda: marker(shingle, similarity), binary=True)
    marks = texts.select("node", "n", "k", F.posexplode("first").alias("pos", "token"))
    # one shuffle, by shingle, also takes out the copies
    marks = marks.repartition("token").dropDuplicates(["token", "node"])
    marks = marks.withColumn("m", F.count("*").over(Window.partitionBy("token"))).where("m > 1")
    # shingles of the band that no other text has come before those that are left here
    band = F.col("pos") < F.col("k")
    own = Window.partitionBy("node")
    marks = marks.withColumn("band", band).withColumns({
        "shared": F.sum(band.cast("int")).over(own), "turn": F.row_number().over(own.orderBy(F.desc("band"), "m", "token"))})
    place = F.when(F.col("band"), F.col("k") - F.col("shared") + F.col("turn") - 1).otherwise(F.col("pos"))
    size = F.col("n") - F.ceil(similarity * F.col("n") - SLACK) + 1
    return marks.select("token", "node", "n", place.cast("int").alias("pos")).where(F.col("pos") < size)


def buckets(docs: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(token, node, n, pos, m, rank): the nodes of each shingle that several prefixes have."""
    since = len(SPOOLED)
    marks = prefixes(docs, similarity, shingle).withColumn("m", F.count("*").over(Window.partitionBy("token"))).where("m > 1")
    marks = spool(marks, "shared")
    score = marks.groupBy("node").agg((F.sum(F.log2("m")) / F.any_value("n")).alias("score"))
    marks = marks.join(score.hint("merge"), "node")
    rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("score"), "node"))
    ranked = spool(marks.select("token", "node", "n", "pos", "m", rank.alias("rank")), "ranked")
    tidy(docs.sparkSession, since, ranked)
    return ranked


def possible(similarity: float) -> Column:
    """Whether sizes and places of a shared shingle let h and o be similar."""
    first, rest = F.least("h.pos", "o.pos"), F.least(F.col("h.n") - F.col("h.pos"), F.col("o.n") - F.col("o.pos"))
    return (first + rest) * (1 + similarity) + SLACK >= similarity * (F.col("h.n") + F.col("o.n"))


def sets_of(nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the shingles of texts that are in a bucket, written once."""
    made = [T.StructField("node", T.LongType(), False), T.StructField("set", T.ArrayType(T.IntegerType()))]
    wanted = filter_of(nodes)
    sets = map_texts(docs, "text", [], made, lambda: shingler(shingle, wanted), binary=True).where("set is not null")
    return spool(sets.groupBy("node").agg(F.any_value("set").alias("set")), "sets")


def sketches(sets: DataFrame) -> DataFrame:
    """(node, w, p0, p1, ...): the size of each set, and for each bit whether an odd number of its shingles falls there."""
    bits = 64 * SKETCH

    def run(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy()
            at = (batch.column(1).flatten().to_numpy() & (bits - 1)) + np.repeat(np.arange(len(lengths)) * bits, lengths)
            odd = np.bincount(at, minlength=len(lengths) * bits) & 1
            words = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").reshape(-1, SKETCH)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int32()), *map(pa.array, words.T.copy())], names=["node", "w", *_sketch()])

    return sets.mapInArrow(run, "node long, w int, " + ", ".join(f"{p} long" for p in _sketch()))


def _sketch() -> list[str]:
    return [f"p{i}" for i in range(SKETCH)]


def alike(similarity: float) -> Column:
    """Whether the sketches of h and o let them be similar."""
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"h.{p}").bitwiseXOR(F.col(f"o.{p}"))) for p in _sketch()])
    return apart * (1 + similarity) <= (F.col("h.w") + F.col("o.w")) * (1 - similarity) + SLACK


def verified(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts agree enough."""
    wanted = filter_of(near.select(F.explode(F.array("a", "b")).alias("node")))

    def asked(batches):
        for batch in batches:
            at = np.mod(batch.column(0).to_numpy(), FILTER)
            yield batch.filter(pa.array((wanted[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)))

    # grouped by node, so that both joins read one shuffle
    known = sets.mapInArrow(asked, sets.schema).groupBy("node").agg(F.any_value("set").alias("set"))
    side = lambda end: known.select(F.col("node").alias(end), F.col("set").alias(f"set_{end}")).hint("merge")
    pairs = near.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.where(shared >= similarity * (F.size("set_a") + F.size("set_b") - shared)).select("a", "b")


def _pair() -> list[Column]:
    return [F.least("h.node", "o.node").alias("a"), F.greatest("h.node", "o.node").alias("b")]


def heads(left: DataFrame, roots: DataFrame | None, tested: DataFrame | None, similarity: float) -> DataFrame:
    """Every text with the head of buckets that it shares most of, of those it is not yet joined to or compared with: at most a pair a text."""
    first = left.where("rank = 1").alias("h")
    met = left.where("rank > 1").alias("o").join(first.hint("merge"), F.col("o.token") == F.col("h.token")).where(possible(similarity))
    met = met.groupBy(F.col("o.node").alias("node"), F.col("h.node").alias("head")).agg(F.count(F.lit(1)).alias("times"))
    if roots is not None:
        one, two = roots.toDF("node", "r"), roots.toDF("head", "s")
        met = met.join(one.hint("merge"), "node", "left").join(two.hint("merge"), "head", "left")
        met = met.where(F.coalesce("r", "node") != F.coalesce("s", "head"))
    met = met.select("node", "head", "times", F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    if tested is not None:
        met = met.join(tested.hint("merge"), ["a", "b"], "left_anti")
    best = met.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("times", "head")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def linked(docs: DataFrame, similarity: float, shingle: int) -> DataFrame | None:
    """(node, root) of all nodes that have a similar one; None if there are none."""
    spark, began = docs.sparkSession, len(SPOOLED)
    left, low, high = buckets(docs, similarity, shingle), 1, 1
    if left.isEmpty():
        tidy(spark, began)
        return None
    sets = sets_of(left.select("node"), docs, shingle)
    tested = roots = None
    by_heads, sketched = HEADS, False
    while by_heads or not left.isEmpty():
        since = len(SPOOLED)
        if by_heads:
            pairs = heads(left, roots, tested, similarity)
        else:
            known = left.withColumn("root", F.col("node"))
            if roots is not None:
                known = left.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
                mixed = known.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("token")
                known = known.join(mixed.hint("merge"), "token", "left_semi")
            if not sketched:
                known = known.join(sketches(sets).hint("merge"), "node")
            if roots is not None or not sketched:
                known = spool(known, "left")
                left, sketched = known.drop("root"), True
            hubs, others = known.where(F.col("rank").between(low, high)).alias("h"), known.alias("o")
            meet = (F.col("h.token") == F.col("o.token")) & (F.col("h.rank") < F.col("o.rank")) & (F.col("h.root") != F.col("o.root"))
            pairs = others.join(hubs.hint("merge"), meet & possible(similarity) & alike(similarity)).select(*_pair()).distinct()
            if tested is not None:
                pairs = pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")
        pairs, more = spool(pairs, "pairs"), False
        if not pairs.isEmpty():
            found = spool(verified(pairs, sets, similarity), "similar")
            tested = pairs if tested is None else tested.unionAll(pairs)
            more = not found.isEmpty()
            if more:
                # components so far stand for their links
                known = found if roots is None else found.unionAll(roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")))
                roots = components(known).toDF("node", "root")
        if by_heads:
            by_heads = by_heads - 1 if more else 0
        else:
            # what was a hub has met its whole bucket
            left = left.where(F.col("rank") > high)
            low, high = high + 1, high * REACH
        tidy(spark, since, left, tested, roots)
    tidy(spark, began, roots)
    return roots


def grouped(df: DataFrame, *, text: str, doc_id: str, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key, node), one a document, its key xxhash64 of the text; and (node, first, root), one a distinct text, with its smallest id."""
    docs = df.select(col(doc_id).alias("id"), col(text).alias("text"))
    made = [T.StructField("node", T.LongType(), False)]
    rows = spool(map_texts(docs.withColumn("key", F.xxhash64("text")), "text", ["id", "key"], made, namer, binary=True), "nodes")
    texts = spool(rows.groupBy("node").agg(F.min("id").alias("first")), "texts")
    roots = linked(docs, similarity, shingle)
    member = texts.select("node", "first")
    if roots is None:
        member = member.withColumn("root", F.col("node"))
    else:
        member = member.join(roots.hint("merge"), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    return rows, spool(member, "members")


def near_copies(
    df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, shingle: int = SHINGLE, whole: bool = False
) -> DataFrame:
    """One row per document: doc_id, component_id (smallest id of its component).  `whole` adds key, xxhash64 of the text, and root, which tells
    components apart where an id stands for several texts."""
    rows, member = grouped(df, text=text, doc_id=doc_id, similarity=similarity, shingle=shingle)
    smallest = spool(member.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    member = spool(member.join(smallest.hint("merge"), "root").select("node", "component_id", "root"), "classes")
    more = ["key", "root"] if whole else []
    return rows.join(member.hint("merge"), "node").select(F.col("id").alias("doc_id"), "component_id", *more)
