"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources share all words by weight; a source stops at `most` times its own words, the excess is shared again.
Schedule: M slots, M a power of two; slot i gets the van der Corput point of i (its bits reversed, over M), which falls
into one source's stretch of the cumulative weights.  In M slots each stretch of w points is hit w times, and the number of
earlier hits is a sum over the bits of the stretch's ends, so a slot knows its rank within its source without any shuffle.
Blocks: a source's documents, shuffled by a hash of the id, form a circular stream of words; its slots cut the words the mix
takes into blocks of equal length.  A slot joins the block of its rank.

Weights belong to sources, a list that the driver plans (`max_sources`, a million, beyond which the operator raises); documents and
slots never meet the driver.  Beyond 2 to the power `most_bits` slots blocks get longer instead of more.

Results: a missing text has no words and is never taken; a missing source is a source of its own and comes last; rows that
repeat id and text are documents of their own; sources without words have target 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from warchest.llm.common import BLANKS, WORD, col, spool

BLOCK = 1024
MOST = 3.0
MAX_SOURCES = 1_000_000
MOST_BITS = 31


def by_turns(place: int) -> float:
    """Weights 1, 2, 3, repeating."""
    return float(place % 3 + 1)


def fill(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Targets that share the sum of the sizes by weight, none above `most` times its size."""
    targets, rest, open_ = [0.0] * len(sizes), float(sum(sizes)), sum(weights)
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    for at, i in enumerate(order):  # the fullest first; from the first that has room, all have
        if most * sizes[i] > rest * weights[i] / open_:
            for j in order[at:]:
                targets[j] = rest * weights[j] / open_
            break
        targets[i] = most * sizes[i]
        rest -= targets[i]
        open_ -= weights[i]
    return targets


def cells(targets: list[float], block: int) -> tuple[int, list[int]]:
    """Bits of the number of slots, and how many slots each source gets: by largest remainder, one at least if it has a target."""
    total = sum(targets)
    live = [i for i, t in enumerate(targets) if t > 0]
    if not live:
        return 0, [0] * len(targets)
    bits = max(1, (int(total / block) + 2 * len(live)).bit_length())
    slots = 1 << bits
    exact = [t * (slots - len(live)) / total for t in targets]
    counts = [int(x) + (t > 0) for x, t in zip(exact, targets, strict=True)]
    for i in sorted(live, key=lambda i: (int(exact[i]) - exact[i], i))[: slots - sum(counts)]:
        counts[i] += 1
    counts[live[-1]] += slots - sum(counts)
    return bits, counts


def reversed_bits(x: Column, bits: int) -> Column:
    """The lowest bits in reverse order: swap neighbours, pairs, fours, ..., then drop what lies beyond."""
    out = x
    for k in (1, 2, 4, 8, 16):
        lo = sum(((1 << k) - 1) << at for at in range(0, 32, 2 * k))
        out = F.shiftrightunsigned(out, k).bitwiseAND(lo).bitwiseOR(F.shiftleft(out.bitwiseAND(lo), k))
    return F.shiftrightunsigned(out, 32 - bits)


def hits(bound: int, bits: int) -> list[tuple[int, int]]:
    """For counting i < n with reversed bits below `bound`: (k, p) for each set bit of the bound; i counts once for the
    one pair where it is p modulo 2**k."""
    found, low = [], 0
    for k in range(1, bits + 1):
        bit = bound >> (bits - k) & 1
        if bit:
            found.append((k, low))
        low |= bit << (k - 1)
    if bound == 1 << bits:
        found.append((0, 0))
    return found


def counted_hits(n: Column, pairs: Column) -> Column:
    step = lambda acc, p: acc + F.floor((n - p["p"] + p["m"] - 1) / p["m"]).cast("long")
    return F.aggregate(pairs, F.lit(0).cast("long"), step)


def sized(df: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(col(text), F.lit("")), F.lit(WORD)).cast("long")
    return df.select(col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"), size.alias("size"))


def plan_targets(sizes: DataFrame, weight: Callable[[int], float], most: float, block: int, max_sources: int, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(place, source, source_size, target, words, slots, lo, hi, below_lo, below_hi) and the bits of the schedule."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources; raise max_sources if the list may grow")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    targets = fill([r.n for r in rows], [weight(i) for i in range(len(rows))], most)
    bits, counts = cells(targets, max(block, int(sum(targets)) >> most_bits - 1))
    out, lo = [], 0
    for i, (r, target, count) in enumerate(zip(rows, targets, counts, strict=True)):
        pairs = [[Row(m=1 << k, p=p) for k, p in hits(x, bits)] for x in (lo, lo + count)]
        out.append((i, r.source, r.n, float(target), round(target), count, lo, lo + count, *pairs))
        lo += count
    pair = "array<struct<m: bigint, p: bigint>>"
    schema = f"place int, source string, source_size bigint, target double, words bigint, slots bigint, lo bigint, hi bigint, below_lo {pair}, below_hi {pair}"
    return sizes.sparkSession.createDataFrame(out, schema), bits


def schedule(sources: DataFrame, bits: int) -> DataFrame:
    """(slot, place, rank): every slot of the mix in order, its source and its rank there."""
    spark, coarse = sources.sparkSession, min(bits, 8)
    slots = spark.range(1 << bits if bits else 0).select(F.col("id").alias("slot"), reversed_bits(F.col("id"), bits).alias("point"))
    slots = slots.withColumn("stretch", F.shiftright("point", bits - coarse))
    first, last = F.shiftright("lo", bits - coarse), F.shiftright(F.col("hi") - 1, bits - coarse)
    known = sources.where("slots > 0").withColumn("stretch", F.explode(F.sequence(first, last)))
    met = slots.join(F.broadcast(known), "stretch").where("point >= lo and point < hi")  # max_sources + 256 rows at most
    rank = counted_hits(F.col("slot"), F.col("below_hi")) - counted_hits(F.col("slot"), F.col("below_lo"))
    return met.select("slot", "place", rank.alias("rank"))


def streamed(docs: DataFrame, n: int) -> DataFrame:
    """n rows of distinct place, doc_id, size, with `times`: adds `offset`, where they begin in their source's stream."""
    bins = max(1, int(n**0.5))
    docs = docs.withColumn("hash", F.xxhash64(F.lit("mix"), "doc_id", "size")).withColumn("bin", F.pmod("hash", F.lit(bins)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("times")
    totals = docs.groupBy("place", "bin").agg(F.sum(words).alias("total"))
    base = F.coalesce(F.sum("total").over(before.partitionBy("place").orderBy("bin")), F.lit(0))
    inside = before.partitionBy("place", "bin").orderBy("hash", "doc_id", "size")
    met = docs.join(totals.select("place", "bin", base.alias("base")), ["place", "bin"])
    return met.withColumn("offset", F.col("base") + F.coalesce(F.sum(words).over(inside), F.lit(0))).drop("base", "hash", "bin")


def mix(
    df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source", weight: Callable[[int], float] = by_turns,
    most: float = MOST, block: int = BLOCK, max_sources: int = MAX_SOURCES, most_bits: int = MOST_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).
    documents: doc_id, source, size, copy, source_size, target, place, offset: one row per row of df.
    pieces: slot, place, offset, lap, from_word, to_word: what each slot takes, words of the document counted from 0."""
    docs = sized(df, text, doc_id, source)
    counted = spool(docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times")), "sizes")
    sources, bits = plan_targets(counted.select("source", (F.col("size") * F.col("times")).alias("size")), weight, most, block, max_sources, most_bits)
    facts = F.broadcast(sources.select("place", F.col("source").alias("s"), "source_size", "target", "words", "slots"))  # max_sources rows at most
    placed = streamed(counted.join(facts, counted["source"].eqNullSafe(F.col("s"))).drop("s"), counted.count())
    placed = placed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).drop("times")
    placed = spool(placed.withColumn("offset", F.col("offset") + (F.col("copy") - 1) * F.col("size")), "stream")

    # each lap of a document through the stream, cut at the ends of its source's blocks
    laps = placed.where("size > 0 and words > 0").selectExpr(
        "place", "offset", "size", "source_size", "words", "words div slots as short", "words % slots as longer", "explode(sequence(0L, (words - 1) div source_size)) as lap")
    laps = laps.withColumn("at", F.col("offset") + F.col("lap") * F.col("source_size"))
    laps = laps.withColumn("end", F.least(F.col("at") + F.col("size"), F.col("words"))).where("at < end")
    # the first `longer` blocks have short + 1 words, the others short
    block_of = "if({0} < longer * (short + 1), {0} div (short + 1), longer + ({0} - longer * (short + 1)) div greatest(short, 1L))"
    cut = laps.selectExpr("*", f"explode(sequence({block_of.format('at')}, {block_of.format('(end - 1)')})) as rank")
    cut = cut.selectExpr("*", "rank * short + least(rank, longer) as begin", "(rank + 1) * short + least(rank + 1, longer) as stop")
    cut = cut.selectExpr("place", "offset", "lap", "rank", "greatest(at, begin) - at as from_word", "least(end, stop) - at as to_word")
    pieces = cut.join(schedule(sources, bits), ["place", "rank"])
    return placed.drop("words", "slots"), pieces.select("slot", "place", "offset", "lap", "from_word", "to_word")


def taken_words(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """documents with `taken`, the words the mix takes of each, repeats counted."""
    sums = pieces.groupBy("place", "offset").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    full = placed.where("size > 0").join(sums, ["place", "offset"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return full.unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))


def mixed_documents(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """The rows of df as the mix takes them: a row for each lap that takes words of a document, with the words it takes.
    A text that is taken whole stays as it is; the last text of a source may be cut, its words then stand one blank apart."""
    placed, pieces = mix(df, text=text, doc_id=doc_id, source=source, **how)
    laps = pieces.groupBy("place", "offset", "lap").agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"))
    same = F.concat_ws("\1", *[F.coalesce(F.col(c).cast("string"), F.lit("\2")) for c in ("doc_id", "source", "size")])
    plan = placed.where("size > 0").withColumn("same", same).join(laps, ["place", "offset"]).select("same", "size", "copy", "from_word", "to_word")
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"))
    size = F.regexp_count(F.coalesce(F.col(f"row.`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    rows = rows.select("row", F.col(f"row.`{doc_id}`").alias("doc_id"), F.col(f"row.`{source}`").cast("string").alias("source"), size.alias("size"))
    rows = rows.where("size > 0").select("row", same.alias("same"))  # rows without words would be one group
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("same").orderBy(F.xxhash64(F.col(f"row.`{text}`")))).cast("long"))
    met = rows.join(plan.hint("merge"), ["same", "copy"])  # the plan grows with the documents: never broadcast
    words = F.split(F.regexp_replace(F.col(f"row.`{text}`"), f"^{BLANKS}", ""), BLANKS)
    part = F.array_join(F.slice(words, F.col("from_word").cast("int") + 1, (F.col("to_word") - F.col("from_word")).cast("int")), " ")
    whole = (F.col("from_word") == 0) & (F.col("to_word") == F.col("size"))
    return met.select(*[F.when(whole, F.col(f"row.`{c}`")).otherwise(part).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])
