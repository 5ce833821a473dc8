"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits itself and every variant within half the radius.  Two fingerprints within the radius share a
variant, and a variant is shared by a bounded number of fingerprints (65 for 64 bits and half radius 1), whatever the data
holds.  Colliding fingerprints are verified against the smallest one of the variant and deduplicated.  With an even radius all
fingerprints of a variant are within the radius of each other, so the links to the smallest one keep every component whole.
Components come from repeated smallest-neighbour steps with pointer jumping, over fingerprints, never over copies.

Results: a text without words has fingerprint 0, linked like any other.  A missing id is larger than every other id: a
component of missing ids only has no component id.  Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from warchest.llm.common import col, map_texts, spool

SEED = 42
BITS = 64
RADIUS = 2
SHINGLE = 3
CHUNK = 1 << 15


def fingerprinter(shingle: int) -> Callable[[list], list[list]]:
    from xxhash import xxh64_intdigest

    def one(text: bytes | None) -> int:
        words = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
        if not words:
            return 0
        line, n = b" ".join(words), max(1, len(words) - shingle + 1)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.r_[0, ends[:-1]][:n].tolist()
        ends = (ends - 1)[min(shingle, len(words)) - 1 :].tolist()
        ones = np.zeros(BITS, np.int64)
        for at in range(0, n, CHUNK):
            h = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)]
            bits = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        major = np.packbits(ones * 2 > n, bitorder="little")
        return int(major.view(np.int64)[0])

    return lambda texts: [[one(t) for t in texts]]


def fingerprints(df: DataFrame, *, text: str = "text", keep: list[str] = ("doc_id",), shingle: int = SHINGLE, made: str = "fp") -> DataFrame:
    """The columns `keep` and the 64-bit fingerprint as a long."""
    return map_texts(df, text, list(keep), [T.StructField(made, T.LongType(), False)], lambda: fingerprinter(shingle), binary=True)


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _flips(reach: int) -> list[int]:
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    return [signed(sum(1 << b for b in bits)) for k in range(reach + 1) for bits in combinations(range(BITS), k)]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b), a < b, that connect what is within the radius; fps holds distinct `fp`."""
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in _flips(radius // 2)])
    balls = fps.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    met = balls.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("members")).where(F.size("members") > 1)
    pairs = met.select(F.element_at("members", 1).alias("a"), F.explode(F.slice("members", 2, 1 << 30)).alias("b"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fp that can be reached, for every fp that has a link."""
    edges = spool(edges, "links")
    both = spool(edges.union(edges.select("b", "a")).toDF("fp", "other"), "neighbours")
    labels = spool(both.groupBy("fp").agg(F.least(F.col("fp"), F.min("other")).alias("root")), "labels")
    while True:
        near = both.join(labels.toDF("other", "root"), "other").groupBy("fp").agg(F.min("root").alias("near"))
        near = spool(labels.join(near, "fp").select("fp", "root", F.least("root", "near").alias("next")), "near")
        # jump: the root of the root, which may itself have moved in this step
        jump = near.select(F.col("fp").alias("next"), F.col("next").alias("far"))
        moved = near.join(jump, "next", "left").select("fp", F.least("next", "far").alias("next"), "root")
        moved = spool(moved, "moved")
        labels = moved.select("fp", F.col("next").alias("root"))
        if moved.where(F.col("next") != F.col("root")).isEmpty():
            return labels


def near_duplicates(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest id of its component)."""
    docs = spool(fingerprints(df.select(col(doc_id).alias("doc_id"), col(text).alias("text")), shingle=shingle), "fingerprints")
    firsts = spool(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(links(firsts.select("fp"), radius))
    member = spool(firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "members")
    smallest = spool(member.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    member = spool(member.join(smallest, "root").select("fp", "component_id"), "classes")
    return docs.join(member, "fp").select("doc_id", "fp", "component_id")
