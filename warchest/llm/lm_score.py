"""Language-model scoring with a weighted backoff automaton.

Model: n-grams of words, interpolated: P(w | h) = r c(h w) / c(h) + (1 - r) P(w | shorter h); words by absolute discounting, the
discounted mass goes to the unknown word, one outcome beside the V known ones.  Every seen n-gram shorter than the order
is a state; a seen n-gram is an arc with its smoothed log-probability; a state fails to its longest proper suffix at the
cost of log10(1 - r).  A text starts in the state of its beginning and is read once from left to right: follow the
arc of the word, or fail until there is one.

Counts cover every training document and are as many as the corpus has n-grams, so no machine holds the automaton.  A first
pass adds up the words for the totals.  Then documents are dealt into blocks of bounded size by a hash.  Each block sends its distinct n-grams with their local counts to buckets,
each bucket adds them up and answers each block in the block's order, and each block builds the part of the automaton that its own texts
can reach.  A frequent word or n-gram is one entry a block, so none is hot.  The number of blocks and of buckets follows
the bytes of text.  N-grams travel as 64-bit hashes: two of D n-grams are taken for one with probability D / 2**64 a lookup.

Results: a missing text counts as empty, its only token is the end.  Without training documents every token is unknown with
probability 1.  Rows are independent: repeated rows give repeated results, and count as often when they train.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from warchest.llm.common import col

BLOCK_BYTES = 4 << 20
#: r for n-grams of 2, 3, ... words.
TRUST = (0.35, 0.5)
_BEGIN, _END = b" begin", b" end"  # no words, as they hold a blank


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray) -> bytes:
    """Bytes of one significance together, so that small values compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


class Block:
    """The n-grams of some texts.  Each text is its beginning, its words and its end."""

    def __init__(self, texts: list, order: int) -> None:
        from xxhash import xxh3_64_intdigest

        known: defaultdict = defaultdict(count().__next__)
        known[_BEGIN], known[_END]
        get, parts = known.__getitem__, []
        for t in texts:
            words = (t or b"").lower().split()  # bytes: ASCII letters and white space only
            part = np.zeros(len(words) + 2, np.int64)
            part[1:-1] = np.fromiter(map(get, words), np.int64, len(words))
            part[-1] = 1
            parts.append(part)
        self.lengths = np.array([len(p) for p in parts])
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64)
        self.ids = np.concatenate(parts)  # of words, numbered as they came
        keys = np.fromiter(map(xxh3_64_intdigest, known), np.uint64, len(known))
        del known, get
        place = np.arange(len(self.ids)) - np.repeat(self.starts, self.lengths)
        #: for each length: positions where such n-grams end, their distinct keys (sorted), and which one each is.
        self.at, self.keys, self.which = [], [], []
        own = hashes = keys[self.ids]
        for k in range(1, order + 1):
            if k == 1:
                at = np.arange(len(self.ids))
                distinct, which = np.unique(keys, return_inverse=True)
                which = which[self.ids]
            else:
                hashes = np.r_[np.uint64(0), _mix(hashes[:-1], own[1:])]
                at = np.flatnonzero(place >= k - 1)
                distinct, which = np.unique(hashes[at], return_inverse=True)
            self.at.append(at)
            self.keys.append(distinct)
            self.which.append(which)

    def counts(self, k: int, taught: np.ndarray) -> np.ndarray:
        use = np.repeat(taught, self.lengths)[self.at[k]]
        return np.bincount(self.which[k][use], minlength=len(self.keys[k]))


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys end: buckets are equal ranges of keys."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.r_[0, np.searchsorted(keys, edges), len(keys)]


ASKED = "bucket int, block int, n int, keys binary, counts binary"
ANSWER = "block int, n int, bucket int, counts binary"
_ASKED = [("bucket", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
#: Distinct words that a task holds before it sends their counts on.
HELD = 400_000


def _pieces(keys: np.ndarray, counts: np.ndarray, buckets: int):
    """(bucket, keys, counts) of sorted keys, packed; the keys as steps."""
    ends = _bounds(keys, buckets)
    for b in range(buckets):
        a, z = ends[b], ends[b + 1]
        if a < z:
            yield b, pack(np.diff(keys[a:z], prepend=np.uint64(0))), pack(counts[a:z])


def _count_words(buckets: int):
    """Words of the training rows, counted where they are read."""
    def count_words(batches):
        from xxhash import xxh3_64_intdigest

        def send(counts: Counter) -> pa.RecordBatch:
            keys = np.fromiter(map(xxh3_64_intdigest, counts), np.uint64, len(counts))
            order = np.argsort(keys)
            rows = list(_pieces(keys[order], np.fromiter(counts.values(), np.int64, len(counts))[order], buckets))
            return pa.RecordBatch.from_pydict(dict(zip(("bucket", "keys", "counts"), zip(*rows, strict=True), strict=True)), schema=pa.schema([_ASKED[0], *_ASKED[3:]]))

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update((text or b"").lower().split())
                counts[_END] += 1
                if len(counts) >= HELD:
                    yield send(counts)
                    counts.clear()
        if counts:
            yield send(counts)

    return count_words


def _sum_words(table: pa.Table) -> pa.Table:
    keys = np.concatenate([np.cumsum(unpack(k), dtype=np.uint64) for k in table["keys"].to_pylist()])
    distinct, which = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.concatenate([unpack(c) for c in table["counts"].to_pylist()]).astype(np.int64))
    return pa.table({"tokens": [int(total.sum())], "kinds": [len(total)], "once": [int((total == 1).sum())], "twice": [int((total == 2).sum())]})


def _ask(order: int, buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        block = Block(table["text"].to_pylist(), order)
        taught, number = table["taught"].to_numpy().astype(bool), table["block"][0].as_py()
        rows = [(b, number, k + 1, keys, counts) for k in range(order) for b, keys, counts in _pieces(block.keys[k], block.counts(k, taught), buckets)]
        return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _ASKED, strict=True)], names=[n for n, _ in _ASKED])

    return ask


def _answer(table: pa.Table) -> pa.Table:
    rows, bucket = [], table["bucket"][0].as_py()
    data = list(zip(*(table[c].to_pylist() for c in ("block", "n", "keys", "counts")), strict=True))
    for n in sorted({r[1] for r in data}):
        own = [r for r in data if r[1] == n]
        keys = [np.cumsum(unpack(r[2]), dtype=np.uint64) for r in own]
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, which, np.concatenate([unpack(r[3]) for r in own]).astype(np.int64))
        at = 0
        for r, k in zip(own, keys, strict=True):
            rows.append((r[0], n, bucket, pack(total[which[at : at + len(k)]])))
            at += len(k)
    kinds = [pa.int32()] * 3 + [pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["block", "n", "bucket", "counts"])


class Automaton:
    """The states and arcs that the texts of a block can reach, laid along their words.

    At each position there is one state for each n-gram length below the order, the seen n-gram that ends before it.
    `arcs[k]` holds the weight of the arc that the state of k words has for the word there, or nan; `cost[k]` is the
    weight of failing from k words to k - 1.  An arc of k + 1 words leads to the state of as many words, at most order - 1."""

    def __init__(self, block: Block, totals: list[np.ndarray], facts: tuple[int, int, int, int], trust: tuple[float, ...]) -> None:
        tokens, kinds, once, twice = facts
        discount = once / (once + 2 * twice) if once and twice else 0.5
        self.unknown = log10(discount * kinds / tokens) if tokens else 0.0
        shorter = totals[0][block.which[0]]  # counts by position
        chance = np.where(shorter > 0, (shorter - discount) / max(tokens, 1), 10.0**self.unknown)
        with np.errstate(divide="ignore"):
            self.arcs = [np.where(shorter > 0, np.log10(chance), np.nan)]
        for k in range(1, len(totals)):
            at = block.at[k]
            seen, context = totals[k][block.which[k]], shorter[at - 1]
            full = trust[k - 1] * seen / np.maximum(context, 1) + (1 - trust[k - 1]) * chance[at]
            chance[at] = np.where(context > 0, full, chance[at])
            shorter = np.zeros_like(shorter)
            shorter[at] = seen
            self.arcs.append(np.where(shorter > 0, np.log10(chance), np.nan))
        self.cost = [0.0, *(log10(1 - r) for r in trust[: len(totals) - 1])]
        first = block.which[0][block.starts[:1]]
        self.begin = int(len(totals) > 1 and len(first) and totals[0][first[0]] > 0)

    def read(self, start: int, end: int) -> float:
        """log10 probability of the words from start to end, read from left to right."""
        top, state, total, unknown, cost = len(self.arcs) - 1, self.begin, 0.0, self.unknown, self.cost
        for weights in zip(*(a[start:end].tolist() for a in self.arcs), strict=True):
            while (w := weights[state]) != w and state:
                total += cost[state]
                state -= 1
            if w != w:
                total += unknown
            else:
                total += w
                if state < top:
                    state += 1
        return total


def _read(order: int, facts: tuple[int, int, int, int], trust: tuple[float, ...], keep: list[str]):
    tokens, kinds = facts[:2]

    def read(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return None
        block = Block(docs["text"].to_pylist(), order)
        data = sorted(zip(*(answers[c].to_pylist() for c in ("n", "bucket", "counts")), strict=True), key=lambda r: r[:2])
        totals = [np.concatenate([np.zeros(0, np.uint64), *(unpack(c) for n, _, c in data if n == k)]).astype(np.int64) for k in range(1, order + 1)]
        automaton = Automaton(block, totals, facts, trust)
        single = totals[0][block.which[0]]
        single[block.starts] = -1  # the beginning is no token
        base = np.where(single >= 0, np.log10((np.maximum(single, 0) + 1) / (tokens + kinds + 1)), 0.0)
        scores = [automaton.read(a + 1, a + n) for a, n in zip(block.starts.tolist(), block.lengths.tolist(), strict=True)]
        made = {
            "n_tokens": pa.array(block.lengths - 1, pa.int64()), "n_known": pa.array(np.add.reduceat(single > 0, block.starts, dtype=np.int64), pa.int64()),
            "train_tokens": pa.array([tokens] * docs.num_rows, pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, block.starts), pa.float64()), "score": pa.array(scores, pa.float64()),
        }
        return pa.table([docs[f"k{i}"] for i in range(len(keep))] + list(made.values()), names=[*keep, *made])

    return read


def score_texts(
    df: DataFrame, taught: Column, *, text: str = "text", keep: list[str] = ("doc_id",), order: int = 2,
    trust: tuple[float, ...] = TRUST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns `keep` with n_tokens, n_known, train_tokens, base_score (add-one words) and score.  The model learns from the rows
    where `taught` is true and scores all rows."""
    if len(trust) < order - 1:
        raise ValueError("trust needs a value for each n-gram length from 2 on")
    spark = df.sparkSession
    kept = [col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    docs = df.select(col(text).cast("binary").alias("text"), F.coalesce(taught, F.lit(False)).alias("taught"), *kept)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(int(size // block_bytes) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = docs.where("taught").select("text").mapInArrow(_count_words(blocks), "bucket int, keys binary, counts binary")
    facts = words.groupBy("bucket").applyInArrow(_sum_words, "tokens long, kinds long, once long, twice long")
    facts = tuple(facts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "kinds", "once", "twice")]).first())
    # both uses of the blocks take the same columns, so that the texts are shuffled once
    docs = docs.withColumn("block", F.pmod(F.xxhash64("text", "k0"), F.lit(blocks)).cast("int"))
    answers = docs.groupBy("block").applyInArrow(_ask(order, blocks), ASKED).groupBy("bucket").applyInArrow(_answer, ANSWER)
    fields = [df.select(col(c)).schema[0] for c in keep]
    fields += [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_read(order, facts, trust, list(keep)), T.StructType(fields))
