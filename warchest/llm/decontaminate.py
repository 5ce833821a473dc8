"""Benchmark decontamination by greedy string tiling.

Texts are words (letters, digits and everything outside ASCII), lower case.  A document joins the test items with which it shares a
seed, a run of `least` words.  Seeds that cover too little of an item rule it out, since every tile consists of seeds.  For the
others tiles are made: find the greatest length at which an unmarked run of the item also stands unmarked in the
document (running Karp-Rabin hashes, a binary search over lengths), mark all such runs, earliest first, and go on with the rest
until no run of `least` words is left.  The share of the item's words that tiles cover is its coverage: tiles may stand in
any order, so rearranged passages are found.

Seeds of the items are a table, one row for each seed and item, and so are the seeds of the documents; a merge join meets them, which
adaptive execution splits where a seed is frequent.  Of the documents only seeds come that a filter of fixed size, built from the items' seeds,
lets through; it leaves work out, never a match, and where a benchmark outgrows it the join decides alone.  Covered places are
added up per document and item, and tiles are made for what is left, document by document.  Documents go by a digest of their text, so copies
are tiled once; the tiling reads the text itself.  With `block_bytes`, for small benchmarks, the items are sent to all tasks instead, in
blocks of that size and one pass over the documents a block; the rows are the same.

Results: one row for each document and item with enough coverage.  Missing and empty texts match nothing, nor do items shorter than
`least` words.  Of items with equal texts the smallest id stands for all.  Rows that repeat give repeated results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from warchest.llm.common import SPOOLED, col, map_texts, slices, spool, tidy
from warchest.llm.near_copies import FILTER, filter_of

LEAST = 5
COVERAGE = 0.5
SLICE = 4 << 20
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


def _prefix(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes (in the weights of their places) and the weights."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), _BASE, np.uint64)])
        sums = np.cumsum(np.r_[np.uint64(0), ids.astype(np.uint64) * power[:-1]], dtype=np.uint64)
    return sums, power


def windows(sums: np.ndarray, power: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of so many words that does not depend on its place."""
    n = len(sums) - 1
    with np.errstate(over="ignore"):
        return (sums[length:] - sums[: n + 1 - length]) * power[n - length :: -1][: n + 1 - length]


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    sums = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(sums[length:] == sums[: len(sums) - length])


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(item word, document word, words) of the tiles, longest first.  Word 0 of the document matches nothing."""
    mine, theirs = np.zeros(len(item), bool), doc == 0
    size = max(len(item), len(doc))
    both = [_prefix(np.r_[x, np.zeros(size - len(x), x.dtype)]) for x in (item, doc)]

    def shared(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = _free(mine, length), _free(theirs, length)
        ha, hb = windows(*both[0], length)[a], windows(*both[1], length)[b]
        order = np.argsort(hb, kind="stable")
        b, hb = b[order], hb[order]
        hit = np.isin(ha, hb)
        return a[hit], ha[hit], b, hb

    tiles, top = [], min(len(item), len(doc))
    while top >= least:
        low, high = least - 1, top
        while low < high:
            middle = (low + high + 1) // 2
            if len(shared(middle)[0]):
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        a, ha, b, hb = shared(low)
        for i, h in zip(a.tolist(), ha, strict=True):
            if mine[i : i + low].any():
                continue
            for j in b[np.searchsorted(hb, h) : np.searchsorted(hb, h, "right")].tolist():
                if not theirs[j : j + low].any() and np.array_equal(item[i : i + low], doc[j : j + low]):
                    mine[i : i + low] = theirs[j : j + low] = True
                    tiles.append((i, j, low))
                    break
        top = low if tiles and tiles[-1][2] == low and len(shared(low)[0]) else low - 1
    return tiles


class Items:
    """Seeds of the test items: `hashes` sorted, for each the places (in the items one after another) from start to start."""

    def __init__(self, items: list[tuple[object, bytes]], least: int) -> None:
        self.least, self.ids, self.vocabulary, parts = least, [], {}, []
        for number, text in items:
            words = words_of(text)
            if len(words) >= least:
                self.ids.append(number)
                parts.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.starts = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
        places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for p, start in zip(parts, self.starts, strict=False):
            h = self.seeds(p)
            places.append(start + np.arange(len(h)))
            hashes.append(h)
        h, places = np.concatenate(hashes), np.concatenate(places)
        order = np.lexsort((places, h))
        self.places, h = places[order], h[order]
        self.hashes, first = np.unique(h, return_index=True)
        self.first = np.r_[first, len(h)]
        self.parts = parts

    def seeds(self, ids: np.ndarray) -> np.ndarray:
        """Hashes of the runs of `least` words, each from the last by running on: weights by place within the run."""
        n = len(ids) - self.least + 1
        out, weight = np.zeros(max(n, 0), np.uint64), 1
        for k in range(self.least if n > 0 else 0):
            out += ids[k : k + n].astype(np.uint64) * np.uint64(weight)
            weight = weight * _BASE % (1 << 64)
        return out

    def matches(self, text: bytes | None, coverage: float) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(item, tiles) of the items that a text covers enough."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words_of(text)], np.int64)
        if len(ids) < self.least or not len(self.hashes):
            return
        h = self.seeds(ids)
        found = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[found] == h)
        if not len(at):
            return
        seeds = np.unique(found[at])
        places = np.sort(np.concatenate([self.places[self.first[s] : self.first[s + 1]] for s in seeds.tolist()]))
        owner = np.searchsorted(self.starts, places, "right") - 1
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        reach = np.minimum(np.r_[np.diff(places), self.least], self.least)
        reach[np.r_[begins[1:] - 1, len(places) - 1]] = self.least
        covered = np.add.reduceat(reach, begins)
        likely = [i for i, n in zip(owner[begins].tolist(), covered.tolist(), strict=True) if n >= coverage * len(self.parts[i])]
        if not likely:
            return
        inside = np.zeros(len(ids) + 1, np.int64)
        np.add.at(inside, at, 1)
        np.add.at(inside, at + self.least, -1)
        inside = np.cumsum(inside[:-1]) > 0
        stay = np.flatnonzero(inside | np.r_[False, inside[:-1]])  # one word between stretches parts them
        short = np.where(inside, ids, 0)[stay]
        for i in likely:
            tiles = tile(self.parts[i], short, self.least)
            if sum(t[2] for t in tiles) >= coverage * len(self.parts[i]):
                yield i, [(a, int(stay[b]), n) for a, b, n in tiles]


def _items(tests: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(text, item_id): the distinct items."""
    return tests.where(col(item_text).isNotNull()).groupBy(col(item_text).cast("binary").alias("text")).agg(F.min(col(item_id)).alias("item_id"))


def seeds_of(words: list[bytes], least: int) -> np.ndarray:
    """A hash of every run of `least` words, by place; for tables, it needs no vocabulary."""
    from xxhash import xxh3_64_intdigest

    n = len(words) - least + 1
    if n < 1:
        return np.zeros(0, np.int64)
    h, x = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)), np.zeros(n, np.uint64)
    for i in range(least):
        x = (x ^ h[i : i + n]) * np.uint64(_BASE)
        x ^= x >> np.uint64(32)
    return x.view(np.int64)


def item_seeder(least: int) -> Callable[[list], list[list]]:
    """The words of an item and its seeds."""

    def one(text: bytes) -> tuple[int, np.ndarray]:
        words = words_of(text)
        return len(words), seeds_of(words, least)

    return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]


def text_seeder(least: int, wanted: np.ndarray) -> Callable[[list], list[list]]:
    """The distinct seeds of a text that the filter lets through."""

    def one(text: bytes | None) -> np.ndarray:
        x = np.unique(seeds_of(words_of(text), least))
        at = np.mod(x, FILTER)
        return x[(wanted[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)]

    return lambda texts: [[one(t) for t in texts]]


def candidates(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    """(doc, item): what shares seeds enough to cover an item.  `docs` has doc and text, `items` item and text."""
    seeds = T.StructField("seeds", T.ArrayType(T.LongType()))
    asked = map_texts(items, "text", ["item"], [T.StructField("n", T.IntegerType()), seeds], lambda: item_seeder(least), binary=True)
    asked = asked.select("item", "n", F.posexplode("seeds").alias("place", "seed"))
    # a seed that an item repeats is one row with its places
    asked = asked.groupBy("seed", "item").agg(F.any_value("n").alias("n"), F.collect_list("place").alias("places"))
    wanted = filter_of(asked.select(F.col("seed").alias("node")))
    held = map_texts(docs, "text", ["doc"], [seeds], lambda: text_seeder(least, wanted), binary=True)
    held = held.select("doc", F.explode("seeds").alias("seed")).distinct()
    pairs = held.join(asked.hint("merge"), "seed").groupBy("doc", "item").agg(
        F.any_value("n").alias("n"), F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    first = F.struct(F.lit(-least).alias("last"), F.lit(0).alias("words"))
    covered = F.aggregate("places", first, lambda sofar, p: F.struct(
        p.alias("last"), (sofar["words"] + F.least(p - sofar["last"], F.lit(least))).alias("words")))
    return pairs.where(covered["words"] >= coverage * F.col("n")).select("doc", "item")


_TILE = ("item_word", "doc_word", "words")


def _tiler(least: int, coverage: float, schema: pa.Schema):
    def tiles_of(docs: pa.Table, items: pa.Table) -> pa.Table:
        if not docs.num_rows or not items.num_rows:
            return schema.empty_table()
        index = Items(list(enumerate(items["text"].to_pylist())), least)
        found = list(index.matches(docs["text"][0].as_py(), coverage))
        sizes = [len(index.parts[i]) for i, _ in found]
        return pa.table([
            pa.array([docs["doc"][0].as_py()] * len(found), schema.field(0).type),
            items["item_id"].take(pa.array([index.ids[i] for i, _ in found], pa.int64())),
            pa.array([sum(t[2] for t in tiles) / n for (_, tiles), n in zip(found, sizes, strict=True)], pa.float64()),
            pa.array(sizes, pa.int64()),
            pa.array([[dict(zip(_TILE, t, strict=True)) for t in tiles] for _, tiles in found], schema.field(4).type),
        ], schema=schema)

    return tiles_of


def _made(item_id: T.DataType) -> list[T.StructField]:
    tiles = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in _TILE]))
    return [T.StructField("item_id", item_id), T.StructField("coverage", T.DoubleType()), T.StructField("n_words", T.LongType()), T.StructField("tiles", tiles)]


def tilings(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    """(doc, item_id, coverage, n_words, tiles) of distinct texts.  `docs` has doc, the digest of the text, and text."""
    items = items.withColumn("item", F.md5("text"))
    near = spool(candidates(docs, items, least, coverage), "leaks")
    texts = docs.join(near.select("doc"), "doc", "left_semi").groupBy("doc").agg(F.any_value("text").alias("text"))
    asked = near.join(items, "item").select("doc", "item_id", "text")
    schema = T.StructType([T.StructField("doc", T.StringType()), *_made(items.schema["item_id"].dataType)])
    return texts.groupBy("doc").cogroup(asked.groupBy("doc")).applyInArrow(_tiler(least, coverage, to_arrow_schema(schema)), schema)


def _blocks(tests: DataFrame, item_id: str, item_text: str, block_bytes: int) -> tuple[DataFrame, list]:
    """The distinct items, and their (id, text) in blocks of about block_bytes, sent to all executors."""
    items = _items(tests, item_id, item_text)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    count, sent = int(size // block_bytes) + 1, []
    for b in range(count):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == b).orderBy("item_id", "text").collect()
        sent.append(tests.sparkSession.sparkContext.broadcast([(r.item_id, bytes(r.text)) for r in own]))
    return items, sent


def contaminated(
    df: DataFrame, tests: DataFrame, *, text: str = "text", keep: list[str] = ("doc_id",), item_id: str = "item_id", item_text: str = "text",
    least: int = LEAST, coverage: float = COVERAGE, block_bytes: int | None = None,
) -> DataFrame:
    """The columns `keep` with item_id, coverage, n_words (of the item), and tiles (item_word, doc_word, words)."""
    if block_bytes is None:
        rows = df.select(F.md5(col(text).cast("binary")).alias("\0doc"), *[col(c).alias(f"\0{i}") for i, c in enumerate(keep)])
        docs = df.select(F.md5(col(text).cast("binary")).alias("doc"), col(text).cast("binary").alias("text"))
        found = tilings(docs, _items(tests, item_id, item_text), least, coverage).withColumnRenamed("doc", "\0doc")
        out = rows.join(found, "\0doc")
        return out.select(*[col(f"\0{i}").alias(c) for i, c in enumerate(keep)], "item_id", "coverage", "n_words", "tiles")
    items, blocks = _blocks(tests, item_id, item_text, block_bytes)
    source = df.select(col(text).cast("binary").alias("\0text"), *[col(c) for c in keep])
    made = _made(items.schema["item_id"].dataType)
    schema = T.StructType([*source.schema.fields[1:], *made])
    kinds = list(to_arrow_schema(T.StructType(made)).types)

    def scanner(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(sent.value, least)
            for batch in batches:
                for part in slices(batch, 0, SLICE):
                    rows, out = [], []
                    for row, data in enumerate(part.column(0).to_pylist()):
                        for i, tiles in index.matches(data, coverage):
                            n = len(index.parts[i])
                            rows.append(row)
                            out.append((index.ids[i], sum(t[2] for t in tiles) / n, n, [dict(zip(_TILE, t, strict=True)) for t in tiles]))
                    if rows:
                        kept = part.take(pa.array(rows)).columns[1:]
                        arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays([*kept, *arrays], names=schema.fieldNames())

        return run

    # a stated query set against all rows, in blocks
    return reduce(DataFrame.unionAll, [source.mapInArrow(scanner(sent), schema) for sent in blocks])


def uncontaminated(
    df: DataFrame, tests: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    least: int = LEAST, coverage: float = COVERAGE, block_bytes: int | None = None,
) -> DataFrame:
    """The rows of df that cover no item enough."""
    names = df.columns
    if block_bytes is None:
        since = len(SPOOLED)
        docs = df.select(F.md5(col(text).cast("binary")).alias("doc"), col(text).cast("binary").alias("text"))
        found = tilings(docs, _items(tests, item_id, item_text), least, coverage)
        leaked = spool(found.select(F.col("doc").alias("\0doc")).distinct(), "leaked")
        tidy(df.sparkSession, since, leaked)
        rows = df.withColumn("\0doc", F.md5(col(text).cast("binary")))
        return rows.join(leaked, "\0doc", "left_anti").select(*[col(c) for c in names])

    def sieve(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(sent.value, least)
            for batch in batches:
                for part in slices(batch, 0, SLICE):
                    clean = [next(index.matches(data, coverage), None) is None for data in part.column(0).to_pylist()]
                    kept = part.filter(pa.array(clean, pa.bool_()))
                    yield pa.RecordBatch.from_arrays(kept.columns[1:], names=names)

        return run

    for sent in _blocks(tests, item_id, item_text, block_bytes)[1]:
        df = df.select(col(text).cast("binary").alias("\0text"), *[col(c) for c in df.columns]).mapInArrow(sieve(sent), df.schema)
    return df
