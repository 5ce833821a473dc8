"""Ranked lexical search with a document FP-tree, searched depth first by branch and bound.

The items are the queries, all documents are searched.  A document is restricted to the items' terms, and these stand in descending order
of the documents that hold them, so documents share the paths of a trie.  A task builds the tree of a slab of documents: a node is a run of
the sorted documents and keeps, for its subtree, the largest tf of each term and the smallest m.  A term's share of a score rises
with tf and falls with m, so these bound every score below.  The search goes down depth first, the most promising child first; an
item leaves a subtree as soon as its bound is below the item's tenth best score so far.  Leaves are scored exactly.

No shuffle of texts or vectors: restricted vectors are written once, every task searches its own slabs, and only its best rows per item are
ranked together.  Items go in blocks of bounded size (`block` terms), each against all documents; a block's terms and weights are what is
broadcast.  The statistics (N, L, df) cover all documents.

Results: a missing text or item has no term; so an item without terms, or with terms in no document, has no rows.  A missing doc_id ranks
after all others of the same score.  Repeated documents each count and rank; repeated items (rows of `items`) get their rows each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from warchest.llm.common import col, map_texts, spool

BEST = 10
#: Terms of the items of one block, repeats included.
BLOCK = 1 << 16
#: Documents and postings of one tree, and documents of a leaf.
SLAB, POSTINGS, LEAF = 8192, 1 << 21, 16
#: A term is a run of ASCII letters, digits and characters beyond ASCII.
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
LAST = np.iinfo(np.int64).max


def term_list(text: bytes | None) -> list[bytes]:
    """The terms of a text, in order, repeats included."""
    return (text or b"").translate(_SPLIT).split()


def share(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass(frozen=True)
class Queries:
    """A block of items.  Terms are numbered by falling df; item i has terms[starts[i]:starts[i+1]], each times its repeats."""

    starts: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray
    weight: np.ndarray

    def scores(self, parts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Scores of rows of `parts` (rows x terms) for some items, each with at least one term."""
        sizes = self.starts[items + 1] - self.starts[items]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(self.starts[items], sizes)
        return np.add.reduceat(parts[:, self.terms[at]] * self.repeats[at], ends - sizes, axis=1)


@dataclass
class Node:
    """Documents low to high of the sorted slab that agree in their first `depth` terms."""

    low: int
    high: int
    terms: np.ndarray
    most: np.ndarray
    least_m: int
    children: list["Node"]


class Tree:
    """The FP-tree of a slab: starts, terms and tfs hold the restricted vectors, terms ascending within a document."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, leaf: int = LEAF):
        order = sorted(range(len(m)), key=lambda i: terms[starts[i] : starts[i + 1]].astype(">u4").tobytes())
        self.order = np.array(order, np.int64)
        sizes = np.diff(starts)[self.order]
        self.starts = np.r_[0, np.cumsum(sizes)]
        at = np.arange(self.starts[-1]) - np.repeat(self.starts[:-1], sizes) + np.repeat(starts[self.order], sizes)
        self.terms, self.tfs, self.m, self.leaf = terms[at], tfs[at], m[self.order], leaf
        self.root = self.grow() if len(m) else None

    def _node(self, low: int, high: int) -> Node:
        a, b = self.starts[low], self.starts[high]
        terms, where = np.unique(self.terms[a:b], return_inverse=True)
        most = np.zeros(len(terms), np.int64)
        np.maximum.at(most, where, self.tfs[a:b])
        return Node(low, high, terms, most, int(self.m[low:high].min()), [])

    def _runs(self, edges: list[int]) -> list[int]:
        """Small neighbours become one leaf."""
        kept = edges[:1]
        for a, b in zip(edges[1:], [*edges[2:], None], strict=True):
            if b is None or b - kept[-1] > self.leaf:
                kept.append(a)
        return kept

    def grow(self) -> Node:
        """Splits runs by their next term, without recursion, since a path is as long as a document has terms."""
        root = self._node(0, len(self.m))
        todo = [(root, 0)]
        while todo:
            node, depth = todo.pop()
            while node.high - node.low > self.leaf:
                first, sizes = self.starts[node.low : node.high], np.diff(self.starts[node.low : node.high + 1])
                # what ends here comes first
                following = np.where(sizes > depth, self.terms[np.minimum(first + depth, len(self.terms) - 1)] if len(self.terms) else -1, -1)
                cuts = np.flatnonzero(following[1:] != following[:-1]) + 1
                if len(cuts):
                    edges = self._runs([node.low, *(cuts + node.low).tolist(), node.high])
                    node.children = [self._node(a, b) for a, b in zip(edges, edges[1:], strict=False)]
                    todo += [(child, depth + 1) for child in node.children] if len(edges) > 2 else []
                    break
                if following[0] < 0:  # equal vectors, a leaf of any size
                    break
                depth += 1  # all share the next term: the path has no branch
        return root


class Search:
    """The best documents of each item of a block over one or more trees."""

    def __init__(self, queries: Queries, best: int = BEST):
        n = len(queries.starts) - 1
        self.queries, self.best = queries, best
        self.scores, self.ids = np.zeros((n, best), np.int64), np.full((n, best), LAST, np.int64)
        self.missing = np.zeros((n, best), bool)
        self.scored = self.bounded = 0

    def bounds(self, node: Node, items: np.ndarray) -> np.ndarray:
        parts = np.zeros((1, len(self.queries.weight)), np.int64)
        parts[0, node.terms] = share(self.queries.weight[node.terms], node.most, node.least_m)
        self.bounded += 1
        return self.queries.scores(parts, items)[0]

    def hopeful(self, bounds: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Items that could still gain: a tie with the last place may have the smaller id."""
        return items[(bounds > 0) & (bounds >= self.scores[items, -1])]

    def run(self, tree: Tree, ids: np.ndarray, missing: np.ndarray) -> None:
        items = np.flatnonzero(np.diff(self.queries.starts))
        if tree.root is None or not len(items):
            return
        stack = [(tree.root, items, self.bounds(tree.root, items))]
        while stack:
            node, items, bounds = stack.pop()
            items = self.hopeful(bounds, items)  # the tenth best may have risen since
            if not len(items):
                continue
            if node.children:
                below = [(child, items, self.bounds(child, items)) for child in node.children]
                stack += sorted(below, key=lambda x: int(x[2].max()))
            else:
                for low in range(node.low, node.high, LEAF):
                    self.visit(tree, low, min(low + LEAF, node.high), items, ids, missing)

    def visit(self, tree: Tree, low: int, high: int, items: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """Scores the documents of a leaf and keeps the best."""
        a, b = tree.starts[low], tree.starts[high]
        rows = np.repeat(np.arange(high - low), np.diff(tree.starts[low : high + 1]))
        parts = np.zeros((high - low, len(self.queries.weight)), np.int64)
        parts[rows, tree.terms[a:b]] = share(self.queries.weight[tree.terms[a:b]], tree.tfs[a:b], tree.m[low:high][rows])
        found = self.queries.scores(parts, items).T
        self.scored += high - low
        gain = (found.max(axis=1) > 0) & (found.max(axis=1) >= self.scores[items, -1])
        items, found = items[gain], found[gain]
        if not len(items):
            return
        source = tree.order[low:high]
        widen = lambda x: np.broadcast_to(x[source], (len(items), high - low))
        scores = np.c_[self.scores[items], found]
        new_ids, new_missing = np.c_[self.ids[items], widen(ids)], np.c_[self.missing[items], widen(missing)]
        turn = np.lexsort((new_missing, new_ids, -scores), axis=-1)[:, : self.best]
        pick = lambda x: np.take_along_axis(x, turn, axis=1)
        self.scores[items], self.ids[items], self.missing[items] = pick(scores), pick(new_ids), pick(new_missing)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Item, score, id and whether the id is missing, of all places taken."""
        item, place = np.nonzero(self.scores > 0)
        return item, self.scores[item, place], self.ids[item, place], self.missing[item, place]


def restrictor(vocabulary: dict[bytes, int]) -> Callable[[list], list[list]]:
    """A text's number of terms, and numbers and tfs of its terms that are in the vocabulary."""

    def one(text: bytes | None) -> tuple[int, list[int], list[int]]:
        found = term_list(text)
        seen = Counter(found)
        known = sorted((vocabulary[t], seen[t]) for t in seen.keys() & vocabulary.keys())
        return len(found), [t for t, _ in known], [c for _, c in known]

    return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]


def item_blocks(items: DataFrame, item_id: str, text: str, block: int) -> DataFrame:
    """(row, item_id, terms, block): each item's terms, dealt to blocks of about `block` terms."""
    made = [T.StructField("terms", T.ArrayType(T.BinaryType()), False)]
    source = items.select(col(item_id).alias("item_id"), col(text).alias("text"))
    found = map_texts(source, "text", ["item_id"], made, lambda: lambda texts: [[term_list(t) for t in texts]], binary=True)
    found = spool(found.withColumn("row", F.monotonically_increasing_id()), "items")
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    return found.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(1 + total // block)))


def queries_of(items: list[tuple], df: dict[bytes, int], n_docs: int) -> tuple[Queries, list[bytes]]:
    """The block's items, and its terms by falling df."""
    order = sorted({t for _, terms in items for t in terms}, key=lambda t: (-df.get(t, 0), t))
    number = {t: i for i, t in enumerate(order)}
    starts, terms, repeats = [0], [], []
    for _, of in items:
        for t, c in sorted(Counter(of).items(), key=lambda x: number[x[0]]):
            terms.append(number[t])
            repeats.append(c)
        starts.append(len(terms))
    # 2N+2 and 2df+1 as doubles, the quotient's logarithm, rounded down
    weight = [int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))) for t in order]
    as_long = lambda x: np.array(x, np.int64)
    return Queries(as_long(starts), as_long(terms), as_long(repeats), as_long(weight)), order


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record batches of at most SLAB documents and POSTINGS postings (or of one document)."""
    for batch in batches:
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        start = total = 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and (total + n > POSTINGS or i - start >= SLAB):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)


def searcher(sent, numbers, n_docs: int, all_terms: int, best: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Searches the slabs of a task: sent holds the block's queries, numbers the place of each of its terms in the order of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, number = Search(sent.value, best), numbers.value
        for batch in _slabs(batches):
            ids, missing = batch.column(0).fill_null(LAST).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            starts = batch.column(2).offsets.to_numpy().astype(np.int64)
            starts -= starts[0]
            # the order by df within a document
            terms, tfs = number[batch.column(2).flatten().to_numpy()], batch.column(3).flatten().to_numpy().astype(np.int64)
            turn = np.lexsort((terms, np.repeat(np.arange(len(ids)), np.diff(starts))))
            m = 25 + (75 * batch.column(1).to_numpy() * n_docs) // max(1, all_terms)
            search.run(Tree(starts, terms[turn], tfs[turn], m), ids, missing)
        item, score, ids, missing = search.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(ids, mask=missing), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, items: list[tuple], best: int) -> DataFrame:
    """(item, rank, doc_id, score) of the items of one block, items by their place in the list."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    words = spark.sparkContext.broadcast(vocabulary)
    made = [
        T.StructField("n", T.LongType(), False), T.StructField("terms", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("tfs", T.ArrayType(T.LongType(), False), False)]
    vectors = spool(map_texts(docs, "text", ["doc_id"], made, lambda: restrictor(words.value), binary=True), "vectors")
    n_docs, all_terms = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the block's terms
    df = {r["term"]: r["count"] for r in held}
    queries, order = queries_of(items, {t: df.get(i, 0) for t, i in vocabulary.items()}, n_docs)
    number = np.zeros(len(order), np.int64)
    number[[vocabulary[t] for t in order]] = np.arange(len(order))
    sc = spark.sparkContext
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = vectors.where(F.size("terms") > 0).mapInArrow(
        searcher(sc.broadcast(queries), sc.broadcast(number), n_docs, all_terms, best), schema)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= best)


def search(
    docs: DataFrame, items: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
    best: int = BEST, block: int = BLOCK,
) -> DataFrame:
    """One row per item and place: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    source = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    dealt = item_blocks(items, item_id, item_text, block)
    kind = dealt.schema["item_id"].dataType
    blocks = [r["block"] for r in dealt.select("block").distinct().orderBy("block").collect()]
    results = []
    for b in blocks:
        rows = dealt.where(F.col("block") == b).orderBy("row").select("item_id", "terms").collect()
        rows = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in rows]
        found = _search_block(source, rows, best)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], T.StructType([
            T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
        found = found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        results.append(found if len(blocks) == 1 else spool(found, "ranked"))
    if not results:
        empty = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                              T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], empty)
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return whole
