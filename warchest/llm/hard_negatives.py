"""Hard negatives by a GNAT-style tree: multiway hyperplane splits whose points keep distance ranges to their siblings' subtrees.

A row's components become whole numbers, floor(256 x); a score is the inner product with the anchor.  Distances need rows of one length, so
every row gets one more component that fills its norm up to the largest one; the anchor's is 0.  Then the score falls strictly with the
distance, and a window of scores is an annulus around the anchor.

The top of the tree are up to CELLS split points, chosen farthest first from a sample of SAMPLE rows; a row belongs to its nearest one.  A cell
is dealt to parts of about PART rows, however many rows one point attracts, and a task grows the rest of the part's tree the same way.
Point i keeps the least and largest distance to the rows of each sibling j, for all parts at the top as well.  By the triangle inequality a
subtree whose range does not meet the annulus of an anchor is left out; leaves are scored exactly, so the results are those of a full scan
whatever the sample was.  The tree is written once; anchors meet it in blocks of BLOCK, so what is broadcast is bounded.

First the best rows of the anchor's label are found (the annulus is a ball that shrinks with the fifth best score), then, for each of them, the
best rows of other labels whose score s satisfies share * positive <= s <= positive.

Results: rows with a missing label or vector, or with a missing or non-finite component, take no part.  Shorter vectors are filled
with 0.  Other rows are all rows but the anchor's own, also those that repeat its id.  A missing id is larger than all
others.  Equal rows each count.  Squared norms must stay below 2^52, else ValueError, as scores would not be exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from warchest.llm.common import col, spool

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative has at least this many hundredths of the positive's score.
SHARE = 80
SAMPLE, CELLS, PART = 4096, 1024, 8192
#: Children of a node and rows of a leaf inside a part.
WAYS, LEAF = 16, 256
#: Anchors searched at once.
BLOCK = 8192
LAST = np.iinfo(np.int64).max
NO_SCORE = -np.inf


def taken(df: DataFrame, anchor: Column, vec_id: str, label: str, vector: str) -> DataFrame:
    """(id, label, vec, anchor): the rows that take part, their components whole numbers."""
    real = F.transform(col(vector), lambda x: x.cast("double"))
    sound = ~F.exists(real, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(col(label).isNotNull() & col(vector).isNotNull() & sound)
    return rows.select(
        col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"),
        F.transform(real, lambda x: F.floor(x * SCALE)).alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of doubles, filled with 0."""
    starts = vectors.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(starts), vectors.flatten().to_numpy().astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    made = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    made[row, np.arange(len(flat)) - np.repeat(starts[:-1] - starts[0], sizes)] = flat
    return made


def lifted(vectors: np.ndarray, norm2: float) -> np.ndarray:
    """One more component brings all rows to the same norm."""
    more = np.sqrt(np.maximum(norm2 - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.c_[vectors, more]


def distances(points: np.ndarray, others: np.ndarray, norm2: float) -> np.ndarray:
    """Between lifted rows."""
    return np.sqrt(np.maximum(2 * (norm2 - points @ others.T), 0))


def farthest_first(points: np.ndarray, count: int, norm2: float) -> np.ndarray:
    """Points far from each other; fewer if the points are fewer."""
    chosen = [0]
    near = distances(points, points[:1], norm2)[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(points, points[chosen[-1:]], norm2)[:, 0])
    return points[chosen]


def grow(points: np.ndarray, norm2: float, ways: int = WAYS, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple]]:
    """The order of the rows, and the nodes of a tree over them, the root first.  A node is (low, high, split points, least, most, children):
    least[i, j] and most[i, j] bound the distances of point i to the rows of child j.  A leaf has no points."""
    order, nodes, todo = np.arange(len(points)), [], [(0, len(points))]
    nodes.append(None)
    todo = [(0, 0, len(points))]
    while todo:
        at, low, high = todo.pop()
        inside = order[low:high]
        nodes[at] = (low, high, None, None, None, [])
        if high - low <= leaf:
            continue
        some = points[inside[np.linspace(0, high - low - 1, min(high - low, 8 * ways)).astype(int)]]
        splits = farthest_first(some, ways, norm2)
        far = distances(points[inside], splits, norm2)
        nearest = far.argmin(axis=1)
        turn = np.argsort(nearest, kind="stable")
        held = np.flatnonzero(np.bincount(nearest, minlength=len(splits)))
        if len(held) < 2:  # equal rows, a leaf of any size
            continue
        order[low:high], far, nearest = inside[turn], far[turn], nearest[turn]
        edges = np.r_[np.searchsorted(nearest, held), high - low]
        least, most = (f.reduceat(far, edges[:-1], axis=0).T for f in (np.minimum, np.maximum))
        children = list(range(len(nodes), len(nodes) + len(held)))
        nodes += [None] * len(held)
        nodes[at] = (low, high, splits, least, most, children)
        todo += [(c, low + a, low + b) for c, a, b in zip(children, edges.tolist(), edges[1:].tolist(), strict=False)]
    return order, nodes


def surviving(far: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the distances between queries (far: queries x points) and the rows of subtrees (least, most: points x subtrees)."""
    above = np.zeros((len(far), least.shape[1]))
    below = np.full_like(above, np.inf)
    for i in range(far.shape[1]):  # a point at a time bounds the memory
        d = far[:, i : i + 1]
        np.maximum(above, np.maximum(least[i] - d, d - most[i]), out=above)
        np.minimum(below, d + most[i], out=below)
    return above, below


class Search:
    """The best rows of each anchor and window, over one or more parts of the tree."""

    def __init__(self, anchors: dict, norm2: float, *, same: bool, low: np.ndarray, high: np.ndarray, best: int):
        self.vec, self.label, self.row = anchors["vec"], anchors["label"], anchors["row"]
        self.norm2, self.same, self.low, self.high, self.best = norm2, same, low, high, best
        self.own = np.einsum("ij,ij->i", self.vec, self.vec)
        self.slack = 8 * np.sqrt(np.finfo(float).eps * (1 + self.vec.shape[1]) * 4 * (1 + norm2))
        shape = (*low.shape, best)
        self.scores, self.ids = np.full(shape, NO_SCORE), np.full(shape, LAST)
        self.missing, self.rows = np.zeros(shape, bool), np.full(shape, LAST)
        self.scored = 0

    def floor(self, some: np.ndarray) -> np.ndarray:
        """The least score that still counts, of each window."""
        return np.maximum(self.low[some], self.scores[some, :, -1])

    def annulus(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distances that an anchor's windows allow together."""
        reach = lambda score: np.sqrt(np.maximum(self.own[some] + self.norm2 - 2 * score, 0))
        return reach(self.high[some].max(axis=1)) - self.slack, reach(self.floor(some).min(axis=1)) + self.slack

    def to_points(self, some: np.ndarray, splits: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.own[some][:, None] + self.norm2 - 2 * self.vec[some] @ splits[:, :-1].T, 0))

    def walk(self, part: dict, some: np.ndarray) -> None:
        """Depth first, nearest children first; anchors leave a subtree that their annulus misses."""
        nodes = part["nodes"]
        stack = [(0, some, np.zeros(len(some)), np.full(len(some), np.inf))]
        while stack:
            at, some, above, below = stack.pop()
            inner, outer = self.annulus(some)
            stays = (above <= outer) & (below >= inner)
            some = some[stays]
            if not len(some):
                continue
            low, high, splits, least, most, children = nodes[at]
            if splits is None:
                for a in range(low, high, 4 * LEAF):
                    self.leaf(part, a, min(a + 4 * LEAF, high), some)
                continue
            above, below = surviving(self.to_points(some, splits), least, most)
            for j in np.argsort(-above.sum(axis=0)):
                stack.append((children[j], some, above[:, j], below[:, j]))

    def leaf(self, part: dict, low: int, high: int, some: np.ndarray) -> None:
        scores = self.vec[some] @ part["vec"][low:high].astype(np.float64).T
        self.scored += scores.size
        ids, missing, rows = (part[name][low:high] for name in ("id", "missing", "row"))
        agrees = self.label[some][:, None] == part["label"][low:high]
        fits = (agrees & (self.row[some][:, None] != rows)) if self.same else ~agrees
        for w in range(self.low.shape[1]):
            floor = self.floor(some)[:, w]
            found = np.where(fits & (scores >= floor[:, None]) & (scores <= self.high[some, w][:, None]), scores, NO_SCORE)
            gain = found.max(axis=1) > NO_SCORE
            if not gain.any():
                continue
            who, found = some[gain], found[gain]
            widen = lambda x: np.broadcast_to(x, found.shape)
            joined = [np.c_[a[who, w], b] for a, b in (
                (self.scores, found), (self.ids, widen(ids)), (self.missing, widen(missing)), (self.rows, widen(rows)))]
            turn = np.lexsort((joined[3], joined[2], joined[1], -joined[0]), axis=-1)[:, : self.best]
            for kept, x in zip((self.scores, self.ids, self.missing, self.rows), joined, strict=True):
                kept[who, w] = np.take_along_axis(x, turn, axis=1)

    def found(self) -> pa.RecordBatch:
        anchor, window, place = np.nonzero(self.scores > NO_SCORE)
        at = (anchor, window, place)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor.astype(np.int64)), pa.array(window.astype(np.int32)), pa.array(self.scores[at].astype(np.int64)),
             pa.array(self.ids[at], mask=self.missing[at]), pa.array(self.rows[at])], names=FOUND.fieldNames())


FOUND = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("window", T.IntegerType()), T.StructField("score", T.LongType()),
    T.StructField("id", T.LongType()), T.StructField("row", T.LongType())])


def assigner(width: int, norm2: float, sent, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the nearest split point and packs the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = matrix(batch.column(2), width)
            cell = (lifted(vec, norm2) @ sent.value.T).argmax(axis=1).astype(np.int32)
            packed = vec.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in packed], pa.binary()), batch.column(3), pa.array(cell)],
                names=["id", "label", "vec", "anchor", "cell"])

    return run


def unpacked(table: pa.Table | pa.RecordBatch, width: int, kind: str) -> dict:
    """Columns of packed rows as arrays."""
    raw = b"".join(table.column("vec").to_pylist())
    ids = table.column("id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return {
        "vec": np.frombuffer(raw, kind).reshape(table.num_rows, width), "label": table.column("label").to_numpy(), "row": table.column("row").to_numpy(),
        "id": ids.fill_null(LAST).to_numpy(), "missing": ids.is_null().to_numpy(zero_copy_only=False),
    }


def builder(width: int, norm2: float, sent, kind: str) -> Callable[[pa.Table], pa.Table]:
    """A part's rows and tree as one value, with its ranges to all split points of the top."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        part = unpacked(rows, width, kind)
        points = lifted(part["vec"].astype(np.float64), norm2)
        order, nodes = grow(points, norm2)
        far = distances(points, sent.value, norm2)
        whole = {**{name: x[order] for name, x in part.items()}, "nodes": nodes, "least": far.min(axis=0), "most": far.max(axis=0)}
        return pa.table({"tree": pa.array([pickle.dumps(whole)], pa.binary())})

    return run


def searcher(sent, centres, best: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Searches the parts of a task for a block of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(best=best, **sent.value)
        everyone = np.arange(len(search.vec))
        far = search.to_points(everyone, centres.value)
        for batch in batches:
            for tree in batch.column(0):
                part = pickle.loads(tree.as_py())
                above, below = surviving(far, part["least"][:, None], part["most"][:, None])
                inner, outer = search.annulus(everyone)
                some = everyone[(above[:, 0] <= outer) & (below[:, 0] >= inner)]
                if len(some):
                    search.walk(part, some)
        yield search.found()

    return run


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


class Index:
    """The tree of all rows, written as one row a part."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        n, norm2, width, large = rows.agg(
            F.count("*"), F.max(squares), F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double")))))).first()
        self.n, self.norm2, self.width = n, float(norm2 or 0), width or 0
        if self.norm2 >= 2**52:
            raise ValueError("squared norms must stay below 2^52")
        self.kind = "<i2" if (large or 0) < 2**15 else "<i4" if large < 2**31 else "<i8"
        if not n or not self.width:
            self.width = max(1, self.width)
        some = rows.select("vec").where(F.rand(7) < min(1.0, 1.5 * SAMPLE / max(1, n))).limit(SAMPLE).toArrow()
        some = matrix(some.column(0).combine_chunks(), self.width) if some.num_rows else np.zeros((1, self.width))
        top = farthest_first(lifted(some, self.norm2), min(CELLS, 1 + n // PART), self.norm2)
        self.centres = spark.sparkContext.broadcast(top)
        schema = T.StructType([
            T.StructField("id", T.LongType()), T.StructField("label", T.LongType()), T.StructField("vec", T.BinaryType()),
            T.StructField("anchor", T.BooleanType()), T.StructField("cell", T.IntegerType())])
        dealt = rows.mapInArrow(assigner(self.width, self.norm2, self.centres, self.kind), schema)
        # the row number is written with the rows, so it stays the same
        self.rows = spool(dealt.withColumn("row", F.monotonically_increasing_id()), "rows")
        sizes = self.rows.groupBy("cell").agg((1 + F.floor(F.count("*") / PART)).alias("parts"))  # at most CELLS rows
        part = F.struct("cell", F.pmod(F.xxhash64("row"), F.col("parts")).alias("piece"))
        parts = self.rows.join(F.broadcast(sizes), "cell").select("id", "label", "vec", "row", part.alias("part"))
        trees = parts.groupBy("part").applyInArrow(builder(self.width, self.norm2, self.centres, self.kind), "tree binary")
        self.trees = spool(trees, "trees")

    def search(self, anchors: dict, *, same: bool, low: np.ndarray, high: np.ndarray, best: int) -> DataFrame:
        """(anchor, window, score, id, row, rank) of the best rows in each window of each anchor."""
        sent = self.rows.sparkSession.sparkContext.broadcast(
            {"anchors": anchors, "norm2": self.norm2, "same": same, "low": low, "high": high})
        return _ranked(self.trees.mapInArrow(searcher(sent, self.centres, best), FOUND), best)


def _block(index: Index, anchors: pa.Table, positives: int, negatives: int, share: int) -> DataFrame:
    """The result for one block of anchors."""
    spark = index.rows.sparkSession
    block = unpacked(anchors, index.width, index.kind)
    block["vec"] = block["vec"].astype(np.float64)
    n = anchors.num_rows
    wide = lambda value, k: np.full((n, k), value)
    near = index.search(block, same=True, low=wide(NO_SCORE, 1), high=wide(np.inf, 1), best=positives).toArrow()  # n * positives rows
    anchor, place = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
    score = near["score"].to_numpy().astype(np.int64)
    low, high = wide(np.inf, positives), wide(NO_SCORE, positives)
    # share * p <= 100 * s <= 100 * p; empty where p is negative
    low[anchor, place], high[anchor, place] = -((-share * score) // 100), score
    found = index.search(block, same=False, low=low, high=high, best=negatives)
    of = pa.table({
        "anchor": near["anchor"], "window": pa.array(place.astype(np.int32)), "anchor_id": pa.array(block["id"][anchor], mask=block["missing"][anchor]),
        "positive_id": near["id"], "positive_score": near["score"]})
    of = spark.createDataFrame(of)
    return found.join(F.broadcast(of), ["anchor", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(
    df: DataFrame, anchor: Column, *, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE, block: int = BLOCK,
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    index = Index(taken(df, anchor, vec_id, label, vector))
    chosen = index.rows.where("anchor")
    blocks = 1 + chosen.count() // block
    results = []
    for b in range(blocks):
        anchors = chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").toArrow()
        found = _block(index, anchors, positives, negatives, share)
        results.append(found if blocks == 1 else spool(found, "negatives"))
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return whole
