"""Toxicity by a counterfactual-regularised classifier.

Features are the distinct words of a text, hashed.  Three steps:
1. Over all labelled training rows, count in how many toxic and how many other rows each feature occurs (a count for each of
   2**BITS features, however many rows there are) and keep the `features` that tell the classes apart most.  Identity terms are
   kept too, so that they can be held in check.
2. Over a sample of at most about `sample` labelled training rows, make the kept features of each text and of its counterfactual,
   in which every identity term is swapped for another of its group.
3. Fit a logistic regression on both: log loss on the labels, plus `penalty` times the squared change of the log-odds under the
   swap, plus a small ridge.  A term that says nothing but which group is meant gets no weight of its own.
Scoring is one pass with the weights broadcast.

Results: a missing or empty text has no features and gets the score of the bias.  Rows without a label or a text that is there teach
nothing.  If nothing was taught, or one class only, all scores are the share of toxic rows (0 without rows).  A label that repeats
counts as often; a missing id has no label.  Rows are independent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from warchest.llm.common import col, map_texts, spool

BITS = 20
FEATURES = 4096
SAMPLE = 20_000
PENALTY = 1.0
RIDGE = 1e-3
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Identity terms by group; a term is swapped for the next of its group.
GROUPS = [
    "women men", "woman man", "girls boys", "girl boy", "female male", "wives husbands", "mothers fathers", "transgender cisgender",
    "gay straight lesbian bisexual queer", "gays heterosexuals lesbians", "muslim christian jewish hindu buddhist sikh atheist",
    "muslims christians jews hindus buddhists sikhs atheists", "islam christianity judaism hinduism buddhism",
    "black white asian latino hispanic", "africans europeans asians americans", "african european american", "arab indian chinese mexican",
    "arabs indians mexicans russians", "immigrants natives refugees citizens", "immigrant native refugee citizen", "blind deaf disabled",
    "old young elderly", "poor rich", "frauen männer", "frau mann", "muslime christen juden", "femmes hommes", "femme homme",
    "musulmans chrétiens juifs", "mujeres hombres", "mujer hombre", "musulmanes cristianos judíos",
]
SWAPS = {a.encode(): b.encode() for g in GROUPS for a, b in zip(g.split(), [*g.split()[1:], g.split()[0]], strict=True)}


def words_of(text: bytes | None) -> set[bytes]:
    return set((text or b"").translate(_PLAIN).split())


def hasher() -> Callable[[set[bytes]], np.ndarray]:
    from xxhash import xxh32_intdigest

    return lambda words: np.unique(np.fromiter((xxh32_intdigest(w) >> (32 - BITS) for w in words), np.int32, len(words)))


@dataclass
class Model:
    bias: float
    kept: np.ndarray  # feature hashes, ascending
    weights: np.ndarray

    def table(self) -> np.ndarray:
        full = np.zeros(1 << BITS)
        full[self.kept] = self.weights
        return full


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(toxic, own, other): features of each labelled text and of its counterfactual.  Texts become features before they meet the labels."""
    def start():
        features = hasher()

        def work(texts: list) -> list[list]:
            sets = [words_of(t) for t in texts]
            own = [features(s) for s in sets]
            other = [features({SWAPS.get(w, w) for w in s}) if not SWAPS.keys().isdisjoint(s) else None for s in sets]
            return [own, other]

        return work

    kind = T.ArrayType(T.IntegerType())
    taught = docs.where(col(text).isNotNull() & col(doc_id).isNotNull()).select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    made = map_texts(taught, "text", ["doc_id"], [T.StructField("own", kind), T.StructField("other", kind)], start, binary=True)
    marks = labels.where(col(label).isNotNull()).select(col(doc_id).alias("doc_id"), (col(label) > 0).cast("int").alias("toxic"))
    # labels grow with the documents: never broadcast
    return made.join(marks.hint("merge"), "doc_id").select("doc_id", "toxic", "own", "other")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        rows = np.repeat(toxic, np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy(zero_copy_only=False)
        for y in (0, 1):
            table[y] += np.bincount(values[rows == y], minlength=1 << BITS)
    used = np.flatnonzero(table.any(0)).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[0, used]), pa.array(table[1, used])], names=["feature", "n0", "n1"])


def fit(own: list[np.ndarray], other: list[np.ndarray | None], toxic: np.ndarray, width: int, *, penalty: float, ridge: float, steps: int = 200) -> tuple[float, np.ndarray]:
    """Bias and weights.  Rows are indices of present features."""
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return float(np.log(share / (1 - share))), np.zeros(width)

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)

    row, feature = flat(own)
    swapped = [i for i, o in enumerate(other) if o is not None]
    row_a, feature_a = flat([own[i] for i in swapped])
    row_b, feature_b = flat([other[i] for i in swapped])
    n, m = len(toxic), max(len(swapped), 1)
    total = lambda r, f, w, k: np.bincount(r, w[f], k)
    back = lambda r, f, g: np.bincount(f, g[r], width)

    def slope(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = total(row, feature, w, n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) / n
        change = (total(row_a, feature_a, w, m) - total(row_b, feature_b, w, m)) * (2 * penalty / m)
        return back(row, feature, error) + back(row_a, feature_a, change) - back(row_b, feature_b, change) + ridge * w, float(error.sum())

    # gradient steps scaled by running squares: rare and common features move alike
    w, b = np.zeros(width), float(np.log(toxic.mean() / (1 - toxic.mean())))
    mean, square, mean_b, square_b = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, steps + 1):
        g, gb = slope(w, b)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        mean_b, square_b = 0.9 * mean_b + 0.1 * gb, 0.99 * square_b + 0.01 * gb * gb
        rate = 0.2 * (1 - t / (steps + 1))
        w = w - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
        b -= rate * (mean_b / (1 - 0.9**t)) / (np.sqrt(square_b / (1 - 0.99**t)) + 1e-9)
    return b, w


def train(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    features: int = FEATURES, sample: int = SAMPLE, penalty: float = PENALTY, ridge: float = RIDGE,
) -> Model:
    """docs: the rows to learn from.  The fit sees a sample of about `sample` labelled rows, chosen by a hash of the id; the choice of
    features sees them all."""
    rows = spool(labelled(docs, labels, doc_id, text, label), "features")
    counts = rows.select("toxic", "own").mapInArrow(_count, "feature int, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    classes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = classes.get(0, 0), classes.get(1, 0)
    always = np.unique(hasher()(set(SWAPS))).tolist()
    both = F.col("n0") + F.col("n1")
    share = both / max(n0 + n1, 1)
    apart = F.abs(F.col("n1") / max(n1, 1) - F.col("n0") / max(n0, 1)) / F.sqrt(share * (1.0 + 1.0 / max(n0 + n1, 1) - share))
    best = counts.where(both >= 2).orderBy(apart.desc(), "feature").limit(features).select("feature").collect()
    kept = np.unique(np.array([*always, *(r.feature for r in best)], np.int32))
    here = F.lit(kept.tolist())
    narrow = lambda c: F.array_intersect(F.col(c), here).alias(c)
    parts = 1 << 20
    wanted = min(1.0, sample / max(n0 + n1, 1))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(parts)) < int(wanted * parts))
    data = chosen.select("doc_id", "toxic", narrow("own"), narrow("other")).toPandas()  # about `sample` rows of kept features
    data = data.sort_values(["doc_id", "toxic"], kind="stable")
    place = lambda values: None if values is None else np.searchsorted(kept, np.sort(np.asarray(values, np.int32)))
    bias, weights = fit([place(v) for v in data["own"]], [place(v) for v in data["other"]], data["toxic"].to_numpy(float), len(kept), penalty=penalty, ridge=ridge)
    return Model(bias, kept, weights)


def score(df: DataFrame, model: Model, *, text: str = "text", keep: list[str] = ("doc_id",), made: str = "score") -> DataFrame:
    """The columns `keep` and a score from 0 to 1.  Only the text decides."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        full, bias, features = sent.value.table(), sent.value.bias, hasher()

        def one(text: bytes | None) -> float:
            z = bias + full[features(words_of(text))].sum()
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return lambda texts: [[one(t) for t in texts]]

    return map_texts(df, text, list(keep), [T.StructField(made, T.DoubleType(), False)], start, binary=True)


def verdict(scored: Column) -> Column:
    return (scored >= 0.5).cast("int")
