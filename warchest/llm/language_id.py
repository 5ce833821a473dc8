"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every other run of characters is one blank.  An n-gram is a letter, two neighbours, or three with a
letter in the middle; it is hashed to a bucket.  Training counts buckets per language over all given rows (per task, then
summed by Spark).  The matrix of log-probabilities (buckets x languages, in 1/65536) is broadcast, `block` languages at a time, so each
matrix is bounded; a text meets one block after the other in the same task.  Scoring gathers matrix rows for a window of characters at a time and adds
them up per document, so memory does not depend on the length of a text; whole numbers make sums independent of batches.

Results: a text that is missing or has no letter is `und` with score 0.  Rows without a text, a letter or a language teach
nothing.  If nothing was taught, every text is `und`.  Rows are independent: repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from warchest.llm.common import col, map_texts, slices

UNKNOWN = "und"
BITS = 16
#: Weight of evidence: a text counts as at most so many n-grams, so that the score tells how clear, not how long, it is.
EVIDENCE = 64
UNIT = 1 << 16
WINDOW = 1 << 18
#: Languages of one matrix.
BLOCK = 256


def letter_table() -> bytes:
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)).tobytes()


def grams(texts: list, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the n-grams, rows ascending, a window of characters at a time."""
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(-1, len(low), dtype=np.int32), [1, *(len(t) + 1 for t in low)])
    word = letters[codes]
    stay = word.copy()
    stay[0] = True
    stay[1:] |= word[:-1]  # the first blank after a letter
    codes, row, word = np.where(word, codes, 32).astype(np.uint32)[stay], row[stay], word[stay]
    shift = np.uint32(32 - BITS)
    for at in range(1, len(codes), WINDOW):
        end = min(at + WINDOW, len(codes))
        c, b, r = codes[at:end], codes[at - 1 : end - 1], row[at:end]
        one = word[at:end]
        yield r[one], (c[one] * np.uint32(2654435761)) >> shift
        two = c * np.uint32(2246822519) + b * np.uint32(3266489917)
        yield r, (two ^ (two >> np.uint32(15))) * np.uint32(668265263) >> shift
        three = word[at - 1 : end - 1] & (np.arange(at, end) > 1)
        a = codes[np.maximum(np.arange(at - 2, end - 2), 0)][three]
        mix = two[three] + a * np.uint32(374761393) + np.uint32(1)
        yield r[three], (mix ^ (mix >> np.uint32(13))) * np.uint32(1274126177) >> shift


@dataclass
class Model:
    """A block of languages; `more` are the models of further blocks."""

    languages: list[str]
    matrix: np.ndarray  # int32, bucket x language
    prior: np.ndarray  # int64, language
    letters: bytes
    more: list[Model] = field(default_factory=list)


def _letters(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)


def train(df: DataFrame, *, text: str = "text", lang: str = "lang", block: int = BLOCK, alpha: float = 0.5) -> Model:
    """Counts over every row of df; the languages are dealt to blocks, so that no matrix has more than `block` columns."""
    import pyarrow as pa

    packed = letter_table()
    sent = df.sparkSession.sparkContext.broadcast(packed)

    def count(batches):
        letters, tables, rows = _letters(sent.value), {}, {}
        for batch in batches:
            for part in slices(batch, 0, 2 << 20):
                texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
                for one in set(langs):
                    if one not in tables:
                        tables[one] = np.zeros(1 << BITS, np.int64)
                        rows[one] = 0
                    own = [t for t, x in zip(texts, langs, strict=True) if x == one]
                    for _, bucket in grams(own, letters):
                        tables[one] += np.bincount(bucket, minlength=1 << BITS)
                    rows[one] += len(own)
        for one, counts in tables.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([one] * (len(used) + 1), pa.string()), pa.array([-1, *used.tolist()], pa.int32()),
                 pa.array([rows[one], *counts[used].tolist()], pa.int64())], names=["lang", "bucket", "n"])

    taught = df.select(col(text).cast("string").alias("text"), col(lang).cast("string").alias("lang"))
    taught = taught.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = taught.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = counted.persist()
    heads = dict(sorted((r.lang, r.n) for r in counted.where("bucket = -1").collect()))
    known = counted.where("bucket >= 0")
    names = sorted(r.lang for r in known.select("lang").distinct().collect())
    total, blocks = sum(heads[x] for x in names), []
    for at in range(0, len(names), block):
        of = names[at : at + block]
        table = known.where(F.col("lang").isin(of)).toPandas()  # block x buckets at most
        n = np.zeros((1 << BITS, len(of)))
        n[table["bucket"].to_numpy(), table["lang"].map({x: i for i, x in enumerate(of)}).to_numpy(int)] = table["n"].to_numpy()
        logs = np.log((n + alpha) / (n.sum(0) + alpha * (1 << BITS)))
        prior = np.log(np.array([heads[x] for x in of], float) / total)
        blocks.append(Model(of, np.rint(logs * UNIT).astype(np.int32), np.rint(prior * UNIT).astype(np.int64), packed))
    counted.unpersist()
    first = blocks[0] if blocks else Model([], np.zeros((1 << BITS, 0), np.int32), np.zeros(0, np.int64), packed)
    first.more = blocks[1:]
    return first


def weigher(block: Model) -> Callable[[list], list[list]]:
    """A function from texts to the best language of the block, its evidence, and the log of the sum over all its languages."""
    letters, k = _letters(block.letters), len(block.languages)

    def work(texts: list) -> list[list]:
        total, seen = np.zeros((len(texts), k), np.int64), np.zeros(len(texts), np.int64)
        for row, bucket in grams(texts, letters):
            step = max(4096, (1 << 21) // k)
            for at in range(0, len(row), step):
                r = row[at : at + step]
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                total[r[first]] += np.add.reduceat(block.matrix[bucket[at : at + step]], first, axis=0, dtype=np.int64)
                seen[r[first]] += np.diff(np.r_[first, len(r)])
        evidence = np.minimum(1.0, EVIDENCE / np.maximum(seen, 1))[:, None] * (total / UNIT) + block.prior / UNIT
        best = evidence.argmax(1)  # of equals the first by name
        top = evidence[np.arange(len(texts)), best]
        every = top + np.log(np.exp(evidence - top[:, None]).sum(1))
        name = [
            block.languages[b] if n and any(map(str.isalpha, t or "")) else UNKNOWN
            for b, n, t in zip(best.tolist(), seen.tolist(), texts, strict=True)]
        return [name, top.tolist(), every.tolist()]

    return work


def scorer(model: Model) -> Callable[[list], list[list]]:
    """A function from texts to the language and its score, of a model of one block."""
    if not model.languages:
        return lambda texts: [[UNKNOWN] * len(texts), [0.0] * len(texts)]
    weigh = weigher(model)

    def work(texts: list) -> list[list]:
        name, top, every = weigh(texts)
        return [name, [0.0 if n == UNKNOWN else float(np.exp(t - e)) for n, t, e in zip(name, top, every, strict=True)]]

    return work


def predict(
    df: DataFrame, model: Model, *, text: str = "text", keep: list[str] = ("doc_id",), made: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns `keep` with the language and a score from 0 to 1.  Only the text decides.  Blocks of languages are scored one after
    the other in the same task; the best of all and the sum over all go on."""
    sc, keep = df.sparkSession.sparkContext, list(keep)
    if not model.more:
        sent = sc.broadcast(model)
        fields = [T.StructField(made[0], T.StringType(), False), T.StructField(made[1], T.DoubleType(), False)]
        return map_texts(df, text, keep, fields, lambda: scorer(sent.value))
    blocks = [replace(m, more=[]) for m in (model, *model.more)]
    found, state = df.select(col(text).alias("\0scored"), *[col(c) for c in keep]), []
    for i, block in enumerate(blocks):
        fields = [T.StructField(f"\0{part}{i}", kind, False) for part, kind in (("lang", T.StringType()), ("top", T.DoubleType()), ("every", T.DoubleType()))]
        on = ["\0scored"] if i + 1 < len(blocks) else []
        found = map_texts(found, "\0scored", [*on, *keep, *state], fields, lambda sent=sc.broadcast(block): weigher(sent.value))
        state += [f.name for f in fields]
    parts = F.array(*[F.struct(
        (-col(f"\0top{i}")).alias("low"), F.lit(i).alias("block"), col(f"\0lang{i}").alias("lang"), col(f"\0every{i}").alias("every"))
        for i in range(len(blocks))])
    best = F.array_min(parts)
    every = F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.exp(p["every"] + best["low"]))
    score = F.when(best["lang"] != UNKNOWN, 1 / every).otherwise(F.lit(0.0))
    return found.select(*[col(c) for c in keep], best["lang"].alias(made[0]), score.alias(made[1]))


def accepted(lang: Column, score: Column, least: float) -> Column:
    """Documents whose language is known and clear enough."""
    return (lang != UNKNOWN) & (score >= least)
