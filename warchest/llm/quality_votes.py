"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Every rule looks at counts of the whole text and says good (1), bad (-1) or nothing (0).  Nobody labels anything: rows with the same
votes are counted together (at most 3 to the number of rules patterns, so the counts fit the driver whatever the table holds), and
expectation-maximisation over the patterns estimates the shares of the classes and, of each rule and class, how often a vote that is
cast is right.  An abstention says nothing about the class.

A bad document is bad in one of a few ways (KINDS), and no rule sees all of them.  With a single bad class the rules of the most frequent
way would outvote the others, so every way is a class of its own; each is watched by several rules that agree where it is real.  The
posterior quality is the probability of the good class: one rule that errs does not remove a document by itself, as it would if all rules
had to pass, because the other rules of that kind deny it.

A word is a run of characters other than ASCII white space.  A repeated word is one that lies in a window of five words which the text
holds twice or more, first window included; words are compared exactly.  Duplicate lines are lines with a word that equal an earlier one.

Results: a missing text counts as empty; an empty one has 0 everywhere, its votes come from the length alone.  Rows are judged one by
one, repeated rows and ids repeat.  A table without rows has an even prior and no evidence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from warchest.llm.common import col, map_texts

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
CAPITALS = bytes(range(65, 91))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
BLANK = b" \t\n\x0b\x0c\r"

#: What a text is counted for.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_capitals", "n_digits", "n_marks", "n_exclaims", "n_ends",
)

#: The ways in which a text may be bad, each with the rules that watch it.  The remaining rules support all of them.
KINDS = {
    "markup": ("symbols", "marks", "letters"),
    "shouting": ("capitals", "exclaims", "sentences"),
    "repetition": ("repeats", "duplicate_lines", "variety"),
}
RULES = (*(name for names in KINDS.values() for name in names), "length", "word_length", "digits")


def repeated(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(names) == len(words):
        return 0
    # name the windows exactly, a word longer each time
    named = ids[:n]
    for k in range(1, window):
        _, named = np.unique(named * len(names) + ids[k : k + n], return_inverse=True)
    twice = np.bincount(named)[named] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[window:][: n] -= twice
    return int((np.cumsum(edges) > 0).sum())


def counted(text: bytes | None) -> tuple[int, ...]:
    """The COUNTS of a text."""
    text = text or b""
    words = text.split()  # bytes: ASCII white space only
    lines = [x for x in text.split(b"\n") if x.strip(BLANK)]
    size = len(text)
    inside = size - sum(text.count(bytes([b])) for b in BLANK)
    # bytes that continue a character
    more = 0 if text.isascii() else int((np.frombuffer(text, np.int8) < -64).sum())
    without = lambda some: size - len(text.translate(None, some))
    return (
        len(words), inside - more, without(SYMBOLS), len(lines) - len(set(lines)), repeated(words),
        len(lines), len(set(words)), without(CAPITALS), without(DIGITS), without(MARKS), text.count(b"!"),
        sum(w.endswith((b".", b"!", b"?")) for w in words),
    )


def counter() -> Callable[[list], list[list]]:
    return lambda texts: [list(c) for c in zip(*map(counted, texts), strict=True)]


def counts(df: DataFrame, *, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and the COUNTS of the text."""
    made = [T.StructField(name, T.LongType(), False) for name in COUNTS]
    return map_texts(df, text, list(keep), made, counter, binary=True)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def _rules() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    has, some, many = F.col("n_words") > 0, F.col("n_words") >= 40, F.col("n_words") >= 100
    length, variety = chars / words, F.col("n_distinct") / F.sqrt(words)
    symbols, marks, ends, exclaims = (F.col(name) / words for name in ("n_symbols", "n_marks", "n_ends", "n_exclaims"))
    lines, again = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_repeat_words") / words
    capitals, digits = F.col("n_capitals") / chars, F.col("n_digits") / chars
    other = (F.col("n_marks") + F.col("n_digits")) / chars
    return {
        "symbols": _vote(has & (symbols <= 0.02), symbols >= 0.15),
        "marks": _vote(has & (marks <= 0.35), some & (marks >= 0.45)),
        "letters": _vote(has & (other <= 0.08), some & (other >= 0.11)),
        "capitals": _vote(has & (capitals <= 0.15), some & (capitals >= 0.4)),
        "exclaims": _vote(has & (exclaims <= 0.05), some & (exclaims >= 0.3)),
        "sentences": _vote(some & ends.between(0.005, 0.4), many & ((F.col("n_ends") == 0) | (ends > 0.7))),
        "repeats": _vote(some & (again <= 0.05), again > 0.2),
        "duplicate_lines": _vote((F.col("n_lines") > 1) & (lines <= 0.1), (F.col("n_lines") >= 5) & (lines > 0.3)),
        "variety": _vote(some & (variety >= 3), some & (variety < 1.5)),
        "length": _vote(F.col("n_words") >= 40, F.col("n_words") < 10),
        "word_length": _vote(has & length.between(3, 9), has & ((length < 2) | (length > 14))),
        "digits": _vote(has & (digits <= 0.1), digits >= 0.4),
    }


def votes(found: DataFrame) -> DataFrame:
    """The rows of `counts` with an array `votes`, one of 1, -1 and 0 for each of RULES."""
    rules = _rules()
    return found.withColumn("votes", F.array(*[rules[name] for name in RULES]))


@dataclass(frozen=True)
class Model:
    """shares[c]: part of the documents in class c, the good one first, then KINDS; good_vote[c, j]: how often rule j, if it votes, says
    good of a document of class c; accuracy[j]: how often a vote of rule j agrees with good or bad."""

    shares: np.ndarray
    good_vote: np.ndarray
    accuracy: np.ndarray
    rounds: int


def maximise(patterns: np.ndarray, weights: np.ndarray, *, rounds: int = 500, tolerance: float = 1e-10, smooth: float = 1.0) -> Model:
    """Expectation-maximisation over vote patterns (rows of 1, -1, 0) and how many documents have each."""
    patterns = np.asarray(patterns, np.float64).reshape(len(weights), len(RULES))
    weights = np.asarray(weights, np.float64)
    up, down = (patterns > 0).astype(float), (patterns < 0).astype(float)
    # start: a kind is likely where most of its own rules say bad
    watch = np.array([[name in names for name in RULES] for names in KINDS.values()], float)
    start = np.exp(np.c_[np.zeros(len(weights)), -2 * patterns @ watch.T])
    member = start / start.sum(1, keepdims=True)
    total, last, done = weights.sum(), None, 0
    shares, good_vote = np.full(1 + len(KINDS), 1 / (1 + len(KINDS))), np.full((1 + len(KINDS), len(RULES)), 0.5)
    for done in range(1, rounds + 1 if total else 1):
        w = weights[:, None] * member
        shares = (w.sum(0) + smooth) / (total + smooth * len(shares))
        good_vote = (w.T @ up + smooth) / (w.T @ (up + down) + 2 * smooth)
        logs = np.log(shares) + up @ np.log(good_vote).T + down @ np.log(1 - good_vote).T
        all_logs = np.logaddexp.reduce(logs, axis=1)
        member = np.exp(logs - all_logs[:, None])
        likely = weights @ all_logs / total
        if last is not None and abs(likely - last) < tolerance:
            break
        last = likely
    good = weights * member[:, 0]
    cast = weights @ (up + down)
    accuracy = np.divide(good @ up + (weights - good) @ down, cast, out=np.full(len(RULES), 0.5), where=cast > 0)
    return Model(shares, good_vote, accuracy, done)


def fit(voted: DataFrame) -> Model:
    """The model of all rows.  Rows are counted by pattern first: at most 3 to the number of rules reach the driver."""
    seen = voted.groupBy("votes").count().orderBy("votes").collect()
    return maximise(np.array([r["votes"] for r in seen]).reshape(len(seen), len(RULES)), np.array([r["count"] for r in seen]))


def posterior(model: Model, votes: Column) -> Column:
    """The probability that a document with these votes is good."""
    against = F.lit(0.0)
    for kind in range(1, len(model.shares)):
        odds = F.lit(float(np.log(model.shares[kind] / model.shares[0])))
        for j in range(len(RULES)):
            of, good = model.good_vote[kind, j], model.good_vote[0, j]
            said_good, said_bad = float(np.log(of / good)), float(np.log((1 - of) / (1 - good)))
            odds = odds + F.when(votes[j] > 0, said_good).when(votes[j] < 0, said_bad).otherwise(0.0)
        against = against + F.exp(odds)
    return 1 / (1 + against)


def base_failed() -> Column:
    """The two rules that no vote outweighs."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(voted: DataFrame, model: Model, *, least: float = 0.5) -> DataFrame:
    """The rows of `votes` with posterior, base_failed and kept."""
    found = voted.withColumns({"posterior": posterior(model, F.col("votes")), "base_failed": base_failed()})
    return found.withColumn("kept", ~col("base_failed") & (col("posterior") >= least))
