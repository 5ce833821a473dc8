"""License scan by ordered signature rules.  DataFrame functions only, no shuffle: a row is scanned where it is read.

A text becomes lower-case words one blank apart.  A rule's pattern is tried where one of its keywords occurs.  Matches become word
intervals: both ends are marked in the text, and the marked words numbered.  Intervals are taken by start, longer ones
first; one that lies within an earlier one of at least its priority is suppressed.  The base phrases are found apart and
always stay.

Results: a missing or empty text has no words and no detections.  Rows are independent.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from warchest.llm.common import col
from warchest.llm.license_rules import BASE, GATE, Rule, rules

#: Runs of characters that belong to no word, once letters are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GROUP = "array<struct<keywords: array<string>, needs: string, rules: array<struct<label: string, priority: int, weight: double, pattern: string>>>>"
SPAN = "struct<first: int, last: int>"
_OPEN, _CLOSE = "\x01", "\x02"


def words_of(text: Column) -> Column:
    """Lower-case words, one blank apart.  `lower` also touches letters outside ASCII; they stay word characters outside ASCII, but for the
    Kelvin sign, whose small letter is k and which is therefore replaced first."""
    return F.trim(F.regexp_replace(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138"))), BETWEEN, " "))


def word_count(line: Column) -> Column:
    return F.when(line == "", F.lit(0)).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def _marked(words: Column, mark: str) -> Column:
    at = F.transform(words, lambda w, i: F.when(F.contains(w, F.lit(mark)), i))
    return F.filter(at, lambda i: i.isNotNull())


def spans(line: Column, pattern: Column) -> Column:
    """First and last word of every match of the pattern, words counted from 0."""
    whole = F.concat(F.lit("(?<![^ ])(?:"), pattern, F.lit(")(?![^ ])"))
    marked = F.split(F.regexp_replace(line, whole, F.lit(_OPEN + "$0" + _CLOSE)), " ")
    zipped = F.zip_with(_marked(marked, _OPEN), _marked(marked, _CLOSE), lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return F.when(F.regexp_like(line, whole), zipped).otherwise(F.array().cast(f"array<{SPAN}>"))


def _named(label: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(label).alias("label"), s["first"].alias("first"), s["last"].alias("last")))


def _found(line: Column, padded: Column, known: list[Rule]) -> Column:
    """Every match of every rule, by start, longer ones first, then by order of the rules."""
    groups: dict[tuple, list[dict]] = {}
    for r in known:
        groups.setdefault((*r.keywords, r.needs), []).append({"label": r.label, "priority": r.priority, "weight": r.weight, "pattern": r.pattern})
    listed = [{"keywords": [f" {k}" for k in key[:-1]], "needs": f" {key[-1]}", "rules": of} for key, of in groups.items()]
    table = F.from_json(F.lit(json.dumps(listed)), GROUP)
    # what the frames need is looked for once, a keyword once for all rules that share it
    there = F.filter(F.array(*[F.lit(n) for n in sorted({f" {r.needs}" for r in known})]), lambda n: F.contains(padded, n))
    open_ = F.transform(F.array(there), lambda need: F.filter(table, lambda g: F.array_contains(need, g["needs"])))[0]
    tried = F.flatten(F.transform(
        F.filter(open_, lambda g: F.exists(g["keywords"], lambda k: F.contains(padded, k))), lambda g: g["rules"]))
    matches = F.transform(tried, lambda r: F.transform(spans(line, r["pattern"]), lambda s: F.struct(
        s["first"].alias("first"), (-s["last"]).alias("minus_last"), (-r["priority"]).alias("minus_priority"), r["label"].alias("label"), r["weight"].alias("weight"))))
    return F.array_sort(F.flatten(matches))


def _kept(found: Column, priorities: int) -> Column:
    """Containment: the furthest end so far is held for each priority."""
    empty = F.lit([]).cast("array<struct<label: string, first: int, last: int, priority: int, weight: double>>")
    start = F.struct(F.array_repeat(F.lit(-1), priorities + 1).alias("ends"), empty.alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        last, priority = -d["minus_last"], -d["minus_priority"]
        inside = F.array_max(F.slice(acc["ends"], priority + 1, priorities + 1)) >= last
        ends = F.transform(acc["ends"], lambda e, i: F.when(i == priority, F.greatest(e, last)).otherwise(e))
        own = F.struct(d["label"].alias("label"), d["first"].alias("first"), last.alias("last"), priority.alias("priority"), d["weight"].alias("weight"))
        return F.struct(ends.alias("ends"), F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(own))).alias("kept"))

    return F.aggregate(found, start, step, lambda acc: acc["kept"])


def scan(df: DataFrame, *, text: str = "text", keep: list[str] = ("doc_id",), known: list[Rule] | None = None) -> DataFrame:
    """The columns `keep` with n_words, base (label, first, last of every base phrase) and detections (label, first, last, priority,
    weight of what the rules keep)."""
    known = rules() if known is None else known
    lined = df.select(*[col(c) for c in keep], words_of(F.coalesce(col(text).cast("string"), F.lit(""))).alias("\0line"))
    lined = lined.withColumn("\0padded", F.concat(F.lit(" "), col("\0line")))
    line, padded, gate = col("\0line"), col("\0padded"), F.lit(False)
    for word in GATE:  # keywords begin words
        gate = gate | F.contains(padded, F.lit(f" {word}"))
    base = F.concat(*[_named(label, spans(line, F.lit(phrase))) for label, phrase in BASE])
    no_base = F.lit([]).cast("array<struct<label: string, first: int, last: int>>")
    found = F.when(gate, _found(line, padded, known))
    none = F.lit([]).cast("array<struct<label: string, first: int, last: int, priority: int, weight: double>>")
    detections = F.coalesce(_kept(found, max(r.priority for r in known)), none)
    return lined.select(
        *[col(c) for c in keep], word_count(line).alias("n_words"),
        F.when(F.contains(line, F.lit("license")), base).otherwise(no_base).alias("base"), detections.alias("detections"),
    )


def labels_of(found: Column) -> Column:
    return F.transform(found, lambda d: d["label"])


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def confidence(detections: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(detections, lambda d: d["weight"])), F.lit(0.0))
