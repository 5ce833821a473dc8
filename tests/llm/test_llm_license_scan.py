"""The scan against plain Python over the same rules."""

import random
import re

from warchest.llm.license_rules import BASE, GATE, rules
from warchest.llm.license_scan import scan
from warchest.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def matches(words, pattern):
    line, out = " ".join(words), []
    for m in re.finditer(rf"(?<![^ ])(?:{pattern})(?![^ ])", line):
        first = line[: m.start()].count(" ")
        out.append((first, first + m.group().count(" ")))
    return out


def brute(text, known):
    words = words_of(text)
    line = " ".join(words)
    found = []
    for order, r in enumerate(known):
        if any(k in line for k in r.keywords):
            found += [(a, -b, -r.priority, r.label, r.weight) for a, b in matches(words, r.pattern)]
    kept = []
    found.sort()
    for i, (a, b, p, label, weight) in enumerate(found):
        if not any(-b0 >= -b and -p0 >= -p for _, b0, p0, *_ in found[:i]):
            kept.append((label, a, -b, -p, weight))
    base = [(label, a, b) for label, phrase in BASE for a, b in matches(words, phrase)]
    return len(words), base, kept


def test_keywords_and_gate_begin_words():
    """Every match of a rule has one of its keywords, and one of the gate's, at the beginning of a word."""
    rng = random.Random(3)
    for r in rules():
        for _ in range(30):
            text = " " + sample(r.pattern, rng)
            assert re.fullmatch(r.pattern, text[1:]), (r.pattern, text)
            assert any(f" {k}" in text for k in r.keywords), (r, text)
            assert any(f" {g}" in text for g in GATE), (r, text)


def sample(pattern, rng):
    """A random text that the pattern matches."""
    def made(tree):
        out = ""
        for op, arg in tree:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "SUBPATTERN":
                out += made(arg[3])
            elif name == "BRANCH":
                out += made(rng.choice(arg[1]))
            elif name == "MAX_REPEAT":
                low, high, body = arg
                out += "".join(made(body) for _ in range(rng.randint(low, min(high, low + 2))))
            elif name == "IN":
                kind, value = rng.choice(arg)
                out += chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value)) if str(kind) == "RANGE" else "q"
            elif name == "NOT_LITERAL":
                out += "q"
            else:
                raise AssertionError(name)
        return out

    return made(re._parser.parse(pattern))


TEXTS = [
    None, "", " ,.; ", "MIT License mit-license (the MIT license)", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "submit license", "general public\nlicense general public license",
    "See http://www.apache.org/licenses/LICENSE-2.0", "© all rights reserved ©", "Creative Commons Attribution-ShareAlike 4.0 International License",
    "This code is in the public domain.", "BSD 3-Clause License. Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mit license " * 300, "x " * 20000 + "Mozilla Public License 2.0", "étude MIT Licence", "no licence here", "license: mit, see LICENSE", "0BSD license İ K mit license",
]


def test_many_rules():
    known = rules()
    assert len(known) >= 300 and len({r.label for r in known}) > 60
    for r in known:
        re.compile(r.pattern)


def test_against_plain_python(spark):
    known = rules()
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1.0)], "doc_id long, text string, n_words double")
    rows = sorted(scan(df).collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        n, base, kept = brute(TEXTS[r.doc_id], known)
        assert r.n_words == n
        assert [tuple(x) for x in r.base] == base
        assert [tuple(x) for x in r.detections] == kept
    got = {r.doc_id: {d.label for d in r.detections} for r in rows}
    assert got[4] == {"apache-2.0"} and got[5] == {"gpl-3.0"} and got[6] == {"gpl-2.0"} and got[7] == {"mit"} and got[12] == {"cc-by-sa"}
    assert got[8] == got[18] == set()
    assert scan(df.limit(0)).count() == 0


def test_query(spark):
    folder, known = "/root/testdata/sf0.001", rules()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_license_scan"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert any(r.n_base for r in rows)
    for r in rows:
        n, base, kept = brute(texts[r.doc_id], known)
        starts = [a for _, a, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        own = {x for x, *_ in base}
        assert r.base_labels == ",".join(sorted(own)) and r.labels == ",".join(sorted(own | {k[0] for k in kept}))
        assert r.score == max((k[4] for k in kept), default=0.0)


def test_only_ascii_letters_are_folded(spark):
    df = spark.createDataFrame([(1, "blue oa\u212a model license 1.0"), (2, "blue oaK model license 1.0"), (3, "M\u0130T LICENSE"), (4, "\u212a")], "doc_id long, text string")
    rows = {r.doc_id: [d.label for d in r.detections] for r in scan(df).collect()}
    assert "blueoak" not in rows[1] and "blueoak" in rows[2] and "mit" not in rows[3] and rows[4] == []


def test_every_match_needs_what_its_rule_says():
    """A match of a rule that needs a word has it, wherever the pattern leaves a choice."""
    for rule in rules():
        if rule.needs:
            pattern = rule.pattern
            while "(?:" in pattern:  # drop optional groups, innermost first; others stay if each choice has the word
                inner = re.sub(r"\(\?:[^()]*\)[?*]", "", pattern)
                inner = re.sub(r"\(\?:([^()]*)\)", lambda m: " ".join(m[1].split("|")[:1]) if "|" in m[1] else m[1], inner, count=1)
                if inner == pattern:
                    break
                pattern = inner
            assert rule.needs in pattern.replace("licen[cs]e", "license"), rule
