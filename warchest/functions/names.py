"""Name capitalisation as one column expression.

The whole text is title-cased in two string passes; only words whose form differs from plain
title case (acronyms, particles, ``Mc``, hyphenated words) are then touched one by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, squeeze, strip

# Words that stay in capitals, roman numerals, particles, abbreviations.
ACRONYMS = [
    "AFL-CIO", "AFL", "CIO", "PAC", "USA", "US", "IBEW", "UAW", "SEIU", "NEA", "AFT", "UFCW",
    "AFSCME", "LIUNA", "IATSE", "IUOE", "SMART", "UWUA", "CWA", "APWU", "NALC", "NFFE", "NTEU",
    "PBA", "FOP", "IAFF", "BCTGM", "USW", "OPEIU", "UFWA", "DNC", "RNC", "GOP", "LLC", "INC",
    "LTD", "CO", "CORP",
]
NUMERALS = ["II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"]
PARTICLES = ["DE", "LA", "DEL", "VAN", "VON", "DEN", "DER", "LE", "DA", "DI", "DU", "OF", "THE"]
ABBREVIATIONS = {"INT'L": "Int'l", "INTL": "Intl", "ASS'N": "Ass'n", "ASSN": "Assn"}

# Words are compared after title-casing.
UPPER_WORDS = ["-".join(p.capitalize() for p in w.split("-")) for w in ACRONYMS]
ROMAN_NUMERALS = [w.capitalize() for w in NUMERALS]
SMALL_WORDS = [w.capitalize() for w in PARTICLES]
SHORTENED = {w.title(): final for w, final in ABBREVIATIONS.items() if w.title() != final}

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_SEAM = "\x01 "  # initcap starts a new word after it


def _title(c: Column) -> Column:
    """Title-case every run of letters: ``SMITH-JONES`` -> ``Smith-Jones``, ``3RD`` -> ``3Rd``."""
    seamed = F.regexp_replace(c, rf"(?<=[^{_CASED} ])(?=[{_CASED}])", _SEAM)
    return F.replace(F.initcap(seamed), F.lit(_SEAM), F.lit(""))


def _core(word: Column) -> Column:
    """The word without leading and trailing marks."""
    return F.regexp_replace(word, r"\A[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z", "")


def _simple_word(core: Column, first: Column) -> Column | None:
    """Exceptions shared by whole words and by the parts of a hyphenated word."""
    listed = F.when(core.isin(UPPER_WORDS + ROMAN_NUMERALS), F.upper(core))
    for titled, final in SHORTENED.items():
        listed = listed.when(core == titled, F.lit(final))
    longer = F.length(core) > 2
    return (
        listed.when(~first & core.isin(SMALL_WORDS), F.lower(core))
        .when(core.startswith("O'") & longer, core)
        .when(
            core.startswith("Mc") & longer,
            F.concat(F.lit("Mc"), F.upper(F.substring(core, 3, 1)), F.substr(core, F.lit(4))),
        )
    )


def _hyphenated(core: Column, first: Column) -> Column:
    def piece(p: Column, j: Column) -> Column:
        opens = first & (j == 0)
        return bind(_core(p), lambda c: F.replace(p, c, _simple_word(c, opens).otherwise(c)))

    return F.array_join(F.transform(F.split(core, "-"), piece), "-")


def _word(word: Column, first: Column) -> Column:
    def fixed(core: Column) -> Column:
        listed = _simple_word(core, first)
        return F.replace(word, core, listed.when(core.contains("-"), _hyphenated(core, first)).otherwise(core))

    return bind(_core(word), fixed)


def _any_of(words: list[str]) -> str:
    """Alternation grouped by first letter, so that most words fail on their first letter."""
    heads = sorted({w[0] for w in words})
    tails = {h: "|".join(w[1:] for w in words if w[0] == h) for h in heads}
    return "(?:" + "|".join(f"{h}(?:{t})" for h, t in tails.items()) + ")"


# Words that may need more than title case; everything else is done after title-casing.
_NEEDS_WORDS = (
    "-|Mc|(?<![A-Za-z0-9])"
    + _any_of([w for w in UPPER_WORDS if "-" not in w] + ROMAN_NUMERALS + SMALL_WORDS + list(SHORTENED))
    + "(?![A-Za-z0-9])"
)


def capitalize_name(name: Column | str) -> Column:
    """``SMITH, JOHN JR`` -> ``Smith, John Jr``; ``AFL-CIO COPE`` -> ``AFL-CIO Cope``.

    The part before the first comma owns the first word, which keeps a capital even when it
    is a particle.  White space is squeezed.  NULL stays NULL.
    """
    name = F.col(name) if isinstance(name, str) else name
    spaced = F.regexp_replace(squeeze(strip(name)), r"\A([^,]*?) ?,(?: |(?=[^ ])|\z)", "$1, ")
    titled = _title(spaced)

    def by_word(text: Column) -> Column:
        fixed = lambda w, i: F.when(w.rlike(_NEEDS_WORDS), _word(w, i == 0)).otherwise(w)
        return F.array_join(F.transform(F.split(text, " "), fixed), " ")

    done = bind(titled, lambda t: F.when(t.rlike(_NEEDS_WORDS), by_word(t)).otherwise(t))
    return F.rtrim(done, F.lit(", "))
