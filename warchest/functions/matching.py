"""Person-name keys, name scores and term arithmetic used to link candidates to legislators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, after_comma, before_comma, bind, lookup, squeeze, strip, words

FIRST_CYCLE, LAST_CYCLE = 1980, 2026

# Nickname -> formal name, one hop.
NICKNAMES = {
    "bob": "robert", "bobby": "robert", "rob": "robert",
    "bill": "william", "billy": "william", "will": "william",
    "jim": "james", "jimmy": "james", "jamie": "james",
    "mike": "michael", "mick": "michael",
    "dick": "richard", "rick": "richard", "rich": "richard",
    "ted": "theodore", "teddy": "theodore",
    "tom": "thomas", "tommy": "thomas",
    "joe": "joseph", "joey": "joseph",
    "dan": "daniel", "danny": "daniel",
    "dave": "david", "davy": "david",
    "tony": "antonio",
    "al": "alan",
    "ed": "edward", "eddy": "edward", "eddie": "edward", "ned": "edward",
    "sam": "samuel", "sammy": "samuel",
    "charlie": "charles", "chuck": "charles", "chas": "charles",
    "ben": "benjamin", "benny": "benjamin",
    "jack": "john", "johnny": "john", "jon": "john",
    "steve": "stephen", "steven": "stephen",
    "pat": "patrick", "patty": "patricia",
    "chris": "christopher", "kit": "christopher",
    "matt": "matthew",
    "andy": "andrew", "drew": "andrew",
    "nick": "nicholas", "nicky": "nicholas",
    "pete": "peter",
    "jerry": "jerome", "gerry": "gerald",
    "larry": "lawrence", "lawrie": "lawrence",
    "harry": "harold", "hal": "harold",
    "hank": "henry",
    "liz": "elizabeth", "lizzy": "elizabeth", "beth": "elizabeth", "betty": "elizabeth",
    "betsy": "elizabeth",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine",
    "cathy": "catherine",
    "maggie": "margaret", "peggy": "margaret", "meg": "margaret", "margie": "margaret",
    "sue": "susan", "suzy": "susan",
    "debbie": "deborah", "deb": "deborah",
    "barb": "barbara", "barbie": "barbara",
    "jenny": "jennifer", "jen": "jennifer",
    "cindy": "cynthia",
    "sandy": "alexander",
    "mandy": "amanda",
    "becky": "rebecca",
    "vicky": "victoria",
    "tina": "christina",
    "nancy": "ann",
    "sally": "sarah",
    "phil": "philip",
    "don": "donald", "donny": "donald",
    "ron": "ronald", "ronny": "ronald",
    "ray": "raymond",
    "ken": "kenneth", "kenny": "kenneth",
    "greg": "gregory", "gregg": "gregory",
    "walt": "walter", "wally": "walter",
    "fred": "frederick", "freddy": "frederick",
    "gene": "eugene",
    "lenny": "leonard", "len": "leonard", "leo": "leonard",
    "norm": "norman",
    "bernie": "bernard", "ernie": "ernest", "arnie": "arnold",
    "abe": "abraham",
    "max": "maximilian",
    "doug": "douglas",
    "cliff": "clifford",
    "tim": "timothy", "timmy": "timothy",
    "bart": "bartholomew",
    "zach": "zachary", "zack": "zachary",
    "alex": "alexander",
    "jeff": "jeffrey", "geoffrey": "jeffrey", "geoff": "geoffrey",
    "josh": "joshua",
    "nate": "nathaniel", "nathan": "nathaniel", "nat": "nathaniel",
    "cy": "cyrus",
    "ike": "isaac", "izzy": "isidore",
    "manny": "emmanuel",
    "mort": "morton",
    "sy": "seymour", "si": "simon",
    "vinny": "vincent", "vic": "victor", "vince": "vincent",
    "wes": "wesley",
    "frank": "francis", "frankie": "francis",
    "fran": "frances", "frannie": "frances",
}

# Party text of a term -> party code of a candidate.
PARTY_CODES = {
    "Democrat": "DEM", "Democratic": "DEM", "Republican": "REP", "Independent": "IND",
    "Libertarian": "LIB", "Green": "GRE", "Liberal": "LIB", "Reform": "REF",
    "Conservative": "CON", "Democrat-Farmer-Labor": "DFL", "Farmer-Labor": "DFL",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clean(c: Column | str) -> Column:
    return F.lower(strip(F.coalesce(_col(c), F.lit(""))))


# ---------------------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------------------


def name_key(name: Column | str) -> Column:
    """``BYRD, JR ROBERT C`` -> ``BYRD, ROBERT``; empty for a missing name."""
    n = strip(F.upper(F.coalesce(_col(name), F.lit(""))))
    unmarked = lambda c: F.regexp_replace(strip(c), "[.']", "")
    given = words(strip(unmarked(after_comma(n))))
    head = F.get(given, F.lit(0))
    second = F.coalesce(F.get(given, F.lit(1)), F.lit(""))
    first = F.when(head.isin("JR", "SR", "II", "III", "IV"), second).otherwise(head)
    full = F.concat(unmarked(before_comma(n)), F.lit(", "), first)
    with_comma = strip(F.regexp_replace(full, r" (JR|SR|II|III|IV)\z", ""))
    plain = strip(squeeze(F.regexp_replace(n, "[.,']", "")))
    return F.when(n.contains(","), with_comma).otherwise(plain)


# A suffix token ends the name, after white space or directly after a comma.
_SUFFIX = rf"(?i)(?:{WS}+|,)(jr\.?|sr\.?|ii|iii|iv|v|2nd|3rd|4th)\z"


def parse_name(name: Column | str) -> Column:
    """struct(last, first, suffix), lower case.  ``Payne, Donald M Jr`` -> (payne, donald, jr)."""
    n = strip(F.coalesce(_col(name), F.lit("")))
    suffix = F.rtrim(F.lower(F.regexp_extract(n, _SUFFIX, 1)), F.lit("."))
    base = strip(F.regexp_replace(n, _SUFFIX, ""))

    def person(b: Column) -> Column:
        tokens = words(b)
        given = F.get(words(strip(after_comma(b))), F.lit(0))
        two = F.when(F.size(tokens) > 1, F.get(tokens, F.lit(0))).otherwise(F.lit(""))
        last = F.when(b.contains(","), strip(before_comma(b))).otherwise(F.element_at(tokens, -1))
        first = F.when(b.contains(","), given).otherwise(two)
        return F.struct(
            F.lower(last).alias("last"), F.regexp_replace(F.lower(first), "[\"']", "").alias("first"))

    return bind(base, person).withField("suffix", suffix)


def formal_name(first: Column | str) -> Column:
    """Formal form of a first name: ``bob`` -> ``robert``; other names stay."""
    return bind(_clean(first), lambda f: F.coalesce(lookup(NICKNAMES, f), f))


# ---------------------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------------------


def score_parts(cand: Column, cand_formal: Column, first: Column, first_formal: Column,
                last: Column, suffix: Column) -> Column:
    """Score of a parsed candidate name (struct) against a cleaned legislator name.

    0.0 means no match.  A suffix known only on the candidate side is not a mismatch.
    """
    agree = (cand["suffix"] == suffix) | (suffix == "")
    return (
        F.when(cand["last"] != last, F.lit(0.0))
        .when(cand["first"] == first, F.when(agree, F.lit(1.0)).otherwise(F.lit(0.9)))
        .when(
            (cand_formal == first_formal) | (cand_formal == first) | (cand["first"] == first_formal),
            F.when(agree, F.lit(0.95)).otherwise(F.lit(0.85)),
        )
        .when(
            (cand["first"] != "") & (first != "")
            & (F.substring(cand["first"], 1, 1) == F.substring(first, 1, 1)),
            F.lit(0.7),
        )
        .otherwise(F.lit(0.0))
    )


def name_match_score(cand_name: Column | str, first: Column | str, last: Column | str,
                     suffix: Column | str) -> Column:
    parsed = parse_name(cand_name)
    return score_parts(parsed, formal_name(parsed["first"]), _clean(first), formal_name(first),
                       _clean(last), _clean(suffix))


def party_adjusted(score: Column, cand_party: Column, term_party: Column) -> Column:
    """Raise the score when both parties are known and equal, lower it when they differ."""
    return (
        F.when((F.coalesce(cand_party, F.lit("")) == "") | (F.coalesce(term_party, F.lit("")) == ""), score)
        .when(cand_party == term_party, F.least(F.lit(1.0), score + F.lit(0.1)))
        .otherwise(F.greatest(F.lit(0.5), score - F.lit(0.2)))
    )


def confidence_band(score: Column) -> Column:
    return F.when(score >= 0.95, "high").when(score >= 0.8, "medium").otherwise("low")


# ---------------------------------------------------------------------------------------
# Terms
# ---------------------------------------------------------------------------------------


def term_years(start: Column, end: Column) -> tuple[Column, Column]:
    """First and last year of a term; an open end lasts two years.  NULL start gives NULLs."""
    first = F.substring(start, 1, 4).try_cast("int")
    last = F.when(F.coalesce(end, F.lit("")) == "", first + 2).otherwise(
        F.substring(end, 1, 4).try_cast("int")
    )
    return first, last


def term_in_range(start: Column, end: Column, low: int = FIRST_CYCLE, high: int = LAST_CYCLE) -> Column:
    first, last = term_years(start, end)
    return F.coalesce((first <= high) & (last >= low), F.lit(False))


def term_cycles(kind: Column, start: Column, end: Column, low_cycle: int = FIRST_CYCLE, high_cycle: int = LAST_CYCLE) -> Column:
    """Election cycles a term was campaigned in: every two years for the House, the first and
    the re-election cycle for the Senate.  Only cycles from ``low_cycle`` to ``high_cycle``."""
    first, last = term_years(start, end)
    opening, closing = first - F.pmod(first, F.lit(2)), last - F.pmod(last, F.lit(2))
    low, high = F.greatest(opening, F.lit(low_cycle)), F.least(last, F.lit(high_cycle))
    none = F.array().cast("array<int>")
    known = opening.isNotNull() & last.isNotNull()
    house = F.when(known & (low <= high), F.sequence(low, high, F.lit(2))).otherwise(none)
    senate = F.filter(
        F.array_distinct(F.array(opening, closing)), lambda y: y.between(low_cycle, high_cycle)
    )
    return F.when(kind == "rep", house).otherwise(senate)


def office_code(kind: Column) -> Column:
    return F.when(kind == "rep", "H").otherwise("S")


def party_code(party: Column) -> Column:
    return F.coalesce(lookup(PARTY_CODES, F.coalesce(party, F.lit(""))), F.lit(""))
