"""Candidate id <-> legislator id crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (confidence_band, formal_name, name_key, office_code, parse_name,
                         party_adjusted, party_code, term_cycles)
from ..functions.matching import FIRST_CYCLE, LAST_CYCLE, _clean, score_parts
from ..functions.text import bind
from .legislators import BIOGUIDE, has_text, terms_in_range, has_candidate_ids

PAIR = ["cand_id", "bioguide_id"]
CROSSWALK_COLUMNS = [*PAIR, "match_method", "confidence"]
CYCLES = (FIRST_CYCLE, LAST_CYCLE)


def registered_ids(candidates: DataFrame) -> DataFrame:
    return candidates.select("cand_id").where(F.col("cand_id").isNotNull()).distinct()


def declared_ids(legislators: DataFrame) -> DataFrame:
    """(cand_id, bioguide_id) pairs the legislator records carry themselves."""
    return legislators.where(has_text(BIOGUIDE)).select(
        F.explode("id.fec").alias("cand_id"), F.col(BIOGUIDE).alias("bioguide_id")
    )


def validate_ids(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    return pairs.join(registered_ids(candidates), "cand_id", "left_semi")


def authoritative(legislators: DataFrame, candidates: DataFrame) -> DataFrame:
    return validate_ids(declared_ids(legislators), candidates).distinct().select(
        *PAIR, F.lit("authoritative").alias("match_method"), F.lit("high").alias("confidence")
    )


def unverified(legislators: DataFrame, candidates: DataFrame) -> DataFrame:
    """All declared ids; those never registered are kept with medium confidence."""
    pairs = (
        declared_ids(legislators)
        .where(has_text("cand_id"))
        .select(F.trim("cand_id").alias("cand_id"), "bioguide_id")
        .distinct()
    )
    known = registered_ids(candidates).select(F.trim("cand_id").alias("cand_id")).distinct()
    marked = pairs.join(known.withColumn("known", F.lit(True)), "cand_id", "left")
    ok = F.col("known").isNotNull()
    return marked.select(
        *PAIR,
        F.when(ok, "authoritative").otherwise("authoritative_unverified").alias("match_method"),
        F.when(ok, "high").otherwise("medium").alias("confidence"),
    )


# ---------------------------------------------------------------------------------------
# Name matching
# ---------------------------------------------------------------------------------------

_BLOCK = ["state", "office", "cycle", "last"]


def _member_campaigns(legislators: DataFrame, cycles: tuple[int, int]) -> DataFrame:
    """One row per legislator without declared ids, and per campaign (state, office, cycle)."""
    named = terms_in_range(
        legislators.where(has_text(BIOGUIDE) & ~has_candidate_ids() & has_text("name.last")), *cycles
    )
    terms = named.select(
        F.col(BIOGUIDE).alias("bioguide_id"),
        _clean("name.last").alias("last"),
        _clean("name.first").alias("first"),
        formal_name("name.first").alias("first_formal"),
        _clean("name.suffix").alias("suffix"),
        F.coalesce("name.nickname", F.lit("")).alias("nickname"),
        _clean("name.nickname").alias("nick"),
        formal_name("name.nickname").alias("nick_formal"),
        F.explode("terms").alias("t"),
    ).where(has_text("t.state") & has_text("t.type"))
    return terms.select(
        "bioguide_id", "last", "first", "first_formal", "suffix", "nickname", "nick", "nick_formal",
        F.col("t.state").alias("state"),
        office_code(F.col("t.type")).alias("office"),
        party_code(F.col("t.party")).alias("term_party"),
        F.explode(term_cycles(F.col("t.type"), F.col("t.start"), F.col("t.end"), *cycles)).alias("cycle"),
    )


def _candidate_campaigns(candidates: DataFrame) -> DataFrame:
    parsed = candidates.where(has_text("cand_name") & has_text("cand_id")).select(
        "cand_id",
        parse_name("cand_name").alias("cand"),
        F.col("cand_office_st").alias("state"),
        F.col("cand_office").alias("office"),
        F.col("election_cycle").alias("cycle"),
        F.coalesce("cand_pty_affiliation", F.lit("")).alias("cand_party"),
    )
    return parsed.select(
        "*", F.col("cand.last").alias("last"), formal_name("cand.first").alias("cand_formal")
    )


def name_matches(legislators: DataFrame, candidates: DataFrame, cycles: tuple[int, int] = CYCLES) -> DataFrame:
    """Scored matches of legislators without declared ids, best score per pair.

    Any match needs equal last names, so the last name is part of the join key next to state,
    office and cycle; only real look-alikes meet, and pairs are reduced to their best score
    before they are sent on.  Repeated campaigns need no distinct: a pair keeps its maximum.
    """
    met = _member_campaigns(legislators, cycles).join(_candidate_campaigns(candidates), _BLOCK)
    tried = lambda first, formal: score_parts(
        F.col("cand"), F.col("cand_formal"), F.col(first), F.col(formal), F.col("last"), F.col("suffix"))
    by_nickname = F.when(F.col("nickname") != "", tried("nick", "nick_formal")).otherwise(0.0)
    name_score = bind(tried("first", "first_formal"), lambda s: F.when(s > 0, s).otherwise(by_nickname))
    # Exploding the score drops pairs without a match and evaluates it once; a filter on it
    # would be pushed below the projection and evaluate it again.
    matched = met.select(
        *PAIR, "cand_party", "term_party",
        F.explode(F.filter(F.array(name_score), lambda s: s > 0)).alias("name_score"))
    return (
        matched.withColumn("score", party_adjusted(F.col("name_score"), F.col("cand_party"), F.col("term_party")))
        .groupBy(*PAIR)
        .agg(F.max("score").alias("score"))
        .select(*PAIR, F.lit("name_match").alias("match_method"),
                confidence_band(F.col("score")).alias("confidence"), "score")
    )


def resolve(declared: DataFrame, matched: DataFrame, keep: tuple[str, ...] | None = ("high",)) -> DataFrame:
    """Authoritative pairs plus the name matches that neither contradict them nor point one
    candidate at several legislators.  ``keep=None`` returns every confidence."""
    free = matched.join(declared.select("cand_id").distinct(), "cand_id", "left_anti")
    # Pairs are distinct, so the pair count per candidate is its number of legislators.
    clear = free.groupBy("cand_id").agg(
        F.count(F.lit(1)).alias("owners"),
        *[F.min(c).alias(c) for c in CROSSWALK_COLUMNS if c != "cand_id"],
    ).where("owners = 1")
    both = declared.select(*CROSSWALK_COLUMNS).distinct().unionByName(clear.select(*CROSSWALK_COLUMNS))
    return both if keep is None else both.where(F.col("confidence").isin(*keep))


def build_crosswalk(legislators: DataFrame, candidates: DataFrame, keep=("high",), cycles: tuple[int, int] = CYCLES) -> DataFrame:
    """``cycles``: first and last election cycle that campaigns are looked for in."""
    return resolve(authoritative(legislators, candidates), name_matches(legislators, candidates, cycles), keep)


def audit_expansion(crosswalk: DataFrame, candidates: DataFrame, grown: bool = True) -> DataFrame:
    """(legislator, ids before and after expansion by name), of those who gain ids or of all."""
    before = crosswalk.groupBy("bioguide_id").agg(F.countDistinct("cand_id").alias("linked"))
    after = expand_by_name(crosswalk, candidates).groupBy("bioguide_id").agg(F.count(F.lit(1)).alias("expanded"))
    both = before.join(after, "bioguide_id")
    return both.where("expanded > linked") if grown else both


def apply_overrides(people: DataFrame, overrides: DataFrame, name: str, found: str) -> DataFrame:
    """Replace the id in ``found`` where the person's plain lower-case name has an override.

    ``overrides`` holds (name, bioguide_id, display_name).
    """
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), "[.,']", " "), " +", " "))
    table = overrides.select(F.col("name").alias("_name"), F.col("bioguide_id").alias("_override"))
    return (
        people.withColumn("_name", plain)
        .join(table, "_name", "left")
        .withColumn(found, F.coalesce("_override", found))
        .drop("_name", "_override")
    )


# ---------------------------------------------------------------------------------------
# Use of the crosswalk
# ---------------------------------------------------------------------------------------


def expand_by_name(crosswalk: DataFrame, candidates: DataFrame) -> DataFrame:
    """Give every candidate id with the name of a linked candidate the same legislator ids."""
    keyed = candidates.groupBy("cand_id").agg(F.min("cand_name").alias("cand_name")).select(
        "cand_id", name_key("cand_name").alias("name_key")
    ).where("name_key != '' AND cand_id IS NOT NULL")
    linked = crosswalk.select(*PAIR).join(keyed, "cand_id").select("name_key", "bioguide_id").distinct()
    return keyed.join(linked, "name_key").select(*PAIR).distinct()


def crosswalk_stats(crosswalk: DataFrame) -> DataFrame:
    """(metric, value, n): pairs by method and by confidence, ids with several partners."""
    columns = ["match_method", "confidence", *PAIR]
    facts = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in columns])
    # one pass over the pairs: every column's values are counted together
    counted = crosswalk.select(F.inline(facts)).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    owner = F.col("metric").isin(PAIR)
    rows = counted.select(
        F.when(owner, "several_partners").otherwise(F.col("metric")).alias("metric"),
        F.when(owner, F.col("metric")).otherwise(F.col("value")).alias("value"),
        F.when(owner, (F.col("n") > 1).cast("bigint")).otherwise(F.col("n")).alias("n"))
    none = crosswalk.sparkSession.createDataFrame([("several_partners", c, 0) for c in PAIR], "metric string, value string, n bigint")
    return rows.unionByName(none).groupBy("metric", "value").agg(F.sum("n").alias("n"))


def check_expected(crosswalk: DataFrame, expected: DataFrame) -> DataFrame:
    """Status of every expected (cand_id, bioguide_id): match, mismatch or missing."""
    wanted = expected.select("cand_id", F.col("bioguide_id").alias("expected"))
    found = crosswalk.select("cand_id", F.col("bioguide_id").alias("found"))
    return (
        wanted.join(found, "cand_id", "left")
        .groupBy("cand_id", "expected")
        .agg(F.max(F.col("found") == F.col("expected")).alias("hit"))
        .select(
            "cand_id", "expected",
            F.when(F.col("hit"), "match").when(~F.col("hit"), "mismatch").otherwise("missing").alias("status"),
        )
    )
