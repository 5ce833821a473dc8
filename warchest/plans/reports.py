"""Reporting queries over the roll-ups and summaries.

A parameter left out means "for all of them": the query then runs over the whole table and
carries the parameter as a column.  A result is sorted only where parameters narrow it; a
result for everybody has no order, as sorting it all would cost a pass and a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CYCLE = "election_cycle"
DIRECT_TYPES = ("24K", "24E")


def _only(df: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def _sorted(df: DataFrame, narrowed: list, *by: Column) -> DataFrame:
    return df.orderBy(*by) if any(p is not None for p in narrowed) else df


def _sum(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def _links(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.select("cand_id", "bioguide_id")


def member_summary(summaries: DataFrame, crosswalk: DataFrame, bioguide_id: str | None = None) -> DataFrame:
    """Financial history of a member, newest cycle first."""
    links = _only(_links(crosswalk), bioguide_id=bioguide_id)
    out = summaries.join(links, "cand_id").select(
        "bioguide_id", "cand_id", F.col(CYCLE).alias("year"), "ttl_receipts", "ttl_disb", "coh_cop",
        "ttl_indiv_contrib", "other_pol_cmte_contrib", "pol_pty_contrib",
        (F.col("cand_contrib") + F.col("cand_loans")).alias("self_funding"),
    )
    return _sorted(out, [bioguide_id], F.desc("year"))


def top_committees(given: DataFrame, crosswalk: DataFrame, bioguide_id: str | None = None,
                   cycle: int | None = None, k: int = 20) -> DataFrame:
    """Largest direct and independent supporters of a member in a cycle."""
    direct = _only(given, election_cycle=cycle).where(F.col("transaction_tp").isin(*DIRECT_TYPES))
    # Sums per candidate first: the crosswalk then meets grouped rows only.
    per_candidate = direct.groupBy(CYCLE, "cand_id", "cmte_id", "cmte_name").agg(
        _sum("total_amount", "amount"), _sum("transaction_count", "n"))
    totals = (
        per_candidate.join(_only(_links(crosswalk), bioguide_id=bioguide_id), "cand_id")
        .groupBy("bioguide_id", CYCLE, "cmte_id", "cmte_name")
        .agg(_sum("amount", "total_contributed"), _sum("n", "num_transactions"))
    )
    order = [F.desc("total_contributed"), F.asc_nulls_first("cmte_id"), F.asc_nulls_first("cmte_name")]
    if bioguide_id is not None and cycle is not None:
        return totals.orderBy(*order).limit(k)
    best = Window.partitionBy("bioguide_id", CYCLE).orderBy(*order)
    return totals.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).drop("_rank")


def principal_committees(committees: DataFrame, crosswalk: DataFrame) -> DataFrame:
    main = committees.where("cmte_dsgn = 'P'").select(CYCLE, "cmte_id", "cand_id")
    return main.join(_links(crosswalk), "cand_id").select("bioguide_id", CYCLE, "cmte_id").distinct()


def expenditure_breakdown(by_category: DataFrame, committees: DataFrame, crosswalk: DataFrame,
                          bioguide_id: str | None = None, cycle: int | None = None) -> DataFrame:
    """What a member's principal committee spent its money on."""
    owners = _only(principal_committees(committees, crosswalk), bioguide_id=bioguide_id, election_cycle=cycle)
    spent = by_category.groupBy(CYCLE, "cmte_id", "category", "category_desc").agg(_sum("total_amount", "amount"))
    out = (
        spent.join(owners, [CYCLE, "cmte_id"])
        .groupBy("bioguide_id", CYCLE, "category", "category_desc")
        .agg(_sum("amount", "total_spent"))
    )
    return _sorted(out, [bioguide_id, cycle], F.desc("total_spent"))


def committee_received(flows: DataFrame, cmte_id: str | None = None, cycle: int | None = None) -> DataFrame:
    """Incoming money of a committee."""
    return _only(flows, dest_cmte_id=cmte_id, election_cycle=cycle).groupBy("dest_cmte_id", CYCLE).agg(
        _sum("total_amount", "received"), _sum("transaction_count", "num_transactions"))


def committee_given(given: DataFrame, summaries: DataFrame, crosswalk: DataFrame,
                    cmte_id: str | None = None, cycle: int | None = None) -> DataFrame:
    """Outgoing money of a committee by candidate, with the member it links to, if any."""
    paid = _only(given, cmte_id=cmte_id, election_cycle=cycle).groupBy(CYCLE, "cmte_id", "cand_id").agg(
        _sum("total_amount", "amount"))
    named = paid.join(summaries.select(CYCLE, "cand_id", "cand_name"), [CYCLE, "cand_id"])
    out = (
        named.join(_links(crosswalk), "cand_id", "left")
        .groupBy(CYCLE, "cmte_id", "cand_id", "cand_name", "bioguide_id")
        .agg(_sum("amount", "contributed"))
    )
    return _sorted(out, [cmte_id, cycle], F.desc("contributed"))


def committee_search(committees: DataFrame, text: str, k: int = 50) -> DataFrame:
    """Committees whose name contains ``text`` in any case, most recently registered first.
    ``%`` and ``_`` are wildcards; a backslash is a backslash."""
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    latest = committees.where(F.col("cmte_nm").ilike(pattern)).groupBy("cmte_id").agg(
        F.max(F.struct(CYCLE, "cmte_nm", "cmte_tp")).alias("r"))
    return latest.select(
        "cmte_id", "r.cmte_nm", "r.cmte_tp", F.col(f"r.{CYCLE}").alias("latest_year")
    ).orderBy(F.desc("latest_year"), "cmte_id").limit(k)


def large_contributions(given: DataFrame, summaries: DataFrame, amount, cycle: int | None = None) -> DataFrame:
    """Contribution totals of at least ``amount``."""
    large = _only(given, election_cycle=cycle).where(F.col("total_amount") >= amount)
    out = large.join(summaries.select(CYCLE, "cand_id", "cand_name"), [CYCLE, "cand_id"]).select(
        CYCLE, "cmte_name", "cand_name", "total_amount")
    return _sorted(out, [cycle], F.desc("total_amount"))


def individual_totals(individual: DataFrame, cycle: int | None = None) -> DataFrame:
    out = _only(individual, election_cycle=cycle).groupBy(CYCLE, "cand_id").agg(
        _sum("total_raised", "total_raised"), _sum("transaction_count", "transaction_count"))
    return _sorted(out, [cycle], F.desc("total_raised"))


def monthly_trend(individual: DataFrame, cycle: int) -> DataFrame:
    return _only(individual, election_cycle=cycle).groupBy("transaction_month").agg(
        _sum("total_raised", "total_raised"), _sum("transaction_count", "transaction_count")
    ).orderBy("transaction_month")


def served_candidates(candidates: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Registrations of candidates that served in Congress."""
    return candidates.join(_links(crosswalk), "cand_id", "left").where("bioguide_id IS NOT NULL")


def count_served(candidates: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return served_candidates(candidates, crosswalk).agg(
        F.countDistinct("cand_id").alias("candidates"), F.count(F.lit(1)).alias("registrations"))


def fundraising_over_time(summaries: DataFrame, cand_id: str | None = None) -> DataFrame:
    out = _only(summaries, cand_id=cand_id).select("cand_id", CYCLE, "ttl_receipts", "ttl_disb", "coh_cop")
    return _sorted(out, [cand_id], F.col(CYCLE))


def funders_of_candidates(given: DataFrame) -> DataFrame:
    return given.groupBy(CYCLE, "cand_id", "cmte_id").agg(
        _sum("total_amount", "total_amount"), _sum("transaction_count", "transaction_count"))


def flow_between_committees(flows: DataFrame) -> DataFrame:
    return flows.groupBy(CYCLE, "source_cmte_id", "dest_cmte_id").agg(
        _sum("total_amount", "total_amount"), _sum("transaction_count", "transaction_count"))


def spend_by_state(by_state: DataFrame) -> DataFrame:
    return by_state.groupBy(CYCLE, "state").agg(
        _sum("total_amount", "total_amount"), _sum("transaction_count", "transaction_count"))


def spend_by_category(by_category: DataFrame) -> DataFrame:
    return by_category.groupBy(CYCLE, "category", "category_desc").agg(
        _sum("total_amount", "total_amount"), _sum("transaction_count", "transaction_count"))
