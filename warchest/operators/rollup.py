"""Roll-ups of itemized transactions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import capitalize_name, transaction_month, transaction_year
from ..specs import SPECS, DatasetSpec
from .clean import CYCLE, dedupe, exclude_amendments, exclude_memos, is_amended, is_memo, standardize_names

OPEN_CYCLE = 2026
TOTAL = "decimal(30,2)"


def _measures(total: str = "total_amount"):
    return (
        F.coalesce(F.sum("amount"), F.lit(0)).cast(TOTAL).alias(total),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def _regrouped(total: str):
    return (
        F.sum(total).cast(TOTAL).alias(total),
        F.sum("transaction_count").alias("transaction_count"),
    )


def countable(df: DataFrame, spec: DatasetSpec, keep: list[str], scope: str = "cycle",
              order: tuple[str, ...] | None = None) -> DataFrame:
    """Transactions that count once: no memos, no amendments, one row per id.

    Only ``keep``, the keys and the columns of the survivor's order travel through the
    de-duplication shuffle.  The order belongs to the family, so every roll-up of it keeps
    the same rows.
    """
    kept = exclude_amendments(exclude_memos(df, spec.memo), spec.amendment)
    order = spec.survivor_order if order is None else order
    return dedupe(kept.select(CYCLE, spec.sub_id, *dict.fromkeys([*order, *keep])), spec.sub_id, scope, order)


def _payload(spec: DatasetSpec) -> list[str]:
    return [*spec.key_sources.values(), spec.date, spec.amount]


#: Repeated ids that are sent to every task, by each roll-up (a table of about 100 MB); beyond, one join marks their rows, which are stored again.
SENT_IDS = 1_000_000
_ID = "_id"


@dataclass(frozen=True)
class Prepared:
    """What several roll-ups of the same transactions share, stored once."""

    once: DataFrame  # neither memos nor amendments, and no other row has the hash of (id, cycle)
    again: DataFrame  # the other rows
    names: dict[str, DataFrame]  # raw name column -> (the column, `_name`)


def prepare(df: DataFrame, specs: list[DatasetSpec], store: Callable[[DataFrame, str], DataFrame]) -> Prepared:
    """One scan for all roll-ups, whatever they group by and whichever row of an id each of them keeps.

    Ids that occur once, nearly all, need no de-duplication: they are told apart by counting hashes, and only rows of the
    others are sorted by each roll-up.  Distinct names are capitalised once, instead of once per group and roll-up.
    ``store`` writes rows under a name and reads them back.
    """
    first = specs[0]
    shared = ("memo", "amendment", "sub_id", "date", "amount")
    if any(getattr(s, a) != getattr(first, a) for s in specs for a in shared):
        raise ValueError("roll-ups of different columns")
    kept = exclude_amendments(exclude_memos(df, first.memo), first.amendment)
    columns = dict.fromkeys([CYCLE, first.sub_id, *[c for s in specs for c in (*s.survivor_order, *_payload(s))]])
    rows = store(kept.select(*columns, transaction_year(first.date).alias("transaction_year"), F.xxhash64(first.sub_id, CYCLE).alias(_ID)), "rows")
    repeated = store(rows.groupBy(_ID).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_ID), "repeated")
    if repeated.count() <= SENT_IDS:
        again, once = store(rows.join(F.broadcast(repeated), _ID, "left_semi"), "again"), rows.join(F.broadcast(repeated), _ID, "left_anti")
    else:
        marked = store(rows.join(repeated.withColumn("_many", F.lit(True)), _ID, "left"), "marked")
        again, once = store(marked.where("_many"), "again"), marked.where("_many IS NULL")
    sources = dict.fromkeys(s.key_sources[c] for s in specs for c in s.name_columns)
    names = {c: store(rows.select(c).where(F.col(c).isNotNull()).distinct().withColumn("_name", capitalize_name(c)), f"names_{c}") for c in sources}
    return Prepared(once, again, names)


def _rollup_prepared(made: Prepared, spec: DatasetSpec) -> DataFrame:
    """Rows meet their finished names before they are grouped, so one grouping does."""
    order, source = spec.survivor_order, spec.key_sources
    kept = dedupe(made.again.select(CYCLE, spec.sub_id, *dict.fromkeys([*order, *_payload(spec)])), spec.sub_id, "cycle", order)
    columns = [CYCLE, "transaction_year", *dict.fromkeys([*source.values(), spec.amount])]
    rows = made.once.select(*columns).unionByName(kept.withColumn("transaction_year", transaction_year(spec.date)).select(*columns))
    keys = {out: F.col(src) for out, src in source.items()}
    for out in spec.name_columns:
        named = made.names[source[out]].withColumnRenamed("_name", f"_{out}")
        rows, keys[out] = rows.join(named, source[out], "left"), F.col(f"_{out}")
    rows = rows.select(CYCLE, "transaction_year", *[c.alias(out) for out, c in keys.items()], F.col(spec.amount).alias("amount"))
    return rows.groupBy(*spec.group_by).agg(*_measures())


def rollup(df: DataFrame | Prepared, spec: DatasetSpec, scope: str = "cycle") -> DataFrame:
    """Total and count per ``spec.group_by``.

    Names are capitalised so that spelling variants merge.  That happens on the grouped rows
    and a second, much smaller grouping merges them: names are worked on once per group
    instead of once per transaction.  Who makes several roll-ups of the same rows passes what ``prepare`` stored.
    """
    if isinstance(df, Prepared):
        if scope != "cycle":
            raise ValueError(scope)
        return _rollup_prepared(df, spec)
    rows = countable(df, spec, _payload(spec), scope).select(
        CYCLE,
        transaction_year(spec.date).alias("transaction_year"),
        *[F.col(src).alias(out) for out, src in spec.key_sources.items()],
        F.col(spec.amount).alias("amount"),
    )
    grouped = rows.groupBy(*spec.group_by).agg(*_measures())
    if not spec.name_columns:
        return grouped
    return (
        standardize_names(grouped, spec.name_columns)
        .groupBy(*spec.group_by)
        .agg(*_regrouped("total_amount"))
    )


def expenditure_rollups(df: DataFrame, scope: str = "cycle") -> tuple[DataFrame, DataFrame]:
    """By category and by state from one scan, one de-duplication and one fine grouping.

    Within one query Spark reuses the exchange of the fine grouping; who writes both results
    by separate jobs keeps ``fine_expenditures`` instead.
    """
    fine = fine_expenditures(df, scope)
    return (
        regroup(fine, SPECS["expenditures_by_category"]),
        regroup(fine, SPECS["expenditures_by_state"]),
    )


def fine_expenditures(df: DataFrame, scope: str = "cycle") -> DataFrame:
    category, state = SPECS["expenditures_by_category"], SPECS["expenditures_by_state"]
    keys = list(dict.fromkeys([*category.group_by, *state.group_by]))
    rows = countable(df, category, _payload(category) + _payload(state), scope).select(
        *[k for k in keys if k != "transaction_year"],
        transaction_year(category.date).alias("transaction_year"),
        F.col(category.amount).alias("amount"),
    )
    return rows.groupBy(*keys).agg(*_measures())


def regroup(fine: DataFrame, spec: DatasetSpec) -> DataFrame:
    return fine.groupBy(*spec.group_by).agg(*_regrouped("total_amount"))


def exclusion_audit(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows per cycle lost to memos, then amendments, then duplicate ids.

    One narrow shuffle of counters on (id, cycle), combined before it is sent.
    """
    memo, amended = is_memo(spec.memo), is_amended(spec.amendment)
    per_id = df.groupBy(spec.sub_id, CYCLE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(memo).alias("memo"),
        F.count_if(~memo & amended).alias("amended"),
        F.count_if(~memo & ~amended).alias("eligible"),
    )
    return per_id.groupBy(CYCLE).agg(
        F.sum("n").alias("input_rows"),
        F.sum("memo").alias("memo_rows"),
        F.sum("amended").alias("amended_rows"),
        F.sum(F.greatest(F.col("eligible") - 1, F.lit(0))).alias("duplicate_rows"),
        F.sum(F.least(F.col("eligible"), F.lit(1))).alias("kept_rows"),
    )


# ---------------------------------------------------------------------------------------
# Individual contributions by candidate
# ---------------------------------------------------------------------------------------

CANDIDATE_COMMITTEE_TYPES = ("H", "S", "P")
_INDIVIDUAL = SPECS["committee_transaction_summaries"]  # same raw layout
_INDIVIDUAL_ORDER = ("cmte_id", "transaction_dt", "transaction_amt")


def committee_lookup(committees: DataFrame) -> DataFrame:
    """Distinct (cycle, committee, candidate) of candidate committees."""
    return (
        committees.where(
            F.col("cmte_tp").isin(*CANDIDATE_COMMITTEE_TYPES)
            & F.col("cand_id").isNotNull()
            & (F.col("cand_id") != "")
        )
        .select(CYCLE, "cmte_id", "cand_id")
        .distinct()
    )


def individual_by_candidate(
    contributions: DataFrame,
    committees: DataFrame,
    crosswalk: DataFrame | None = None,
    open_cycle: int = OPEN_CYCLE,
    scope: str = "cycle",
) -> DataFrame:
    """Money raised from individuals per candidate, year and (open cycle only) month.

    Contributions are summed per committee before the committee meets its candidates: the
    joins then work on committee totals, so neither a large committee nor the size of the
    lookup matters.  A committee of two candidates counts for both, and a candidate with
    several legislator ids gets one row per id.
    """
    rows = countable(contributions, _INDIVIDUAL, list(_INDIVIDUAL_ORDER), scope, _INDIVIDUAL_ORDER)
    # Month only where it is reported; elsewhere it would split the groups for nothing.
    month = F.when(F.col(CYCLE) == open_cycle, transaction_month("transaction_dt"))
    per_committee = (
        rows.select(
            CYCLE,
            "cmte_id",
            transaction_year("transaction_dt").alias("transaction_year"),
            month.alias("transaction_month"),
            F.col("transaction_amt").alias("amount"),
        )
        .groupBy(CYCLE, "cmte_id", "transaction_year", "transaction_month")
        .agg(*_measures("total_raised"))
    )
    totals = (
        per_committee.join(committee_lookup(committees), [CYCLE, "cmte_id"])
        .groupBy(CYCLE, "transaction_year", "transaction_month", "cand_id")
        .agg(*_regrouped("total_raised"))
    )
    if crosswalk is None:
        linked = totals.withColumn("bioguide_id", F.lit(None).cast("string"))
    else:
        linked = totals.join(crosswalk.select("cand_id", "bioguide_id"), "cand_id", "left")
    return linked.select(
        CYCLE, "transaction_year", "transaction_month", "cand_id", "bioguide_id",
        "total_raised", "transaction_count",
    )
