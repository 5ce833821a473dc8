"""Stacking of per-cycle files and itemized contributions without grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import iso_date
from ..specs import INDIVIDUAL_COLUMNS, INDIVIDUAL_NAME_COLUMNS, DatasetSpec
from .clean import CYCLE, standardize_names


def combine_cycles(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Cycle first, columns in declared order, names and dates standardised."""
    named = standardize_names(df, spec.name_columns)
    dated = named.withColumns({c: iso_date(c) for c in spec.date_columns})
    return dated.select(CYCLE, *spec.columns)


def combine_individuals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or INDIVIDUAL_COLUMNS
    return standardize_names(df, INDIVIDUAL_NAME_COLUMNS).select(CYCLE, *columns)


def snake_case(df: DataFrame, headers: list[str] | None = None) -> DataFrame:
    """Lower-case column names, taken from ``headers`` when the file has none."""
    return df.toDF(*[h.strip().lower() for h in (headers or df.columns)])


def net_totals(summaries: DataFrame) -> DataFrame:
    """Receipts and disbursements without transfers between a candidate's own committees."""
    money = lambda c: F.coalesce(F.col(c), F.lit(0))
    return summaries.withColumns({
        "net_receipts": money("ttl_receipts") - money("trans_from_auth"),
        "net_disbursements": money("ttl_disb") - money("trans_to_auth"),
        "self_funding": money("cand_contrib") + money("cand_loans"),
    })
