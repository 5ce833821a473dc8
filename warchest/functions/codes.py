"""Code tables, code decoding and identifier checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lookup

# Code tables.
COMMITTEE_TYPES = {
    "C": "Communication cost",
    "D": "Delegate committee",
    "E": "Electioneering communication",
    "H": "House campaign",
    "I": "Independent expenditor (person or group)",
    "N": "PAC - Nonqualified",
    "O": "Independent expenditure-only (Super PACs)",
    "P": "Presidential campaign",
    "Q": "PAC - Qualified",
    "S": "Senate campaign",
    "U": "Single candidate independent expenditure",
    "V": "PAC with non-contribution account",
    "W": "PAC with non-contribution account - Nonqualified",
    "X": "Party - Nonqualified",
    "Y": "Party - Qualified",
    "Z": "National party nonfederal account",
}
DESIGNATIONS = {
    "A": "Authorized by a candidate",
    "B": "Lobbyist/Registrant PAC",
    "D": "Leadership PAC",
    "J": "Joint fundraiser",
    "P": "Principal campaign committee",
    "U": "Unauthorized",
}
TRANSACTION_TYPES = {
    "24A": "Independent expenditure AGAINST candidate",
    "24E": "Independent expenditure FOR candidate",
    "24K": "Direct contribution to candidate",
    "24N": "Communication cost FOR candidate",
}
STANDARD_CATEGORIES = {
    "001": "Administrative/Salary/Overhead Expenses",
    "002": "Travel Expenses",
    "003": "Solicitation and Fundraising Expenses",
    "004": "Advertising Expenses",
    "005": "Polling Expenses",
    "006": "Campaign Materials",
    "007": "Campaign Event Expenses",
    "008": "Transfers",
    "009": "Loan Repayments",
    "010": "Refunds of Contributions",
    "011": "Political Contributions",
    "012": "Donations",
}
PRESIDENTIAL_CATEGORIES = {
    "101": "Non-Allocable Expenses",
    "102": "Media Expenditures",
    "103": "Mass Mailings and Campaign Materials",
    "104": "State Office Overhead Expenses",
    "105": "Special Telephone Program Expenditures",
    "106": "Public Opinion Poll Expenditures",
    "107": "Fundraising Expenditures",
}
CATEGORIES = STANDARD_CATEGORIES | PRESIDENTIAL_CATEGORIES
PARTIES = {
    "DEM": "Democratic Party",
    "REP": "Republican Party",
    "IND": "Independent",
    "LIB": "Libertarian Party",
    "GRE": "Green Party",
    "CON": "Constitution Party",
    "REF": "Reform Party",
}
INCUMBENCY = {"I": "Incumbent", "C": "Challenger", "O": "Open Seat"}
OFFICES = {"H": "House", "S": "Senate", "P": "President"}
STATUSES = {"C": "Current", "P": "Prior", "F": "Future"}

CODE_TABLES: dict[str, dict[str, str]] = {
    "cmte_tp": COMMITTEE_TYPES,
    "cmte_dsgn": DESIGNATIONS,
    "transaction_tp": TRANSACTION_TYPES,
    "category": CATEGORIES,
    "cand_pty_affiliation": PARTIES,
    "cand_ici": INCUMBENCY,
    "cand_office": OFFICES,
    "cand_status": STATUSES,
}

OTHER_CATEGORY = "012"


def decode(column: str, table: str | None = None) -> Column:
    """Label of the code in ``column``; NULL for an unknown code."""
    return lookup(CODE_TABLES[table or column], F.col(column))


def is_known_category(category: Column) -> Column:
    return category.isin(list(CATEGORIES))


def fold_category(category: Column) -> Column:
    """Non-standard category codes become the catch-all code; NULL stays NULL."""
    return F.when(category.isNull() | is_known_category(category), category).otherwise(F.lit(OTHER_CATEGORY))


def known_category(category: Column) -> Column:
    """The other treatment: a non-standard code becomes NULL, to be left out."""
    return F.when(is_known_category(category), category)


def is_candidate_id(c: Column) -> Column:
    """Nine characters that start with the office letter."""
    return F.coalesce(c.rlike(r"\A[HSP].{8}\z"), F.lit(False))


def is_committee_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\AC.{8}\z"), F.lit(False))
