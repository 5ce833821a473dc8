"""Dataset specifications: explicit schemas, roll-up keys and standardisation columns.

Nothing is inferred from data.  Every code, date and ZIP stays a string so that leading
zeros survive; money is ``decimal(20,2)``, wide enough for absurd amounts to be seen and
reported; counts and years are integers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 2)

# ---------------------------------------------------------------------------------------
# Raw column names and order of the bulk files.
# ---------------------------------------------------------------------------------------

CANDIDATE_SUMMARY_COLUMNS = [
    "cand_id", "cand_name", "cand_ici", "pty_cd", "cand_pty_affiliation", "ttl_receipts",
    "trans_from_auth", "ttl_disb", "trans_to_auth", "coh_bop", "coh_cop", "cand_contrib",
    "cand_loans", "other_loans", "cand_loan_repay", "other_loan_repay", "debts_owed_by",
    "ttl_indiv_contrib", "cand_office_st", "cand_office_district", "spec_election",
    "prim_election", "run_election", "gen_election", "gen_election_precent",
    "other_pol_cmte_contrib", "pol_pty_contrib", "cvg_end_dt", "indiv_refunds", "cmte_refunds",
]

CANDIDATE_COLUMNS = [
    "cand_id", "cand_name", "cand_pty_affiliation", "cand_election_yr", "cand_office_st",
    "cand_office", "cand_office_district", "cand_ici", "cand_status", "cand_pcc", "cand_st1",
    "cand_st2", "cand_city", "cand_st", "cand_zip",
]

CANDIDATE_LINK_COLUMNS = [
    "cand_id", "cand_election_yr", "fec_election_yr", "cmte_id", "cmte_tp", "cmte_dsgn",
    "linkage_id",
]

COMMITTEE_COLUMNS = [
    "cmte_id", "cmte_nm", "tres_nm", "cmte_st1", "cmte_st2", "cmte_city", "cmte_st", "cmte_zip",
    "cmte_dsgn", "cmte_tp", "cmte_pty_affiliation", "cmte_filing_freq", "org_tp",
    "connected_org_nm", "cand_id",
]

PAC_SUMMARY_COLUMNS = [
    "cmte_id", "cmte_nm", "cmte_tp", "cmte_dsgn", "cmte_filing_freq", "ttl_receipts",
    "trans_from_aff", "indv_contrib", "other_pol_cmte_contrib", "cand_contrib", "cand_loans",
    "ttl_loans_received", "ttl_disb", "trans_to_aff", "indv_refunds", "other_pol_cmte_refunds",
    "cand_loan_repay", "loan_repay", "coh_bop", "coh_cop", "debts_owed_by",
    "nonfed_trans_received", "contrib_to_other_cmte", "ind_exp", "pty_coord_exp",
    "nonfed_share_exp", "cvg_end_dt",
]

COMMITTEE_TRANSACTION_COLUMNS = [
    "cmte_id", "amndt_ind", "rpt_tp", "transaction_pgi", "image_num", "transaction_tp",
    "entity_tp", "name", "city", "state", "zip_code", "employer", "occupation",
    "transaction_dt", "transaction_amt", "other_id", "tran_id", "file_num", "memo_cd",
    "memo_text", "sub_id",
]

COMMITTEE_TO_CANDIDATE_COLUMNS = [
    "cmte_id", "amndt_ind", "rpt_tp", "transaction_pgi", "image_num", "transaction_tp",
    "entity_tp", "name", "city", "state", "zip_code", "employer", "occupation",
    "transaction_dt", "transaction_amt", "cand_id", "tran_id", "file_num", "memo_cd",
    "memo_text", "sub_id",
]

EXPENDITURE_COLUMNS = [
    "cmte_id", "amndt_ind", "rpt_yr", "rpt_tp", "image_num", "line_num", "form_tp_cd",
    "sched_tp_cd", "name", "city", "state", "zip_code", "transaction_dt", "transaction_amt",
    "transaction_pgi", "purpose", "category", "category_desc", "memo_cd", "memo_text",
    "entity_tp", "sub_id", "file_num", "tran_id", "back_ref_tran_id",
]

INDIVIDUAL_COLUMNS = COMMITTEE_TRANSACTION_COLUMNS

# ---------------------------------------------------------------------------------------
# Types by column name (our decision; the bulk files carry none).
# ---------------------------------------------------------------------------------------

_INT_COLUMNS = {"cand_election_yr", "fec_election_yr", "rpt_yr", "election_cycle", "transaction_year"}
_TYPED = {"gen_election_precent": T.DecimalType(7, 4)}
_STRING_COLUMNS_IN_SUMMARIES = {
    "cand_id", "cand_name", "cand_ici", "pty_cd", "cand_pty_affiliation", "cand_office_st",
    "cand_office_district", "spec_election", "prim_election", "run_election", "gen_election",
    "cvg_end_dt", "cmte_id", "cmte_nm", "cmte_tp", "cmte_dsgn", "cmte_filing_freq",
}


def _column_type(name: str, summary: bool) -> T.DataType:
    if name in _TYPED:
        return _TYPED[name]
    if name in _INT_COLUMNS:
        return T.IntegerType()
    if name == "transaction_amt" or (summary and name not in _STRING_COLUMNS_IN_SUMMARIES):
        return MONEY
    return T.StringType()


def schema_of(columns: list[str], summary: bool = False) -> T.StructType:
    return T.StructType([T.StructField(c, _column_type(c, summary)) for c in columns])


# ---------------------------------------------------------------------------------------
# Specs
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class DatasetSpec:
    """One bulk-file family.

    ``group_by`` is empty for families that are only stacked cycle by cycle; otherwise the
    family is rolled up on those keys and ``mapping`` names the raw column behind each key.
    """

    name: str
    prefix: str
    start_year: int
    columns: tuple[str, ...]
    summary: bool = False
    group_by: tuple[str, ...] = ()
    mapping: dict[str, str] = field(default_factory=dict)
    name_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    amount: str = "transaction_amt"
    date: str = "transaction_dt"
    memo: str = "memo_cd"
    amendment: str = "amndt_ind"
    sub_id: str = "sub_id"
    same_file_as: str | None = None
    tie_break: tuple[str, ...] = ()

    @property
    def is_rollup(self) -> bool:
        return bool(self.group_by)

    @property
    def raw_schema(self) -> T.StructType:
        return schema_of(list(self.columns), self.summary)

    @property
    def key_sources(self) -> dict[str, str]:
        """Output key -> raw column, without the two derived keys."""
        derived = ("election_cycle", "transaction_year")
        return {k: self.mapping.get(k, k) for k in self.group_by if k not in derived}

    @property
    def survivor_order(self) -> tuple[str, ...]:
        """Columns that decide which of the rows of one id stays, whatever a roll-up reads."""
        return self.tie_break or (*self.key_sources.values(), self.date, self.amount)


def _stacked(name, prefix, start, columns, *, summary=False, names=(), dates=()):
    return DatasetSpec(name, prefix, start, tuple(columns), summary=summary,
                       name_columns=tuple(names), date_columns=tuple(dates))


def _rolled(name, prefix, start, columns, keys, mapping=None, names=(), same_file_as=None, tie_break=()):
    return DatasetSpec(name, prefix, start, tuple(columns),
                       group_by=("election_cycle", "transaction_year", *keys),
                       mapping=mapping or {}, name_columns=tuple(names),
                       same_file_as=same_file_as, tie_break=tuple(tie_break))


# Both roll-ups of the expenditure files keep the same row of an id.
_EXPENDITURE_ORDER = ("cmte_id", "category", "category_desc", "transaction_dt", "transaction_amt", "state")


# Families, file prefixes, first cycles, roll-up keys, name and date columns.
SPECS: dict[str, DatasetSpec] = {
    s.name: s
    for s in [
        _stacked("all_candidate_summaries", "weball", 1980, CANDIDATE_SUMMARY_COLUMNS,
                 summary=True, names=["cand_name"], dates=["cvg_end_dt"]),
        _stacked("candidate_registrations", "cn", 1980, CANDIDATE_COLUMNS, names=["cand_name"]),
        _stacked("candidate_committee_links", "ccl", 2000, CANDIDATE_LINK_COLUMNS),
        _stacked("committee_registrations", "cm", 1980, COMMITTEE_COLUMNS,
                 names=["cmte_nm", "tres_nm", "connected_org_nm"]),
        _stacked("house_senate_campaign_summaries", "webl", 1996, CANDIDATE_SUMMARY_COLUMNS,
                 summary=True, names=["cand_name"], dates=["cvg_end_dt"]),
        _stacked("pac_party_summaries", "webk", 1996, PAC_SUMMARY_COLUMNS,
                 summary=True, names=["cmte_nm"], dates=["cvg_end_dt"]),
        _rolled("committee_transaction_summaries", "oth", 1980, COMMITTEE_TRANSACTION_COLUMNS,
                ["source_cmte_id", "dest_cmte_id", "dest_name", "transaction_tp"],
                {"source_cmte_id": "cmte_id", "dest_cmte_id": "other_id", "dest_name": "name"},
                names=["dest_name"]),
        _rolled("committee_to_candidate_summaries", "pas2", 1980, COMMITTEE_TO_CANDIDATE_COLUMNS,
                ["cmte_id", "cmte_name", "cand_id", "transaction_tp"],
                {"cmte_name": "name"}, names=["cmte_name"]),
        _rolled("expenditures_by_category", "oppexp", 2004, EXPENDITURE_COLUMNS,
                ["cmte_id", "category", "category_desc"], tie_break=_EXPENDITURE_ORDER),
        _rolled("expenditures_by_state", "oppexp", 2004, EXPENDITURE_COLUMNS,
                ["cmte_id", "state"], same_file_as="expenditures_by_category", tie_break=_EXPENDITURE_ORDER),
    ]
}

#: Name columns of the itemized individual contributions.
INDIVIDUAL_NAME_COLUMNS = ("name", "employer", "occupation")

#: Standardisation jobs at table level: finished table -> columns.
TABLE_NAME_COLUMNS = {n: s.name_columns for n, s in SPECS.items() if s.name_columns}
TABLE_DATE_COLUMNS = {n: s.date_columns for n, s in SPECS.items() if s.date_columns}

# ---------------------------------------------------------------------------------------
# Derived tables
# ---------------------------------------------------------------------------------------

CROSSWALK = T.StructType([
    T.StructField("cand_id", T.StringType()),
    T.StructField("bioguide_id", T.StringType()),
    T.StructField("match_method", T.StringType()),
    T.StructField("confidence", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("cycle", T.IntegerType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("last_updated", T.StringType()),
])


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


LEGISLATOR_ID = T.StructType(
    _strings("bioguide", "thomas", "lis", "govtrack", "opensecrets", "votesmart", "cspan",
             "wikipedia", "house_history", "ballotpedia", "maplight", "icpsr", "wikidata",
             "google_entity_id")
    + [T.StructField("fec", T.ArrayType(T.StringType()))])
LEGISLATOR_NAME = T.StructType(
    _strings("first", "last", "middle", "suffix", "nickname", "official_full"))
LEGISLATOR_BIO = T.StructType(_strings("gender", "birthday", "religion"))
LEGISLATOR_TERM = T.StructType(
    _strings("type", "start", "end", "state")
    + [T.StructField("district", T.IntegerType())]
    + _strings("party")
    + [T.StructField("class", T.IntegerType())]
    + _strings("state_rank", "url", "address", "phone", "fax", "contact_form", "office",
               "rss_url", "how"))
LEGISLATOR = T.StructType([
    T.StructField("id", LEGISLATOR_ID),
    T.StructField("name", LEGISLATOR_NAME),
    T.StructField("bio", LEGISLATOR_BIO),
    T.StructField("terms", T.ArrayType(LEGISLATOR_TERM)),
])
