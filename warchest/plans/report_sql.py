"""The reports as SQL table functions over the stored tables.

``register`` names the finished tables of a folder as temporary views and each report as a function with parameters, so

    SELECT * FROM top_committees(bioguide => 'A000001', in_cycle => 2024, k => 10) ORDER BY total_contributed DESC

plans like the DataFrame report of that name: a function's body becomes part of the query, and filters on its parameters reach the
scans.  A parameter left out, or NULL, means "for all of them".  Rows have no order unless the query asks for one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table_or_none

#: View of a stored table.
VIEWS = {
    "summaries": "all_candidate_summaries", "crosswalk": "cand_id_bioguide_crosswalk", "candidates": "candidate_registrations",
    "committees": "committee_registrations", "given": "committee_to_candidate_summaries", "flows": "committee_transaction_summaries",
    "spent_by_category": "expenditures_by_category", "spent_by_state": "expenditures_by_state",
    "individual": "candidate_individual_contribution_summaries",
}

_LINKS = "(SELECT cand_id, bioguide_id FROM fec_crosswalk)"
_COUNT = "transaction_count BIGINT"


def _is(column: str, parameter: str) -> str:
    return f"({parameter} IS NULL OR {column} = {parameter})"


#: name -> (parameters, columns, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "member_summary": (
        "bioguide STRING DEFAULT NULL",
        "bioguide_id STRING, cand_id STRING, year INT, ttl_receipts DOUBLE, ttl_disb DOUBLE, coh_cop DOUBLE, ttl_indiv_contrib DOUBLE, "
        "other_pol_cmte_contrib DOUBLE, pol_pty_contrib DOUBLE, self_funding DOUBLE",
        f"""SELECT l.bioguide_id, s.cand_id, s.election_cycle, s.ttl_receipts, s.ttl_disb, s.coh_cop, s.ttl_indiv_contrib,
              s.other_pol_cmte_contrib, s.pol_pty_contrib, s.cand_contrib + s.cand_loans
            FROM fec_summaries s JOIN {_LINKS} l ON l.cand_id = s.cand_id WHERE {_is('l.bioguide_id', 'bioguide')}"""),
    "top_committees": (
        "bioguide STRING DEFAULT NULL, in_cycle INT DEFAULT NULL, k INT DEFAULT 20",
        "bioguide_id STRING, election_cycle INT, cmte_id STRING, cmte_name STRING, total_contributed DOUBLE, num_transactions BIGINT",
        f"""SELECT bioguide_id, election_cycle, cmte_id, cmte_name, total, n FROM (
              SELECT *, row_number() OVER (PARTITION BY bioguide_id, election_cycle
                  ORDER BY total DESC, cmte_id NULLS FIRST, cmte_name NULLS FIRST) AS place
              FROM (SELECT l.bioguide_id, d.election_cycle, d.cmte_id, d.cmte_name, sum(d.total) AS total, sum(d.n) AS n
                FROM (SELECT election_cycle, cand_id, cmte_id, cmte_name, sum(total_amount) AS total, sum(transaction_count) AS n
                  FROM fec_given WHERE transaction_tp IN ('24K', '24E') AND {_is('election_cycle', 'in_cycle')}
                  GROUP BY election_cycle, cand_id, cmte_id, cmte_name) d
                JOIN {_LINKS} l ON l.cand_id = d.cand_id WHERE {_is('l.bioguide_id', 'bioguide')}
                GROUP BY l.bioguide_id, d.election_cycle, d.cmte_id, d.cmte_name) t) r
            WHERE place <= k"""),
    "expenditure_breakdown": (
        "bioguide STRING DEFAULT NULL, in_cycle INT DEFAULT NULL",
        "bioguide_id STRING, election_cycle INT, category STRING, category_desc STRING, total_spent DOUBLE",
        f"""SELECT o.bioguide_id, s.election_cycle, s.category, s.category_desc, sum(s.amount)
            FROM (SELECT election_cycle, cmte_id, category, category_desc, sum(total_amount) AS amount FROM fec_spent_by_category
              WHERE {_is('election_cycle', 'in_cycle')} GROUP BY election_cycle, cmte_id, category, category_desc) s
            JOIN (SELECT DISTINCT l.bioguide_id, c.election_cycle, c.cmte_id FROM fec_committees c
              JOIN {_LINKS} l ON l.cand_id = c.cand_id
              WHERE c.cmte_dsgn = 'P' AND {_is('l.bioguide_id', 'bioguide')} AND {_is('c.election_cycle', 'in_cycle')}) o
              ON o.election_cycle = s.election_cycle AND o.cmte_id = s.cmte_id
            GROUP BY o.bioguide_id, s.election_cycle, s.category, s.category_desc"""),
    "committee_received": (
        "committee STRING DEFAULT NULL, in_cycle INT DEFAULT NULL",
        "dest_cmte_id STRING, election_cycle INT, received DOUBLE, num_transactions BIGINT",
        f"""SELECT dest_cmte_id, election_cycle, sum(total_amount), sum(transaction_count) FROM fec_flows
            WHERE {_is('dest_cmte_id', 'committee')} AND {_is('election_cycle', 'in_cycle')} GROUP BY dest_cmte_id, election_cycle"""),
    "committee_given": (
        "committee STRING DEFAULT NULL, in_cycle INT DEFAULT NULL",
        "election_cycle INT, cmte_id STRING, cand_id STRING, cand_name STRING, bioguide_id STRING, contributed DOUBLE",
        f"""SELECT p.election_cycle, p.cmte_id, p.cand_id, s.cand_name, l.bioguide_id, sum(p.amount)
            FROM (SELECT election_cycle, cmte_id, cand_id, sum(total_amount) AS amount FROM fec_given
              WHERE {_is('cmte_id', 'committee')} AND {_is('election_cycle', 'in_cycle')} GROUP BY election_cycle, cmte_id, cand_id) p
            JOIN (SELECT election_cycle, cand_id, cand_name FROM fec_summaries) s ON s.election_cycle = p.election_cycle AND s.cand_id = p.cand_id
            LEFT JOIN {_LINKS} l ON l.cand_id = p.cand_id
            GROUP BY p.election_cycle, p.cmte_id, p.cand_id, s.cand_name, l.bioguide_id"""),
    "committee_search": (
        "words STRING, k INT DEFAULT 50",
        "cmte_id STRING, cmte_nm STRING, cmte_tp STRING, latest_year INT",
        r"""SELECT cmte_id, r.cmte_nm, r.cmte_tp, r.election_cycle FROM (
              SELECT *, row_number() OVER (ORDER BY r.election_cycle DESC, cmte_id) AS place FROM (
                SELECT cmte_id, max(struct(election_cycle, cmte_nm, cmte_tp)) AS r FROM fec_committees
                WHERE cmte_nm ILIKE concat('%', replace(words, '\\', '\\\\'), '%') GROUP BY cmte_id) f) p
            WHERE place <= k"""),
    "large_contributions": (
        "amount DOUBLE, in_cycle INT DEFAULT NULL",
        "election_cycle INT, cmte_name STRING, cand_name STRING, total_amount DOUBLE",
        f"""SELECT g.election_cycle, g.cmte_name, s.cand_name, g.total_amount FROM fec_given g
            JOIN (SELECT election_cycle, cand_id, cand_name FROM fec_summaries) s ON s.election_cycle = g.election_cycle AND s.cand_id = g.cand_id
            WHERE g.total_amount >= amount AND {_is('g.election_cycle', 'in_cycle')}"""),
    "individual_totals": (
        "in_cycle INT DEFAULT NULL", f"election_cycle INT, cand_id STRING, total_raised DOUBLE, {_COUNT}",
        f"""SELECT election_cycle, cand_id, sum(total_raised), sum(transaction_count) FROM fec_individual
            WHERE {_is('election_cycle', 'in_cycle')} GROUP BY election_cycle, cand_id"""),
    "monthly_trend": (
        "in_cycle INT", f"transaction_month INT, total_raised DOUBLE, {_COUNT}",
        """SELECT transaction_month, sum(total_raised), sum(transaction_count) FROM fec_individual
           WHERE election_cycle = in_cycle GROUP BY transaction_month"""),
    "served_candidates": (
        "", "cand_id STRING, election_cycle INT, cand_name STRING, bioguide_id STRING",
        f"""SELECT c.cand_id, c.election_cycle, c.cand_name, l.bioguide_id FROM fec_candidates c
            LEFT JOIN {_LINKS} l ON l.cand_id = c.cand_id WHERE l.bioguide_id IS NOT NULL"""),
    "fundraising_over_time": (
        "candidate STRING DEFAULT NULL", "cand_id STRING, election_cycle INT, ttl_receipts DOUBLE, ttl_disb DOUBLE, coh_cop DOUBLE",
        f"SELECT cand_id, election_cycle, ttl_receipts, ttl_disb, coh_cop FROM fec_summaries WHERE {_is('cand_id', 'candidate')}"),
    "funders_of_candidates": (
        "candidate STRING DEFAULT NULL", f"election_cycle INT, cand_id STRING, cmte_id STRING, total_amount DOUBLE, {_COUNT}",
        f"""SELECT election_cycle, cand_id, cmte_id, sum(total_amount), sum(transaction_count) FROM fec_given
            WHERE {_is('cand_id', 'candidate')} GROUP BY election_cycle, cand_id, cmte_id"""),
    "flow_between_committees": (
        "source STRING DEFAULT NULL", f"election_cycle INT, source_cmte_id STRING, dest_cmte_id STRING, total_amount DOUBLE, {_COUNT}",
        f"""SELECT election_cycle, source_cmte_id, dest_cmte_id, sum(total_amount), sum(transaction_count) FROM fec_flows
            WHERE {_is('source_cmte_id', 'source')} GROUP BY election_cycle, source_cmte_id, dest_cmte_id"""),
    "spend_by_state": (
        "in_cycle INT DEFAULT NULL", f"election_cycle INT, state STRING, total_amount DOUBLE, {_COUNT}",
        f"""SELECT election_cycle, state, sum(total_amount), sum(transaction_count) FROM fec_spent_by_state
            WHERE {_is('election_cycle', 'in_cycle')} GROUP BY election_cycle, state"""),
    "spend_by_category": (
        "in_cycle INT DEFAULT NULL", f"election_cycle INT, category STRING, category_desc STRING, total_amount DOUBLE, {_COUNT}",
        f"""SELECT election_cycle, category, category_desc, sum(total_amount), sum(transaction_count) FROM fec_spent_by_category
            WHERE {_is('election_cycle', 'in_cycle')} GROUP BY election_cycle, category, category_desc"""),
}


def needed(name: str) -> set[str]:
    """Stored tables a function reads."""
    body = FUNCTIONS[name][2]
    return {table for view, table in VIEWS.items() if f"fec_{view} " in body.replace("\n", " ").replace(")", " ") + " "}


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Views and functions over tables named as they are stored; returns the functions whose tables are all there."""
    spark, made = None, []
    for view, table in VIEWS.items():
        if table in tables:
            spark = tables[table].sparkSession
            tables[table].createOrReplaceTempView(f"fec_{view}")
    for name, (parameters, columns, body) in FUNCTIONS.items():
        if needed(name) <= set(tables):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
            made.append(name)
    return made


def register(spark: SparkSession, root: str) -> list[str]:
    """Functions over the finished tables of a folder.  A table stored anew is seen after another call."""
    found = {table: read_table_or_none(spark, f"{root}/{table}") for table in VIEWS.values()}
    return register_views({name: df for name, df in found.items() if df is not None})
