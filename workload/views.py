"""The given tables in campaign-finance shape.

Every view is one SQL text that both Spark and DuckDB accept, so a query and its check start
from the same rows.  ``{name}`` is a given table; a bare name is another view.  Spark reads ``txn`` from the
same column texts in another arrangement.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _cycle(date: str) -> str:
    return f"cast(year({date}) + year({date}) % 2 AS int)"


def _letters(number: str) -> str:
    return f"translate(cast({number} AS string), '0123456789', 'ABCDEFGHIJ')"


def _id(letter: str, number: str) -> str:
    return f"{letter} || lpad(cast({number} AS string), 8, '0')"


def _mdy(date: str, sep: str, pad: bool = True) -> str:
    month = f"cast(month({date}) AS string)"
    month = f"lpad({month}, 2, '0')" if pad else month
    return f"{month} || '{sep}' || lpad(cast(day({date}) AS string), 2, '0') || '{sep}' || cast(year({date}) AS string)"


# Four neighbouring customers share a family name and a state.
def _family(k: str) -> str:
    return f"cast(floor({k} / 4) AS bigint)"


def _last_name(k: str) -> str:
    g, a = _family(k), _letters(_family(k))
    return f"""CASE {g} % 6 WHEN 0 THEN 'MC' || {a} WHEN 1 THEN 'O''' || {a} WHEN 2 THEN 'DE LA ' || {a}
        WHEN 3 THEN {a} || '-JONES' WHEN 4 THEN 'VAN ' || {a} ELSE 'SMITH' || {a} END"""


def _given_name(k: str) -> str:
    return f"""CASE {k} % 7 WHEN 0 THEN 'ROBERT' WHEN 1 THEN 'BOB' WHEN 2 THEN 'RUTH A.' WHEN 3 THEN 'WILLIAM'
        WHEN 4 THEN 'BILL JR' WHEN 5 THEN '"ROB" Q' ELSE 'JAMES III' END"""


def _state(k: str) -> str:
    return f"'N' || chr(cast(65 + {_family(k)} % 25 AS int))"


def _office(k: str) -> str:
    return f"substr('HSP', cast({k} % 3 + 1 AS int), 1)"


def _cand_id(k: str) -> str:
    return _id(_office(k), k)


_CAND_NAME = f"CASE WHEN k % 97 = 0 THEN NULL ELSE {_last_name('k')} || ', ' || {_given_name('k')} END"
_P1, _P2 = "split_part(upper(p_name), ' ', 1)", "split_part(upper(p_name), ' ', 2)"

# Itemized transactions of every kind: committee to committee, committee to candidate,
# individual contributions.
_TXN = {
    "election_cycle": _cycle('l_shipdate'),
    "cmte_id": _id("'C'", 'l_suppkey'),
    "amndt_ind": "CASE WHEN l_tax = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'A' ELSE 'N' END",
    "rpt_tp": "'Q' || cast(l_linenumber % 4 + 1 AS string)",
    "transaction_pgi": "CASE WHEN l_linenumber % 2 = 0 THEN 'P' ELSE 'G' END",
    "entity_tp": "CASE WHEN l_linenumber % 2 = 0 THEN 'PAC' ELSE 'IND' END",
    "transaction_tp": "'24' || substr('AEKN', l_linenumber % 4 + 1, 1)",
    "name": f"""CASE l_partkey % 16
          WHEN 0 THEN NULL
          WHEN 1 THEN upper(p_name) || ' INC'
          WHEN 2 THEN 'MC' || {_P1} || ', ' || {_P2}
          WHEN 3 THEN 'O''' || {_P1} || ', ' || {_P2} || ' JR'
          WHEN 4 THEN 'VAN DER ' || upper(p_name)
          WHEN 5 THEN {_P1} || '-' || {_P2} || ' PAC'
          WHEN 6 THEN 'ASS''N OF THE ' || upper(p_name)
          WHEN 7 THEN {_P2} || ', ' || {_P1} || ' (' || {_P1} || ')'
          WHEN 8 THEN '  ' || {_P1} || '   ' || {_P2} || ' '
          WHEN 9 THEN p_name
          WHEN 10 THEN {_P2} || ', "' || {_P1} || '" DE LA'
          WHEN 11 THEN 'DE ' || {_P2} || ',' || {_P1} || ' III'
          ELSE upper(p_name) END""",
    "city": "'CITY ' || cast(l_suppkey % 50 AS string)",
    "state": "'N' || chr(cast(65 + l_suppkey % 25 AS int))",
    "zip_code": "lpad(cast(l_partkey % 100000 AS string), 5, '0')",
    "employer": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE upper(p_type) || ' & CO.' END",
    "occupation": f"CASE WHEN l_partkey % 5 = 0 THEN 'N/A' ELSE 'MAKER OF ' || {_P2} END",
    "transaction_dt": f"""CASE WHEN l_quantity = 13 THEN 'BADDATE'
          WHEN l_linenumber % 3 = 0 THEN {_mdy('l_shipdate', '/')}
          ELSE {_mdy('l_shipdate', '', pad=False)} END""",
    "transaction_amt": "CASE WHEN l_quantity = 7 THEN NULL ELSE cast(l_extendedprice AS decimal(14,2)) END",
    "other_id": _id("'C'", 'l_partkey % 50'),
    "cand_id": _cand_id('l_partkey % 300'),
    "tran_id": "'T' || cast(l_orderkey AS string)",
    "memo_cd": "CASE l_returnflag WHEN 'R' THEN 'X' WHEN 'N' THEN 'N' ELSE NULL END",
    "memo_text": """CASE WHEN l_linenumber = 1 THEN 'SAID "NO' ELSE NULL END""",
    "sub_id": "cast(l_orderkey * 10 + l_linenumber AS string)",
    "category": f"""CASE WHEN p_size % 13 = 0 THEN cast(p_size % 10 AS string)
          WHEN p_size % 7 = 0 THEN cast(101 + p_size % 8 AS string)
          WHEN p_size % 11 = 0 THEN NULL
          ELSE lpad(cast(p_size % 12 + 1 AS string), 3, '0') END""",
    "category_desc": "CASE WHEN p_size % 13 = 0 THEN NULL ELSE p_type END",
}

VIEWS: dict[str, str] = {
    "txn": "\n      SELECT " + ",\n        ".join(f"{e} AS {c}" for c, e in _TXN.items()) + """
      FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "committees": f"""
      SELECT election_cycle, {_id("'C'", 's_suppkey')} AS cmte_id,
        CASE s_suppkey % 5 WHEN 0 THEN 'FRIENDS OF MC' || {_letters('s_suppkey')}
          WHEN 1 THEN {_letters('s_suppkey')} || ' FOR CONGRESS'
          WHEN 2 THEN 'CITIZENS OF THE ' || {_letters('s_suppkey')} || ' PAC'
          WHEN 3 THEN {_letters('s_suppkey')} || '-JONES AFL-CIO COPE'
          ELSE 'INT''L ' || {_letters('s_suppkey')} || ' LLC' END AS cmte_nm,
        'O''' || {_letters('s_suppkey')} || ', PAT' AS tres_nm,
        CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE upper(s_name) END AS connected_org_nm,
        substr('PPAUJD', cast(s_suppkey % 6 + 1 AS int), 1) AS cmte_dsgn,
        substr('HSPNQO', cast(s_suppkey % 6 + 1 AS int), 1) AS cmte_tp,
        CASE WHEN s_suppkey % 18 = 1 THEN '' WHEN s_suppkey % 18 = 2 THEN NULL
          ELSE {_cand_id('(s_suppkey + extra)')} END AS cand_id
      FROM (
        SELECT c.election_cycle, s.*, 0 AS extra
        FROM (SELECT DISTINCT l_suppkey, {_cycle('l_shipdate')} AS election_cycle FROM {{lineitem}}) c
        JOIN {{supplier}} s ON s_suppkey = l_suppkey
        UNION ALL
        SELECT c.election_cycle, s.*, 3 AS extra
        FROM (SELECT DISTINCT l_suppkey, {_cycle('l_shipdate')} AS election_cycle FROM {{lineitem}}) c
        JOIN {{supplier}} s ON s_suppkey = l_suppkey WHERE s_suppkey % 12 = 0
      ) r WHERE (s_suppkey + election_cycle / 2) % 11 <> 0""",
    "candidates": f"""
      SELECT election_cycle, {_cand_id('k')} AS cand_id, {_CAND_NAME} AS cand_name,
        CASE c_nationkey % 5 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' WHEN 2 THEN 'IND' WHEN 3 THEN 'LIB'
          ELSE NULL END AS cand_pty_affiliation,
        election_cycle AS cand_election_yr,
        {_state('k')} AS cand_office_st, {_office('k')} AS cand_office,
        substr('ICO', cast(k % 3 + 1 AS int), 1) AS cand_ici
      FROM (SELECT DISTINCT o_custkey AS k, {_cycle('o_orderdate')} AS election_cycle FROM {{orders}}) o
      JOIN {{customer}} ON c_custkey = k""",
    "summaries": f"""
      SELECT election_cycle, {_cand_id('k')} AS cand_id, {_CAND_NAME} AS cand_name,
        substr('ICO', cast(k % 3 + 1 AS int), 1) AS cand_ici,
        cast(total AS decimal(14,2)) AS ttl_receipts, cast(filled AS decimal(14,2)) AS ttl_disb,
        CASE WHEN k % 4 = 0 THEN NULL ELSE cast(urgent AS decimal(14,2)) END AS trans_from_auth,
        cast(low AS decimal(14,2)) AS trans_to_auth, cast(total AS decimal(14,2)) AS coh_cop,
        cast(open AS decimal(14,2)) AS ttl_indiv_contrib, cast(urgent AS decimal(14,2)) AS other_pol_cmte_contrib,
        cast(low AS decimal(14,2)) AS pol_pty_contrib,
        CASE WHEN k % 10 = 0 THEN NULL ELSE cast(open AS decimal(14,2)) END AS cand_contrib,
        cast(filled AS decimal(14,2)) AS cand_loans,
        CASE WHEN k % 11 = 0 THEN 'N/A' WHEN k % 3 = 0 THEN {_mdy('latest', '/')}
          ELSE {_mdy('latest', '')} END AS cvg_end_dt
      FROM (
        SELECT o_custkey AS k, {_cycle('o_orderdate')} AS election_cycle, max(o_orderdate) AS latest,
          sum(cast(o_totalprice AS decimal(14,2))) AS total,
          sum(CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice AS decimal(14,2)) ELSE 0 END) AS filled,
          sum(CASE WHEN o_orderstatus = 'O' THEN cast(o_totalprice AS decimal(14,2)) ELSE 0 END) AS open,
          sum(CASE WHEN o_orderpriority = '1-URGENT' THEN cast(o_totalprice AS decimal(14,2)) ELSE 0 END) AS urgent,
          sum(CASE WHEN o_orderpriority = '5-LOW' THEN cast(o_totalprice AS decimal(14,2)) ELSE 0 END) AS low
        FROM {{orders}} GROUP BY o_custkey, {_cycle('o_orderdate')}
      ) s""",
    "members": f"""
      SELECT c_custkey AS k, chr(cast(65 + c_custkey % 26 AS int)) || lpad(cast(c_custkey AS string), 9, '0') AS bioguide_id,
        CASE {_family('c_custkey')} % 5 WHEN 0 THEN 'Robert' WHEN 1 THEN 'William' WHEN 2 THEN 'James'
          WHEN 3 THEN 'Ruth' ELSE 'Bob' END AS first_name,
        {_last_name('c_custkey')} AS last_name,
        CASE {_family('c_custkey')} % 7 WHEN 0 THEN 'Jr' WHEN 1 THEN 'Jr.' WHEN 2 THEN 'III' ELSE NULL END AS suffix,
        CASE c_custkey % 8 WHEN 0 THEN 'Bob' WHEN 4 THEN 'Jim' ELSE NULL END AS nickname,
        CASE c_nationkey % 6 WHEN 0 THEN 'Democrat' WHEN 1 THEN 'Republican' WHEN 2 THEN 'Independent'
          WHEN 3 THEN 'Libertarian' WHEN 4 THEN 'Whig' ELSE NULL END AS party,
        {_state('c_custkey')} AS state,
        CASE c_custkey % 3 WHEN 1 THEN 'sen' ELSE 'rep' END AS term_type
      FROM {{customer}}
      WHERE c_custkey % 4 = 0 OR (c_custkey % 4 = 1 AND {_family('c_custkey')} % 3 = 0)""",
    "member_terms": """
      SELECT k, bioguide_id, term_type, state, party, cast(y AS string) || '-01-03' AS term_start,
        CASE WHEN y % 5 = 0 THEN NULL WHEN term_type = 'sen' THEN cast(y + 6 AS string) || '-01-03'
          ELSE cast(y + 2 AS string) || '-01-03' END AS term_end
      FROM (
        SELECT DISTINCT m.k, bioguide_id, term_type, state, party,
          year(o_orderdate) - CASE WHEN m.k % 17 = 0 THEN 60 ELSE 0 END AS y
        FROM members m JOIN {orders} ON o_custkey = m.k
      ) t""",
    "member_ids": f"""
      SELECT k, bioguide_id, {_cand_id('k')} AS cand_id FROM members WHERE k % 5 < 3
      UNION ALL SELECT k, bioguide_id, {_id("'X'", 'k')} AS cand_id FROM members WHERE k % 5 = 0
      UNION ALL SELECT k, bioguide_id, {_cand_id('(k + 2)')} AS cand_id FROM members WHERE k % 5 = 1""",
    "manifest_new": f"""
      SELECT o_orderpriority AS dataset, {_cycle('o_orderdate')} AS cycle,
        CASE WHEN year(min(o_orderdate)) % 4 = 1 THEN NULL ELSE 'e' || cast(max(o_orderkey) AS string) END AS etag,
        CASE WHEN count(*) % 3 = 0 THEN NULL ELSE cast(max(o_custkey) AS string) END AS last_modified,
        count(*) AS content_length
      FROM {{orders}} GROUP BY o_orderpriority, {_cycle('o_orderdate')}""",
    "manifest_old": f"""
      SELECT o_orderpriority AS dataset, {_cycle('o_orderdate')} AS cycle,
        CASE WHEN count(*) % 5 = 0 THEN NULL ELSE 'e' || cast(max(o_orderkey) AS string) END AS etag,
        cast(max(o_custkey) AS string) AS last_modified,
        count(*) AS content_length,
        CASE WHEN count(*) % 7 = 0 THEN NULL ELSE cast(max(year(o_orderdate)) AS string) || '-12-31T00:00:00' END AS last_updated
      FROM {{orders}} WHERE o_orderstatus <> 'P' AND NOT (o_orderpriority = '1-URGENT' AND year(o_orderdate) > 2000)
      GROUP BY o_orderpriority, {_cycle('o_orderdate')}""",
}

_NAMES = re.compile(r"\b(" + "|".join(VIEWS) + r")\b")


def _needed(sql: str) -> list[str]:
    """Views a text uses, each after those it depends on."""
    out: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name not in out:
                visit(VIEWS[name])
                if name not in out:
                    out.append(name)

    visit(sql)
    return out


def with_views(body: str, tables: dict[str, str], ctes: str = "") -> str:
    """``body`` preceded by the views it uses; ``ctes`` are further definitions in between."""
    used = [f"{n} AS ({VIEWS[n].format(**tables)})" for n in _needed(ctes + " " + body)]
    parts = used + ([ctes] if ctes else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def duckdb_sql(body: str, ctes: str = "") -> str:
    return with_views(body, {t: t for t in TABLES}, ctes)


# Columns of `txn` that cut words out of a part's name.
_PER_PART = ("name", "occupation")


def _txn_by_part() -> str:
    """`txn`, its words cut once a part instead of once a line.  Besides the work this keeps the code of the join below the size
    (8,000 bytes a method) beyond which the JVM does not compile it."""
    cut = ", ".join(f"{_TXN[c].replace('l_partkey', 'p_partkey')} AS {c}" for c in _PER_PART)
    columns = ", ".join(c if c in _PER_PART else f"{e} AS {c}" for c, e in _TXN.items())
    return f"SELECT {columns} FROM {{lineitem}} JOIN (SELECT p_partkey, p_type, p_size, {cut} FROM {{part}}) ON l_partkey = p_partkey"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    if name == "txn":
        return spark.sql(_txn_by_part().format(**tables))
    return spark.sql(with_views(f"SELECT * FROM {name}", tables))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
