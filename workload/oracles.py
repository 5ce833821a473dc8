"""DuckDB checks for the registered queries, written independently of the Spark code."""

from __future__ import annotations

from .views import duckdb_sql

OPEN_CYCLE = 2002

# Code tables and nicknames, written here so that an error in the library's shows.
COMMITTEE_TYPES = {
    "C": "Communication cost", "D": "Delegate committee", "E": "Electioneering communication", "H": "House campaign",
    "I": "Independent expenditor (person or group)", "N": "PAC - Nonqualified",
    "O": "Independent expenditure-only (Super PACs)", "P": "Presidential campaign", "Q": "PAC - Qualified",
    "S": "Senate campaign", "U": "Single candidate independent expenditure", "V": "PAC with non-contribution account",
    "W": "PAC with non-contribution account - Nonqualified", "X": "Party - Nonqualified", "Y": "Party - Qualified",
    "Z": "National party nonfederal account",
}
DESIGNATIONS = {
    "A": "Authorized by a candidate", "B": "Lobbyist/Registrant PAC", "D": "Leadership PAC", "J": "Joint fundraiser",
    "P": "Principal campaign committee", "U": "Unauthorized",
}
TRANSACTION_TYPES = {
    "24A": "Independent expenditure AGAINST candidate", "24E": "Independent expenditure FOR candidate",
    "24K": "Direct contribution to candidate", "24N": "Communication cost FOR candidate",
}
CATEGORIES = {
    "001": "Administrative/Salary/Overhead Expenses", "002": "Travel Expenses",
    "003": "Solicitation and Fundraising Expenses", "004": "Advertising Expenses", "005": "Polling Expenses",
    "006": "Campaign Materials", "007": "Campaign Event Expenses", "008": "Transfers", "009": "Loan Repayments",
    "010": "Refunds of Contributions", "011": "Political Contributions", "012": "Donations",
    "101": "Non-Allocable Expenses", "102": "Media Expenditures", "103": "Mass Mailings and Campaign Materials",
    "104": "State Office Overhead Expenses", "105": "Special Telephone Program Expenditures",
    "106": "Public Opinion Poll Expenditures", "107": "Fundraising Expenditures",
}
PARTIES = {
    "DEM": "Democratic Party", "REP": "Republican Party", "IND": "Independent", "LIB": "Libertarian Party",
    "GRE": "Green Party", "CON": "Constitution Party", "REF": "Reform Party",
}
INCUMBENCY = {
    "I": "Incumbent", "C": "Challenger", "O": "Open Seat",
}
OFFICES = {
    "H": "House", "S": "Senate", "P": "President",
}
STATUSES = {
    "C": "Current", "P": "Prior", "F": "Future",
}
PARTY_CODES = {
    "Democrat": "DEM", "Democratic": "DEM", "Republican": "REP", "Independent": "IND", "Libertarian": "LIB",
    "Green": "GRE", "Liberal": "LIB", "Reform": "REF", "Conservative": "CON", "Democrat-Farmer-Labor": "DFL",
    "Farmer-Labor": "DFL",
}
NICKNAMES = {
    "bob": "robert", "bobby": "robert", "rob": "robert", "bill": "william", "billy": "william", "will": "william",
    "jim": "james", "jimmy": "james", "jamie": "james", "mike": "michael", "mick": "michael", "dick": "richard",
    "rick": "richard", "rich": "richard", "ted": "theodore", "teddy": "theodore", "tom": "thomas", "tommy": "thomas",
    "joe": "joseph", "joey": "joseph", "dan": "daniel", "danny": "daniel", "dave": "david", "davy": "david",
    "tony": "antonio", "al": "alan", "ed": "edward", "eddy": "edward", "eddie": "edward", "ned": "edward",
    "sam": "samuel", "sammy": "samuel", "charlie": "charles", "chuck": "charles", "chas": "charles",
    "ben": "benjamin", "benny": "benjamin", "jack": "john", "johnny": "john", "jon": "john", "steve": "stephen",
    "steven": "stephen", "pat": "patrick", "patty": "patricia", "chris": "christopher", "kit": "christopher",
    "matt": "matthew", "andy": "andrew", "drew": "andrew", "nick": "nicholas", "nicky": "nicholas", "pete": "peter",
    "jerry": "jerome", "gerry": "gerald", "larry": "lawrence", "lawrie": "lawrence", "harry": "harold",
    "hal": "harold", "hank": "henry", "liz": "elizabeth", "lizzy": "elizabeth", "beth": "elizabeth",
    "betty": "elizabeth", "betsy": "elizabeth", "kate": "katherine", "kathy": "katherine", "katie": "katherine",
    "cathy": "catherine", "maggie": "margaret", "peggy": "margaret", "meg": "margaret", "margie": "margaret",
    "sue": "susan", "suzy": "susan", "debbie": "deborah", "deb": "deborah", "barb": "barbara", "barbie": "barbara",
    "jenny": "jennifer", "jen": "jennifer", "cindy": "cynthia", "sandy": "alexander", "mandy": "amanda",
    "becky": "rebecca", "vicky": "victoria", "tina": "christina", "nancy": "ann", "sally": "sarah", "phil": "philip",
    "don": "donald", "donny": "donald", "ron": "ronald", "ronny": "ronald", "ray": "raymond", "ken": "kenneth",
    "kenny": "kenneth", "greg": "gregory", "gregg": "gregory", "walt": "walter", "wally": "walter",
    "fred": "frederick", "freddy": "frederick", "gene": "eugene", "lenny": "leonard", "len": "leonard",
    "leo": "leonard", "norm": "norman", "bernie": "bernard", "ernie": "ernest", "arnie": "arnold", "abe": "abraham",
    "max": "maximilian", "doug": "douglas", "cliff": "clifford", "tim": "timothy", "timmy": "timothy",
    "bart": "bartholomew", "zach": "zachary", "zack": "zachary", "alex": "alexander", "jeff": "jeffrey",
    "geoffrey": "jeffrey", "geoff": "geoffrey", "josh": "joshua", "nate": "nathaniel", "nathan": "nathaniel",
    "nat": "nathaniel", "cy": "cyrus", "ike": "isaac", "izzy": "isidore", "manny": "emmanuel", "mort": "morton",
    "sy": "seymour", "si": "simon", "vinny": "vincent", "vic": "victor", "vince": "vincent", "wes": "wesley",
    "frank": "francis", "frankie": "francis", "fran": "frances", "frannie": "frances",
}


def _sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _sql_map(table: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


# ---------------------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------------------


def _let(value: str, var: str, body: str) -> str:
    """Bind ``value`` to ``var`` inside ``body``."""
    return f"list_transform([{value}], lambda {var}: {body})[1]"


def _title(c: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda run: upper(run[1]) || lower(substr(run, 2))), '')")


_UPPER = _sql_list([
    "AFL-CIO", "AFL", "CIO", "PAC", "USA", "US", "IBEW", "UAW", "SEIU", "NEA", "AFT", "UFCW", "AFSCME", "LIUNA", "IATSE",
    "IUOE", "SMART", "UWUA", "CWA", "APWU", "NALC", "NFFE", "NTEU", "PBA", "FOP", "IAFF", "BCTGM", "USW", "OPEIU", "UFWA",
    "DNC", "RNC", "GOP", "LLC", "INC", "LTD", "CO", "CORP", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X",
])
_SMALL = _sql_list(["DE", "LA", "DEL", "VAN", "VON", "DEN", "DER", "LE", "DA", "DI", "DU", "OF", "THE"])


def _word(w: str, first: str, depth: int = 0) -> str:
    c, lead, trail = f"core{depth}", f"regexp_extract({w}, '^[^A-Za-z0-9]*')", f"regexp_extract({w}, '[^A-Za-z0-9]*$')"
    core = f"regexp_replace({w}, '^[^A-Za-z0-9]+|[^A-Za-z0-9]+$', '', 'g')"
    pieces = _title(c)
    if depth == 0:
        part = _word("piece", f"({first} AND j = 1)", 1)
        pieces = (f"CASE WHEN contains({c}, '-') THEN array_to_string(list_transform(string_split({c}, '-'), "
                  f"lambda piece, j: {part}), '-') ELSE {_title(c)} END")
    body = f"""CASE WHEN {c} = '' THEN {w} ELSE {lead} || CASE
        WHEN upper({c}) = 'INT''L' THEN 'Int''l' WHEN upper({c}) = 'ASS''N' THEN 'Ass''n'
        WHEN upper({c}) IN {_UPPER} THEN upper({c})
        WHEN NOT {first} AND upper({c}) IN {_SMALL} THEN lower({c})
        WHEN upper({c}) LIKE 'O''_%' THEN 'O''' || {_title(f"substr({c}, 3)")}
        WHEN upper({c}) LIKE 'MC_%' THEN 'Mc' || {_title(f"substr({c}, 3)")}
        ELSE {pieces} END || {trail} END"""
    return _let(core, c, body)


def cap(x: str) -> str:
    part = lambda t, first: (
        f"array_to_string(list_transform(string_split_regex(trim({t}), '\\s+'), "
        f"lambda w, i: {_word('w', '(i = 1)' if first else 'false')}), ' ')")
    comma = f"instr({x}, ',')"
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN trim({x}) = '' THEN ''
      WHEN {comma} > 0 THEN rtrim({part(f"substr({x}, 1, {comma} - 1)", True)} || ', '
        || {part(f"substr({x}, {comma} + 1)", False)}, ', ')
      ELSE {part(x, True)} END"""


def _date_part(x: str, slash: int, eight: tuple[int, int], seven: tuple[int, int]) -> str:
    return f"""CASE WHEN contains({x}, '/') THEN try_cast(split_part({x}, '/', {slash}) AS int)
      WHEN length({x}) = 8 THEN try_cast(substr({x}, {eight[0]}, {eight[1]}) AS int)
      WHEN length({x}) = 7 THEN try_cast(substr({x}, {seven[0]}, {seven[1]}) AS int) END"""


def year(x: str) -> str:
    return _date_part(x, 3, (5, 4), (4, 4))


def month(x: str) -> str:
    return _date_part(x, 1, (1, 2), (1, 1))


def iso(x: str) -> str:
    y, m, d = year(x), month(x), _date_part(x, 2, (3, 2), (2, 2))
    text = f"lpad(({y})::varchar, 4, '0') || '-' || lpad(({m})::varchar, 2, '0') || '-' || lpad(({d})::varchar, 2, '0')"
    return (f"CASE WHEN ({m}) BETWEEN 1 AND 12 AND ({d}) BETWEEN 1 AND 31 AND ({y}) BETWEEN 1900 AND 2100 "
            f"THEN {text} END")


# ---------------------------------------------------------------------------------------
# Shared steps
# ---------------------------------------------------------------------------------------


def counted(columns: str, order: str) -> str:
    """Transactions that count once."""
    return f"""SELECT election_cycle, {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY election_cycle, sub_id ORDER BY {order}) AS pick
        FROM txn WHERE coalesce(memo_cd, '') <> 'X' AND coalesce(amndt_ind, 'N') = 'N') q WHERE pick = 1"""


def _nulls_first(columns: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def rolled(name: str, keys: dict[str, str], capitalised: str | None = None, order: list[str] | None = None) -> str:
    """CTE for a roll-up: output key -> raw column."""
    raw = [*keys.values(), "transaction_dt", "transaction_amt"]
    out = ", ".join((f"{cap(src)}" if dst == capitalised else src) + f" AS {dst}" for dst, src in keys.items())
    names = ", ".join(keys)
    return f"""{name} AS (
      SELECT election_cycle, transaction_year, {names},
        coalesce(sum(transaction_amt), 0) AS total_amount, count(*) AS transaction_count
      FROM (SELECT election_cycle, {year('transaction_dt')} AS transaction_year, {out}, transaction_amt
        FROM ({counted(', '.join(raw), _nulls_first(order or raw))}) k) r
      GROUP BY ALL)"""


OTH = rolled("oth", {"source_cmte_id": "cmte_id", "dest_cmte_id": "other_id", "dest_name": "name",
                     "transaction_tp": "transaction_tp"}, "dest_name")
PAS2 = rolled("pas2", {"cmte_id": "cmte_id", "cmte_name": "name", "cand_id": "cand_id",
                       "transaction_tp": "transaction_tp"}, "cmte_name")
# Of rows with one id both roll-ups of the expenditure files keep the same.
SPENDING_ORDER = ["cmte_id", "category", "category_desc", "transaction_dt", "transaction_amt", "state"]
CATEGORY = rolled("by_category", {"cmte_id": "cmte_id", "category": "category", "category_desc": "category_desc"},
                  order=SPENDING_ORDER)
STATE = rolled("by_state", {"cmte_id": "cmte_id", "state": "state"}, order=SPENDING_ORDER)

BOTH_SPENDING = """SELECT election_cycle, transaction_year, cmte_id, category, category_desc, NULL::varchar AS state,
    CAST(total_amount AS DOUBLE) AS total_amount, transaction_count{more} FROM by_category{join}
  UNION ALL SELECT election_cycle, transaction_year, cmte_id, NULL, NULL, state,
    CAST(total_amount AS DOUBLE), transaction_count{more} FROM by_state{join}"""

LINKS = """links AS (
  SELECT DISTINCT cand_id, bioguide_id FROM member_ids WHERE cand_id IN (SELECT cand_id FROM candidates))"""

_INDIVIDUAL_RAW = ["cmte_id", "transaction_dt", "transaction_amt"]
INDIVIDUAL = f"""{LINKS}, individual AS (
  SELECT t.*, bioguide_id FROM (
    SELECT election_cycle, transaction_year, transaction_month, cand_id,
      coalesce(sum(transaction_amt), 0) AS total_raised, count(*) AS transaction_count
    FROM (SELECT k.election_cycle, {year('transaction_dt')} AS transaction_year,
        CASE WHEN k.election_cycle = {OPEN_CYCLE} THEN {month('transaction_dt')} END AS transaction_month,
        cand_id, transaction_amt
      FROM ({counted(', '.join(_INDIVIDUAL_RAW), _nulls_first(_INDIVIDUAL_RAW))}) k
      JOIN (SELECT DISTINCT election_cycle, cmte_id, cand_id FROM committees
        WHERE cmte_tp IN ('H', 'S', 'P') AND cand_id <> '') c
        ON c.election_cycle = k.election_cycle AND c.cmte_id = k.cmte_id) j
    GROUP BY ALL) t LEFT JOIN links USING (cand_id))"""

SUMS = "CAST(sum(total_amount) AS DOUBLE) AS total_amount, CAST(sum(transaction_count) AS BIGINT) AS transaction_count"


def whole(rows: str, keys: str) -> str:
    return (f"SELECT election_cycle, transaction_year, {keys}, CAST(total_amount AS DOUBLE) AS total_amount, "
            f"transaction_count FROM {rows}")


# Landed lines with their faults.
SPOILT = """SELECT *, CASE WHEN n % 9 = 0 AND transaction_amt IS NOT NULL THEN CAST(transaction_amt AS VARCHAR) || 'x'
    ELSE coalesce(CAST(transaction_amt AS VARCHAR), '') END AS amount,
  concat_ws(', ', CASE n % 5 WHEN 3 THEN 'too few fields' WHEN 4 THEN 'too many fields' END,
    CASE WHEN n % 9 = 0 AND transaction_amt IS NOT NULL THEN 'unreadable transaction_amt' END) AS reason
  FROM (SELECT *, CAST(substr(tran_id, 2) AS BIGINT) AS n FROM txn) t"""

# Reporting tables: the rows behind each, and the text of every column.
_TWO = "CAST({} AS DECIMAL(30,2))"
_NOTHING = "NULL"
_SUM_CELLS = [_TWO.format("total_amount"), "transaction_count"]
_PERIOD_CELLS = ["election_cycle", "transaction_year"]
REPORT_ROWS = {
    "fec_candidate_mapping": ("links", ["bioguide_id", "cand_id"]),
    "fec_candidate_summaries": ("summaries", [
        "cand_id", "election_cycle", "cand_name", "cand_ici", _NOTHING, *[_TWO.format(c) for c in (
            "ttl_receipts", "ttl_disb", "coh_cop", "ttl_indiv_contrib", "other_pol_cmte_contrib", "pol_pty_contrib", "cand_contrib", "cand_loans")],
        _NOTHING, _TWO.format("trans_from_auth"), _TWO.format("trans_to_auth"), "cvg_end_dt"]),
    "fec_committees": ("committees", [
        "cmte_id", "election_cycle", "cmte_nm", "cmte_tp", "cmte_dsgn", _NOTHING, "connected_org_nm", "cand_id"]),
    "fec_pac_summaries": (
        "(SELECT cmte_id, election_cycle, max(cmte_nm) AS cmte_nm, max(cmte_tp) AS cmte_tp FROM committees "
        "WHERE cmte_tp IN ('N', 'Q', 'O') GROUP BY ALL) p", ["cmte_id", "election_cycle", "cmte_nm", "cmte_tp", *[_NOTHING] * 7]),
    "fec_committee_to_candidate": ("pas2", [*_PERIOD_CELLS, "cmte_id", "cmte_name", "cand_id", "transaction_tp", *_SUM_CELLS]),
    "fec_committee_transactions": ("oth", [*_PERIOD_CELLS, "source_cmte_id", "dest_cmte_id", "dest_name", "transaction_tp", *_SUM_CELLS]),
    "fec_expenditures_by_category": ("by_category", [*_PERIOD_CELLS, "cmte_id", "category", "category_desc", *_SUM_CELLS]),
    "fec_expenditures_by_state": ("by_state", [*_PERIOD_CELLS, "cmte_id", "state", *_SUM_CELLS]),
}

# Name parsing and scoring --------------------------------------------------------------

_BASE = r"regexp_replace(trim(cand_name), '(?i)(\s+|,\s*)(jr\.?|sr\.?|ii|iii|iv|v|2nd|3rd|4th)$', '')"
_SUFFIX = r"rtrim(lower(regexp_extract(trim(cand_name), '(?i)(\s+|,\s*)(jr\.?|sr\.?|ii|iii|iv|v|2nd|3rd|4th)$', 2)), '.')"
# Every candidate name of the given tables has the form LAST, FIRST.
PARSED = f"""parsed AS (
  SELECT *, coalesce(lower(trim(split_part(base, ',', 1))), '') AS p_last,
    coalesce(lower(replace(split_part(trim(split_part(base, ',', 2)), ' ', 1), '"', '')), '') AS p_first
  FROM (SELECT *, {_BASE} AS base, coalesce({_SUFFIX}, '') AS p_suffix FROM candidates) b)"""


def _formal(x: str) -> str:
    return f"coalesce({_sql_map(NICKNAMES, x)}, {x})"


def score(first: str, last: str, suffix: str) -> str:
    f, s = f"lower(coalesce({first}, ''))", f"lower(coalesce({suffix}, ''))"
    drop = f"CASE WHEN {s} = '' OR {s} = p_suffix THEN 0 ELSE 1 END"
    return f"""CAST(CASE WHEN p_last <> lower({last}) THEN 0
      WHEN p_first = {f} THEN CASE {drop} WHEN 0 THEN 1.0 ELSE 0.9 END
      WHEN {_formal('p_first')} = {_formal(f)} OR {_formal('p_first')} = {f} OR p_first = {_formal(f)}
        THEN CASE {drop} WHEN 0 THEN 0.95 ELSE 0.85 END
      WHEN p_first <> '' AND {f} <> '' AND p_first[1] = {f}[1] THEN 0.7
      ELSE 0 END AS DOUBLE)"""


CAMPAIGNS = """campaigns AS (
  SELECT bioguide_id, term_type, party, state, term_start, unnest(CASE WHEN term_type = 'rep'
      THEN range(s - s % 2, e + 1, 2)
      ELSE list_distinct([s - s % 2, e - e % 2]) END) AS cycle
  FROM (SELECT *, CAST(substr(term_start, 1, 4) AS int) AS s,
    coalesce(CAST(substr(term_end, 1, 4) AS int), CAST(substr(term_start, 1, 4) AS int) + 2) AS e FROM member_terms) t)"""

MATCHES = f"""{PARSED}, {CAMPAIGNS}, met AS (
  SELECT cand_id, bioguide_id, {_sql_map(PARTY_CODES, 'c.party')} AS term_party, cand_pty_affiliation AS cand_party,
    {score('first_name', 'last_name', 'suffix')} AS formal,
    CASE WHEN nickname IS NULL THEN 0 ELSE {score('nickname', 'last_name', 'suffix')} END AS nick
  FROM (SELECT * FROM members WHERE k NOT IN (SELECT k FROM member_ids)) m
  JOIN campaigns c USING (bioguide_id)
  JOIN parsed p ON p.cand_office_st = c.state AND p.cand_office = CASE c.term_type WHEN 'rep' THEN 'H' ELSE 'S' END
    AND p.election_cycle = c.cycle AND cand_name IS NOT NULL
  WHERE c.cycle BETWEEN 1980 AND 2026
), matches AS (
  SELECT cand_id, bioguide_id, max(CASE WHEN term_party IS NULL OR cand_party IS NULL THEN s
      WHEN term_party = cand_party THEN least(1.0::DOUBLE, s + 0.1::DOUBLE)
      ELSE greatest(0.5::DOUBLE, s - 0.2::DOUBLE) END) AS score
  FROM (SELECT *, CASE WHEN formal > 0 THEN formal ELSE nick END AS s FROM met) x WHERE s > 0 GROUP BY ALL)"""
BAND = "CASE WHEN score >= 0.95::DOUBLE THEN 'high' WHEN score >= 0.8::DOUBLE THEN 'medium' ELSE 'low' END"

CROSSWALK = f"""{LINKS}, {MATCHES}, crosswalk AS (
  SELECT cand_id, bioguide_id, 'authoritative' AS match_method, 'high' AS confidence FROM links
  UNION ALL
  SELECT cand_id, bioguide_id, 'name_match', {BAND} FROM matches
  WHERE cand_id NOT IN (SELECT cand_id FROM links)
    AND cand_id IN (SELECT cand_id FROM matches GROUP BY cand_id HAVING count(DISTINCT bioguide_id) = 1))"""

# An upper name without marks; JR-like second words skip to the next one.
_KEY_LAST = "regexp_replace(trim(split_part(cand_name, ',', 1)), '[.'']', '', 'g')"
_KEY_FIRST = "regexp_replace(split_part(trim(split_part(cand_name, ',', 2)), ' ', 1), '[.'']', '', 'g')"
KEY = f"CASE WHEN cand_name IS NULL THEN '' ELSE {_KEY_LAST} || ', ' || {_KEY_FIRST} END"

_PROFILE = """SELECT '{name}' AS table_name, count(*) AS row_count, CAST({columns} AS int) AS column_count,
    {has} AS has_election_cycle, CAST({nulls} AS BIGINT) AS null_election_cycle,
    CAST(CASE WHEN {nulls} = 0 THEN min({cycle}) END AS int) AS min_cycle, CAST(max({cycle}) AS int) AS max_cycle"""


def _profile(name: str, rows: str, columns: int, cycle: str | None = "election_cycle") -> str:
    has, nulls = ("true", f"count(*) FILTER (WHERE {cycle} IS NULL)") if cycle else ("false", "0")
    return _PROFILE.format(name=name, columns=columns, has=has, nulls=nulls, cycle=cycle or "NULL") + f" FROM {rows}"


_LATE = "(SELECT *, CASE WHEN cand_ici = 'I' THEN election_cycle END AS late FROM summaries) l"
REPORT = f"""profiles AS (
  {_profile('by_state', 'by_state', 6)}
  UNION ALL {_profile('candidates', 'candidates', 8)}
  UNION ALL {_profile('summaries', _LATE, 15, 'late')}
  UNION ALL {_profile('members', 'members', 9, None)}
  UNION ALL SELECT 'absent', 0, 0, false, 0, NULL, NULL
  UNION ALL {_profile('none_left', "candidates WHERE cand_id = 'nobody'", 8)}
), issue_rows AS (
  SELECT table_name, 'Missing election_cycle column' AS issue FROM profiles
    WHERE NOT has_election_cycle AND table_name <> 'absent'
  UNION ALL SELECT table_name, format('{{:,}}', null_election_cycle) || ' null election_cycle values' FROM profiles
    WHERE null_election_cycle > 0
  UNION ALL SELECT table_name, 'File is empty' FROM profiles WHERE row_count = 0 AND table_name <> 'absent'
  UNION ALL SELECT table_name, 'File not found' FROM profiles WHERE table_name = 'absent')"""

_DIFF = lambda c, unknown: (f"(n.{c} IS NOT NULL AND o.{c} IS NOT NULL AND n.{c} <> {unknown} AND o.{c} <> {unknown} "  # noqa: E731
                            f"AND n.{c} <> o.{c})")

ORACLES: dict[str, str] = {
    # scans, sinks, loads
    "scan_pipe": duckdb_sql("""SELECT election_cycle, cmte_id, amndt_ind, transaction_tp, name, transaction_dt,
        CAST(transaction_amt AS DOUBLE) AS transaction_amt, memo_cd, memo_text, sub_id FROM txn"""),
    "cycle_from_path": duckdb_sql("SELECT election_cycle, count(*) AS row_count FROM txn GROUP BY ALL"),
    "scan_csv_projected": duckdb_sql(
        "SELECT cmte_id, name, memo_text, CAST(transaction_amt AS DOUBLE) AS transaction_amt FROM txn"),
    "snake_case_headers": duckdb_sql("SELECT cmte_id, transaction_dt, sub_id FROM txn"),
    "legislators_scan": duckdb_sql("""SELECT bioguide_id, last_name,
        (SELECT count(*) FROM member_ids i WHERE i.k = m.k) AS ids,
        (SELECT count(*) FROM member_terms t WHERE t.k = m.k) AS terms,
        (SELECT max(term_start) FROM member_terms t WHERE t.k = m.k) AS latest_start, first_name, nickname,
        coalesce((SELECT string_agg(cand_id, ',' ORDER BY cand_id) FROM member_ids i WHERE i.k = m.k), '') AS id_list,
        coalesce((SELECT string_agg(term_start || '/' || coalesce(term_end, '') || '/' || term_type || '/' || state || '/'
            || coalesce(party, ''), ',' ORDER BY term_start DESC) FROM member_terms t WHERE t.k = m.k), '') AS term_list
        FROM members m"""),
    "table_sink": duckdb_sql(whole("pas2", "cmte_id, cmte_name, cand_id, transaction_tp"), PAS2),
    "partitioned_sink": duckdb_sql(f"""SELECT election_cycle, cmte_id, {cap('name')} AS name,
        {cap('employer')} AS employer, {cap('occupation')} AS occupation,
        CAST(transaction_amt AS DOUBLE) AS transaction_amt, sub_id FROM txn"""),
    "replace_cycle": duckdb_sql(
        whole("(SELECT * FROM by_state WHERE election_cycle <> 2000 UNION ALL SELECT * FROM later) u", "cmte_id, state"),
        STATE + ", " + rolled("later", {"cmte_id": "cmte_id", "state": "state"}, order=SPENDING_ORDER).replace(
            "FROM txn WHERE", "FROM txn WHERE election_cycle = 2000 AND transaction_tp = '24K' AND")),
    "expenditures_two_rollups": duckdb_sql(
        """SELECT 'category' AS kind, election_cycle, transaction_year, cmte_id, category, category_desc,
          NULL::varchar AS state, CAST(total_amount AS DOUBLE) AS total_amount, transaction_count FROM by_category
        UNION ALL SELECT 'state', election_cycle, transaction_year, cmte_id, NULL, NULL, state,
          CAST(total_amount AS DOUBLE), transaction_count FROM by_state""",
        f"{CATEGORY}, {STATE}"),
    "typed_table_load": duckdb_sql(
        """SELECT election_cycle, transaction_year, cmte_id, cmte_name, cand_id, transaction_tp,
          CAST(total_amount AS DOUBLE) AS total_amount, CAST(transaction_count AS BIGINT) AS transaction_count
        FROM pas2 WHERE election_cycle >= 1998""", PAS2),
    "report_tables_load": duckdb_sql("""SELECT 'fec_candidate_summaries' AS table_name, count(*) AS row_count,
          CAST(sum(ttl_receipts) AS DOUBLE) AS total FROM summaries
        UNION ALL SELECT 'fec_committees', count(*), NULL FROM committees
        UNION ALL SELECT 'fec_candidate_mapping', count(*), NULL FROM links
        UNION ALL SELECT 'fec_pac_summaries', count(DISTINCT (election_cycle, cmte_id)), NULL FROM committees WHERE cmte_tp IN ('N', 'Q', 'O')
        UNION ALL SELECT 'fec_committee_to_candidate', count(*), CAST(sum(total_amount) AS DOUBLE) FROM pas2
        UNION ALL SELECT 'fec_committee_transactions', count(*), CAST(sum(total_amount) AS DOUBLE) FROM oth
        UNION ALL SELECT 'fec_expenditures_by_category', count(*), CAST(sum(total_amount) AS DOUBLE) FROM by_category
        UNION ALL SELECT 'fec_expenditures_by_state', count(*), CAST(sum(total_amount) AS DOUBLE) FROM by_state""",
        f"{PAS2}, {OTH}, {CATEGORY}, {STATE}, {LINKS}"),
    "report_tables_rows": duckdb_sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        + f") AS \"row\" FROM {source}" for name, (source, columns) in REPORT_ROWS.items()), f"{PAS2}, {OTH}, {CATEGORY}, {STATE}, {LINKS}"),
    "report_load_held": duckdb_sql("""SELECT 'published' AS state, cmte_id, election_cycle AS year, min(cand_id) AS cand_id, NULL::varchar AS reason
        FROM committees GROUP BY cmte_id, election_cycle
        UNION ALL SELECT 'rejected', cmte_id, election_cycle, '+' || cand_id, 'repeated key' FROM (
          SELECT *, count(*) OVER (PARTITION BY cmte_id, election_cycle) AS n FROM committees WHERE election_cycle = 1998) c WHERE n > 1"""),
    "report_load_diverted": duckdb_sql("""SELECT 'published' AS state, cmte_id, election_cycle AS year,
          CASE WHEN bool_or(cand_id IS NULL) AND election_cycle = 1998 THEN NULL ELSE '+' || min(cand_id) END AS cand_id, NULL::varchar AS reason
        FROM committees GROUP BY cmte_id, election_cycle
        UNION ALL SELECT 'rejected', cmte_id, election_cycle, '+' || cand_id, 'repeated key' FROM (
          SELECT *, row_number() OVER (PARTITION BY cmte_id, election_cycle ORDER BY cand_id NULLS FIRST) AS n
          FROM committees WHERE election_cycle = 1998) c WHERE n > 1"""),
    "report_load_unreadable": duckdb_sql("""SELECT CASE WHEN right(cand_id, 1) <> '5' THEN cand_id END AS cand_id, election_cycle AS year,
          CASE right(cand_id, 1) WHEN '3' THEN 'unreadable ttl_receipts' WHEN '5' THEN 'missing cand_id' END AS reason,
          CASE WHEN right(cand_id, 1) NOT IN ('3', '4') THEN CAST(ttl_receipts AS DOUBLE) END AS ttl_receipts FROM summaries"""),
    "report_key_violations": duckdb_sql("""SELECT 'fec_committees' AS table_name,
        '{"cmte_id":"' || cmte_id || '","year":' || election_cycle || '}' AS "key", count(*) AS row_count
        FROM committees GROUP BY cmte_id, election_cycle HAVING count(*) > 1"""),
    "raw_value_audit": duckdb_sql("""SELECT 'transaction_amt' AS column_name, count(amount) AS filled,
        count(*) FILTER (WHERE kind = 0 AND amount IS NOT NULL) AS unparsed,
        count(*) FILTER (WHERE kind = 1 AND amount IS NOT NULL) AS rounded
        FROM (SELECT transaction_amt AS amount, length(sub_id) % 5 + CAST(right(sub_id, 1) AS int) AS kind FROM txn) t"""),
    "raw_width_check": duckdb_sql("""SELECT election_cycle, count(*) AS n_lines,
        count(*) FILTER (WHERE sub_id LIKE '%3') AS short_lines, count(*) FILTER (WHERE sub_id LIKE '%4') AS long_lines
        FROM txn GROUP BY 1"""),
    "rejected_lines": duckdb_sql(f"""SELECT election_cycle, tran_id, amount, transaction_dt, reason FROM ({SPOILT}) s WHERE reason <> ''"""),
    "accepted_lines": duckdb_sql(f"""SELECT election_cycle, cmte_id, sub_id, nullif(name, '') AS name, transaction_dt,
        CAST(transaction_amt AS DOUBLE) AS transaction_amt FROM ({SPOILT}) s WHERE reason = ''"""),
    "rejected_line_counts": duckdb_sql(f"""SELECT election_cycle, r AS reason, count(*) AS n_lines
        FROM (SELECT election_cycle, unnest(string_split(reason, ', ')) AS r FROM ({SPOILT}) s WHERE reason <> '') q GROUP BY ALL"""),
    "required_nulls": duckdb_sql("""SELECT 'cmte_id' AS column_name, count(*) FILTER (WHERE cmte_id IS NULL) AS null_rows FROM txn
        UNION ALL SELECT 'transaction_amt', count(*) FILTER (WHERE transaction_amt IS NULL) FROM txn
        UNION ALL SELECT 'name', count(*) FILTER (WHERE name IS NULL) FROM txn
        UNION ALL SELECT 'memo_cd', count(*) FILTER (WHERE memo_cd IS NULL) FROM txn"""),
    "out_of_range": duckdb_sql(f"""SELECT election_cycle, sub_id, transaction_dt, y AS transaction_year FROM (
          SELECT *, {year('transaction_dt')} AS y FROM txn) t WHERE y < election_cycle - 1 OR y > election_cycle - 1"""),
    "decode_candidate_codes": duckdb_sql(f"""SELECT cand_id, election_cycle, {_sql_map(PARTIES, 'cand_pty_affiliation')} AS party,
        {_sql_map(INCUMBENCY, 'cand_ici')} AS incumbency, {_sql_map(OFFICES, 'cand_office')} AS office,
        {_sql_map(STATUSES, 'status')} AS status
        FROM (SELECT *, CASE election_cycle % 8 WHEN 0 THEN 'C' WHEN 2 THEN 'P' WHEN 4 THEN 'F' ELSE 'X' END AS status
          FROM candidates) c"""),
    "decode_transaction_types": duckdb_sql(f"""SELECT transaction_tp, {_sql_map(TRANSACTION_TYPES, 'transaction_tp')} AS label,
        count(*) AS n FROM txn GROUP BY 1"""),
    "category_exclude": duckdb_sql(f"""SELECT category, count(*) AS n, CAST(sum(transaction_amt) AS DOUBLE) AS amount
        FROM txn WHERE category IN {_sql_list(CATEGORIES)} GROUP BY 1"""),
    "expansion_audit": duckdb_sql(f"""SELECT bioguide_id, linked, expanded FROM (
          SELECT bioguide_id, count(DISTINCT cand_id) AS linked FROM links GROUP BY 1) b
        JOIN (SELECT bioguide_id, count(*) AS expanded FROM (SELECT DISTINCT b.cand_id, l.bioguide_id
            FROM links l JOIN (SELECT DISTINCT cand_id, {KEY} AS name_key FROM candidates) a ON a.cand_id = l.cand_id
            JOIN (SELECT DISTINCT cand_id, {KEY} AS name_key FROM candidates) b ON b.name_key = a.name_key
            WHERE a.name_key <> '') x GROUP BY 1) e USING (bioguide_id)""", LINKS),
    # derived columns, filters
    "combine_cycles": duckdb_sql(f"""SELECT election_cycle, cand_id, {cap('cand_name')} AS cand_name, cand_ici,
        CAST(ttl_receipts AS DOUBLE) AS ttl_receipts, CAST(ttl_disb AS DOUBLE) AS ttl_disb,
        {iso('cvg_end_dt')} AS cvg_end_dt FROM summaries"""),
    "add_transaction_year": duckdb_sql(
        f"SELECT election_cycle, sub_id, cmte_id, transaction_dt, {year('transaction_dt')} AS transaction_year FROM txn"),
    "net_totals": duckdb_sql("""SELECT election_cycle, cand_id,
        CAST(coalesce(ttl_receipts, 0) - coalesce(trans_from_auth, 0) AS DOUBLE) AS net_receipts,
        CAST(coalesce(ttl_disb, 0) - coalesce(trans_to_auth, 0) AS DOUBLE) AS net_disbursements,
        CAST(coalesce(cand_contrib, 0) + coalesce(cand_loans, 0) AS DOUBLE) AS self_funding FROM summaries"""),
    "decode_codes": duckdb_sql(f"""SELECT election_cycle, cmte_id, cand_id,
        {_sql_map(COMMITTEE_TYPES, 'cmte_tp')} AS type_label,
        {_sql_map(DESIGNATIONS, 'cmte_dsgn')} AS designation_label FROM committees"""),
    "category_fold": duckdb_sql(f"""SELECT category, n, amount, {_sql_map(CATEGORIES, 'category')} AS label
        FROM (SELECT CASE WHEN category IS NULL OR category IN {_sql_list(CATEGORIES)} THEN category
          ELSE '012' END AS category, count(*) AS n, CAST(sum(transaction_amt) AS DOUBLE) AS amount
          FROM txn GROUP BY 1) f"""),
    "exclude_memos": duckdb_sql("""SELECT election_cycle, sub_id, memo_cd, CAST(transaction_amt AS DOUBLE) AS
        transaction_amt FROM txn WHERE memo_cd IS NULL OR memo_cd <> 'X'"""),
    "exclude_amendments": duckdb_sql("""SELECT election_cycle, sub_id, amndt_ind, CAST(transaction_amt AS DOUBLE) AS
        transaction_amt FROM txn WHERE amndt_ind IS NULL OR amndt_ind = 'N'"""),
    "committee_lookup": duckdb_sql("""SELECT DISTINCT election_cycle, cmte_id, cand_id FROM committees
        WHERE cmte_tp IN ('H', 'S', 'P') AND cand_id <> ''"""),
    "cycle_slice": duckdb_sql("""SELECT election_cycle, sub_id, cmte_id, CAST(transaction_amt AS DOUBLE) AS
        transaction_amt FROM txn WHERE election_cycle = 2000"""),
    "cycle_lookback": duckdb_sql("""SELECT dataset, cycle FROM manifest_new
        WHERE cycle IN (1998, 2000, 2002) AND cycle >= length(dataset) + 1990"""),
    "terms_in_range": duckdb_sql("""SELECT bioguide_id, count(*) AS terms, min(term_start) AS first_start
        FROM member_terms WHERE CAST(substr(term_start, 1, 4) AS int) <= 1999
          AND coalesce(CAST(substr(term_end, 1, 4) AS int), CAST(substr(term_start, 1, 4) AS int) + 2) >= 1996
        GROUP BY bioguide_id"""),
    "change_audit": duckdb_sql(
        " UNION ALL ".join(
            f"""(SELECT * FROM (SELECT DISTINCT '{c}' AS column_name, {c} AS "before", {f(c)} AS "after" FROM txn
            WHERE {c} IS NOT NULL) x WHERE "before" IS DISTINCT FROM "after" ORDER BY "before" LIMIT 3)"""
            for c, f in [("name", cap), ("employer", cap), ("transaction_dt", iso)])),
    "id_format_check": duckdb_sql("""SELECT substr(id, 1, 1) AS letter, count(*) AS n,
        count(*) FILTER (WHERE length(id) = 9 AND substr(id, 1, 1) IN ('H', 'S', 'P')) AS candidate_ids,
        count(*) FILTER (WHERE length(id) = 9 AND substr(id, 1, 1) = 'C') AS committee_ids
        FROM (SELECT cand_id AS id FROM member_ids UNION ALL SELECT DISTINCT cmte_id FROM committees
          UNION ALL SELECT DISTINCT substr(cmte_id, 1, 8) FROM committees) i GROUP BY 1"""),
    # roll-ups
    "committee_transactions": duckdb_sql(whole("oth", "source_cmte_id, dest_cmte_id, dest_name, transaction_tp"), OTH),
    "committee_to_candidate": duckdb_sql(whole("pas2", "cmte_id, cmte_name, cand_id, transaction_tp"), PAS2),
    "expenditures_by_category": duckdb_sql(whole("by_category", "cmte_id, category, category_desc"), CATEGORY),
    "expenditures_by_state": duckdb_sql(whole("by_state", "cmte_id, state"), STATE),
    "dedupe_sub_id": duckdb_sql(f"""SELECT election_cycle, sub_id, cmte_id, transaction_dt,
        CAST(transaction_amt AS DOUBLE) AS transaction_amt FROM (
          SELECT *, row_number() OVER (PARTITION BY election_cycle, sub_id
            ORDER BY {_nulls_first(_INDIVIDUAL_RAW)}) AS pick FROM txn) q WHERE pick = 1"""),
    "exclusion_audit": duckdb_sql("""SELECT election_cycle, count(*) AS input_rows,
        count(*) FILTER (WHERE memo) AS memo_rows, count(*) FILTER (WHERE NOT memo AND amended) AS amended_rows,
        count(*) FILTER (WHERE NOT memo AND NOT amended) - count(DISTINCT sub_id) FILTER (WHERE NOT memo AND NOT amended)
          AS duplicate_rows,
        count(DISTINCT sub_id) FILTER (WHERE NOT memo AND NOT amended) AS kept_rows
        FROM (SELECT *, coalesce(memo_cd = 'X', false) AS memo, coalesce(amndt_ind <> 'N', false) AS amended FROM txn) t
        GROUP BY election_cycle"""),
    "individual_by_candidate": duckdb_sql("""SELECT election_cycle, transaction_year, transaction_month, cand_id,
        bioguide_id, CAST(total_raised AS DOUBLE) AS total_raised, transaction_count FROM individual""", INDIVIDUAL),
    "cycle_counts": duckdb_sql("""SELECT election_cycle, count(*) AS row_count FROM txn GROUP BY 1
        ORDER BY 1 DESC LIMIT 2"""),
    # functions
    "transaction_year": duckdb_sql(
        f"SELECT transaction_dt, count(*) AS n, {year('transaction_dt')} AS transaction_year FROM txn GROUP BY transaction_dt"),
    "transaction_month": duckdb_sql(
        f"SELECT transaction_dt, count(*) AS n, {month('transaction_dt')} AS transaction_month FROM txn GROUP BY transaction_dt"),
    "iso_dates": duckdb_sql(f"""SELECT transaction_dt, iso, CAST(try_cast(iso AS date) AS varchar) AS "day", count(*) AS n
        FROM (SELECT transaction_dt, {iso('transaction_dt')} AS iso FROM txn) t GROUP BY ALL"""),
    "capitalize_names": duckdb_sql(
        f"SELECT name, {cap('name')} AS capitalized FROM (SELECT DISTINCT name FROM txn) t"),
    "name_key": duckdb_sql(f"SELECT cand_id, election_cycle, {KEY} AS name_key FROM candidates"),
    "parse_name": duckdb_sql("""SELECT cand_id, election_cycle, p_last AS "last", p_first AS "first", p_suffix AS suffix
        FROM parsed""", PARSED),
    "name_match_score": duckdb_sql(f"""SELECT cand_id, bioguide_id, {score('first_name', 'last_name', 'm.suffix')} AS score
        FROM (SELECT DISTINCT cand_id, cand_name, cand_office_st, p_last, p_first, p_suffix FROM parsed) p
        JOIN members m ON m.state = cand_office_st AND upper(p_last) = last_name""", PARSED),
    "term_cycles": duckdb_sql("""SELECT bioguide_id, term_start, CAST(cycle AS int) AS cycle FROM campaigns
        WHERE cycle BETWEEN 1980 AND 2026""", CAMPAIGNS),
    "standardize_names": duckdb_sql(f"""SELECT election_cycle, cmte_id, cand_id, {cap('cmte_nm')} AS cmte_nm,
        {cap('tres_nm')} AS tres_nm, {cap('connected_org_nm')} AS connected_org_nm FROM committees"""),
    "standardize_dates": duckdb_sql(f"SELECT election_cycle, cand_id, {iso('cvg_end_dt')} AS cvg_end_dt FROM summaries"),
    # crosswalk and legislators
    "crosswalk_authoritative": duckdb_sql(
        "SELECT cand_id, bioguide_id, 'authoritative' AS match_method, 'high' AS confidence FROM links", LINKS),
    "crosswalk_validate": duckdb_sql("""SELECT cand_id, bioguide_id FROM member_ids
        WHERE cand_id IN (SELECT cand_id FROM candidates)"""),
    "crosswalk_unverified": duckdb_sql("""SELECT cand_id, bioguide_id,
        CASE WHEN ok THEN 'authoritative' ELSE 'authoritative_unverified' END AS match_method,
        CASE WHEN ok THEN 'high' ELSE 'medium' END AS confidence
        FROM (SELECT DISTINCT cand_id, bioguide_id, cand_id IN (SELECT cand_id FROM candidates) AS ok FROM member_ids) p"""),
    "crosswalk_name_match": duckdb_sql(
        f"SELECT cand_id, bioguide_id, 'name_match' AS match_method, {BAND} AS confidence, score FROM matches", MATCHES),
    "crosswalk_resolve": duckdb_sql(
        "SELECT cand_id, bioguide_id, match_method, confidence FROM crosswalk WHERE confidence = 'high'", CROSSWALK),
    "crosswalk_stats": duckdb_sql("""SELECT 'match_method' AS metric, match_method AS "value", count(*) AS n
          FROM crosswalk GROUP BY 1, 2
        UNION ALL SELECT 'confidence', confidence, count(*) FROM crosswalk GROUP BY 1, 2
        UNION ALL SELECT 'several_partners', 'bioguide_id', count(*) FROM
          (SELECT bioguide_id FROM crosswalk GROUP BY 1 HAVING count(*) > 1) a
        UNION ALL SELECT 'several_partners', 'cand_id', count(*) FROM
          (SELECT cand_id FROM crosswalk GROUP BY 1 HAVING count(*) > 1) b""", CROSSWALK),
    "crosswalk_expand": duckdb_sql(f"""SELECT DISTINCT b.cand_id, l.bioguide_id
        FROM links l JOIN (SELECT DISTINCT cand_id, {KEY} AS name_key FROM candidates) a ON a.cand_id = l.cand_id
        JOIN (SELECT DISTINCT cand_id, {KEY} AS name_key FROM candidates) b ON b.name_key = a.name_key
        WHERE a.name_key <> ''""", LINKS),
    "crosswalk_overrides": duckdb_sql("""SELECT full_name,
        CASE WHEN full_name LIKE '%Jr' OR full_name LIKE '%Jr.' THEN coalesce(o.bioguide_id, found) ELSE found END AS bioguide_id
        FROM (SELECT *, CASE WHEN bioguide_id[1] > 'M' THEN bioguide_id END AS found,
          first_name || ' ' || last_name || coalesce(' ' || suffix, '') AS full_name FROM members) p
        LEFT JOIN (SELECT trim(regexp_replace(regexp_replace(lower(first_name || ' ' || last_name || ' Jr'), '[.,'']', ' ', 'g'),
            ' +', ' ', 'g')) AS plain, 'Z' || substr(bioguide_id, 2, 9) AS bioguide_id
          FROM members WHERE suffix = 'Jr') o
        ON o.plain = trim(regexp_replace(regexp_replace(lower(full_name), '[.,'']', ' ', 'g'), ' +', ' ', 'g'))"""),
    "expected_pairs_check": duckdb_sql("""SELECT e.cand_id, e.bioguide_id AS expected,
        CASE WHEN bool_or(c.bioguide_id = e.bioguide_id) THEN 'match' WHEN count(c.bioguide_id) > 0 THEN 'mismatch'
          ELSE 'missing' END AS status
        FROM member_ids e LEFT JOIN (SELECT * FROM crosswalk WHERE confidence = 'high') c ON c.cand_id = e.cand_id
        GROUP BY 1, 2""", CROSSWALK),
    "legislators_merge": duckdb_sql("""SELECT bioguide_id,
        CASE WHEN max(term_start) >= '2000' THEN upper(first_name) ELSE first_name END AS first_name,
        count(term_start) AS terms FROM members LEFT JOIN member_terms USING (bioguide_id) GROUP BY bioguide_id, first_name"""),
    "legislator_stats": duckdb_sql("""SELECT metric, "value", count(*) AS legislators FROM (
          SELECT 'party' AS metric, coalesce(party, 'Unknown') AS "value" FROM seen
          UNION ALL SELECT 'chamber', coalesce(CASE term_type WHEN 'sen' THEN 'Senate' WHEN 'rep' THEN 'House' END, 'Unknown')
            FROM seen
          UNION ALL SELECT 'candidate_ids', CASE WHEN k IN (SELECT k FROM member_ids) THEN 'with' ELSE 'without' END FROM seen
        ) f GROUP BY 1, 2""",
        """seen AS (SELECT m.k, t.party, t.term_type FROM members m
          LEFT JOIN (SELECT DISTINCT k, party, term_type FROM member_terms) t ON t.k = m.k)"""),
    # quality
    "table_profile": duckdb_sql(_profile("txn", "txn", 23)),
    "quality_report": duckdb_sql("""SELECT p.*, coalesce(i.issues, '') AS issues, i.issues IS NULL AS is_valid
        FROM profiles p LEFT JOIN (SELECT table_name, string_agg(issue, '; ' ORDER BY issue) AS issues
          FROM issue_rows GROUP BY 1) i USING (table_name)""", STATE + ", " + REPORT),
    "quality_issues": duckdb_sql("SELECT table_name, issue FROM issue_rows", STATE + ", " + REPORT),
    "amount_check": duckdb_sql("""SELECT count(*) FILTER (WHERE abs(total_amount * 1000000) > 1000000000000) AS extreme_rows,
        count(*) FILTER (WHERE transaction_count - 5 <= 0) AS nonpositive_rows FROM by_state""", STATE),
    "key_uniqueness": duckdb_sql("""SELECT election_cycle, cmte_id, count(*) AS row_count FROM committees
        GROUP BY 1, 2 HAVING count(*) > 1"""),
    # refresh
    "manifest_diff": duckdb_sql(f"""SELECT n.dataset, n.cycle, CASE WHEN o.dataset IS NULL THEN 'new cycle'
        WHEN {_DIFF('etag', "''")} THEN 'etag changed' WHEN {_DIFF('last_modified', "''")} THEN 'last-modified changed'
        WHEN {_DIFF('content_length', '0')} THEN 'content-length changed' ELSE 'no change' END AS reason,
        n.etag, n.last_modified, n.content_length
        FROM manifest_new n LEFT JOIN manifest_old o ON o.dataset = n.dataset AND o.cycle = n.cycle"""),
    "manifest_force": duckdb_sql("""SELECT dataset, CAST(cycle AS int) AS cycle, 'forced' AS reason FROM (
          SELECT dataset, min(cycle) + length(dataset) - 6 AS start_year, unnest([1998, 2000, 2002]) AS cycle
          FROM manifest_new GROUP BY dataset) d WHERE cycle >= start_year"""),
    "apply_changes": duckdb_sql(BOTH_SPENDING.format(more=", content_length",
        join=" JOIN (SELECT election_cycle, count(*) AS content_length FROM txn GROUP BY 1) c USING (election_cycle)"),
        f"{CATEGORY}, {STATE}"),
    "stream_redelivery": duckdb_sql("""SELECT election_cycle, transaction_year, cmte_id, state, transaction_count,
          CAST(CASE WHEN election_cycle < 1996 THEN 2 * total_amount ELSE total_amount END AS DOUBLE) AS total_amount
        FROM by_state""", STATE),
    "stream_two_tables": duckdb_sql(BOTH_SPENDING.format(more="", join=""), f"{CATEGORY}, {STATE}"),
    "refresh_figures": duckdb_sql("""SELECT election_cycle AS cycle, 'applied' AS status, CAST(input_rows AS BIGINT) AS input_rows,
          CAST(memo_rows AS BIGINT) AS memo_rows, CAST(amended_rows AS BIGINT) AS amended_rows,
          CAST(input_rows - memo_rows - amended_rows - kept_rows AS BIGINT) AS duplicate_rows,
          CAST(row_count AS BIGINT) AS row_count, CAST(kept_rows AS BIGINT) AS kept_rows, CAST(0 AS BIGINT) AS extreme_rows, CAST(0 AS BIGINT) AS nonpositive_rows
        FROM (SELECT election_cycle, count(*) AS input_rows, count(*) FILTER (WHERE memo_cd = 'X') AS memo_rows,
            count(*) FILTER (WHERE coalesce(memo_cd, '') <> 'X' AND amndt_ind <> 'N') AS amended_rows FROM txn GROUP BY 1) r
        JOIN (SELECT election_cycle, count(*) AS row_count, sum(transaction_count) AS kept_rows FROM by_category GROUP BY 1) f
        USING (election_cycle)""", CATEGORY),
    "refresh_preview": duckdb_sql("""SELECT election_cycle AS cycle, count(*) OVER (PARTITION BY election_cycle) AS row_count, cmte_id, category, transaction_year
        FROM by_category QUALIFY row_number() OVER (PARTITION BY election_cycle ORDER BY transaction_year NULLS FIRST, cmte_id NULLS FIRST,
          category NULLS FIRST, category_desc NULLS FIRST) = 1""", CATEGORY),
    "scan_text_csv": duckdb_sql("""SELECT CAST(election_cycle AS VARCHAR) AS election_cycle, nullif(name, '') AS name, memo_text,
        CAST(transaction_amt AS VARCHAR) AS transaction_amt, sub_id FROM txn"""),
    "refresh_status": duckdb_sql("""SELECT dataset, cycle, coalesce(last_updated, 'unknown') AS last_updated,
        count(*) OVER (PARTITION BY dataset) AS cycles, max(last_updated) OVER (PARTITION BY dataset) AS dataset_updated
        FROM manifest_old"""),
    "stream_cycle_ingest": duckdb_sql(whole("oth", "source_cmte_id, dest_cmte_id, dest_name, transaction_tp"), OTH),
    # reports
    "member_summary": duckdb_sql("""SELECT bioguide_id, s.cand_id, election_cycle AS "year",
        CAST(ttl_receipts AS DOUBLE) AS ttl_receipts, CAST(ttl_disb AS DOUBLE) AS ttl_disb,
        CAST(coh_cop AS DOUBLE) AS coh_cop, CAST(ttl_indiv_contrib AS DOUBLE) AS ttl_indiv_contrib,
        CAST(other_pol_cmte_contrib AS DOUBLE) AS other_pol_cmte_contrib,
        CAST(pol_pty_contrib AS DOUBLE) AS pol_pty_contrib, CAST(cand_contrib + cand_loans AS DOUBLE) AS self_funding
        FROM summaries s JOIN links l ON l.cand_id = s.cand_id""", LINKS),
    "top_committees": duckdb_sql("""SELECT bioguide_id, election_cycle, cmte_id, cmte_name,
        CAST(total_contributed AS DOUBLE) AS total_contributed, CAST(num_transactions AS BIGINT) AS num_transactions
        FROM (SELECT *, row_number() OVER (PARTITION BY bioguide_id, election_cycle
            ORDER BY total_contributed DESC, cmte_id, cmte_name NULLS FIRST) AS pick
          FROM (SELECT bioguide_id, election_cycle, cmte_id, cmte_name, sum(total_amount) AS total_contributed,
              sum(transaction_count) AS num_transactions
            FROM pas2 JOIN links USING (cand_id) WHERE transaction_tp IN ('24K', '24E') GROUP BY ALL) g) r
        WHERE pick <= 20""", f"{PAS2}, {LINKS}"),
    "expenditure_breakdown": duckdb_sql("""SELECT bioguide_id, e.election_cycle, category, category_desc,
        CAST(sum(total_amount) AS DOUBLE) AS total_spent
        FROM by_category e JOIN (SELECT DISTINCT bioguide_id, election_cycle, cmte_id
          FROM committees JOIN links USING (cand_id) WHERE cmte_dsgn = 'P') o
        ON o.election_cycle = e.election_cycle AND o.cmte_id = e.cmte_id GROUP BY ALL""", f"{CATEGORY}, {LINKS}"),
    "committee_received": duckdb_sql("""SELECT dest_cmte_id, election_cycle, CAST(sum(total_amount) AS DOUBLE) AS received,
        CAST(sum(transaction_count) AS BIGINT) AS num_transactions FROM oth GROUP BY 1, 2""", OTH),
    "committee_given": duckdb_sql("""SELECT p.election_cycle, p.cmte_id, p.cand_id, s.cand_name, l.bioguide_id,
        CAST(sum(total_amount) AS DOUBLE) AS contributed
        FROM pas2 p JOIN summaries s ON s.cand_id = p.cand_id AND s.election_cycle = p.election_cycle
        LEFT JOIN links l ON l.cand_id = s.cand_id GROUP BY ALL""", f"{PAS2}, {LINKS}"),
    "committee_search": duckdb_sql("""SELECT cmte_id, max_by(cmte_nm, election_cycle) AS cmte_nm,
        max_by(cmte_tp, election_cycle) AS cmte_tp, max(election_cycle) AS latest_year
        FROM committees WHERE cmte_nm ILIKE '%pac%' GROUP BY cmte_id ORDER BY latest_year DESC, cmte_id LIMIT 5"""),
    "committee_search_indexed": duckdb_sql(" UNION ALL ".join(f"""(SELECT cmte_id, max_by(cmte_nm, election_cycle) AS cmte_nm,
        max_by(cmte_tp, election_cycle) AS cmte_tp, max(election_cycle) AS latest_year, '{text}' AS asked
        FROM committees WHERE cmte_nm ILIKE '%{text}%' GROUP BY cmte_id ORDER BY latest_year DESC, cmte_id LIMIT 200)"""
        for text in ("pac", "ommit_ee", "c%1", "pa", ""))),
    "large_contributions": duckdb_sql("""SELECT p.election_cycle, cmte_name, cand_name,
        CAST(total_amount AS DOUBLE) AS total_amount
        FROM pas2 p JOIN summaries s ON s.cand_id = p.cand_id AND s.election_cycle = p.election_cycle
        WHERE total_amount >= 100000""", PAS2),
    "individual_totals": duckdb_sql("""SELECT election_cycle, cand_id, CAST(sum(total_raised) AS DOUBLE) AS total_raised,
        CAST(sum(transaction_count) AS BIGINT) AS transaction_count FROM individual GROUP BY 1, 2""", INDIVIDUAL),
    "monthly_trend": duckdb_sql(f"""SELECT transaction_month, CAST(sum(total_raised) AS DOUBLE) AS total_raised,
        CAST(sum(transaction_count) AS BIGINT) AS transaction_count FROM individual
        WHERE election_cycle = {OPEN_CYCLE} GROUP BY 1""", INDIVIDUAL),
    "served_candidates": duckdb_sql("""SELECT c.cand_id, election_cycle, cand_name, bioguide_id
        FROM candidates c JOIN links l ON l.cand_id = c.cand_id""", LINKS),
    "served_candidate_count": duckdb_sql("""SELECT count(DISTINCT c.cand_id) AS candidates, count(*) AS registrations
        FROM candidates c JOIN links l ON l.cand_id = c.cand_id""", LINKS),
    "fundraising_over_time": duckdb_sql("""SELECT cand_id, election_cycle, CAST(ttl_receipts AS DOUBLE) AS ttl_receipts,
        CAST(ttl_disb AS DOUBLE) AS ttl_disb, CAST(coh_cop AS DOUBLE) AS coh_cop FROM summaries"""),
    "funders_of_candidates": duckdb_sql(f"SELECT election_cycle, cand_id, cmte_id, {SUMS} FROM pas2 GROUP BY 1, 2, 3", PAS2),
    "flow_between_committees": duckdb_sql(
        f"SELECT election_cycle, source_cmte_id, dest_cmte_id, {SUMS} FROM oth GROUP BY 1, 2, 3", OTH),
    "spend_by_state": duckdb_sql(f"SELECT election_cycle, state, {SUMS} FROM by_state GROUP BY 1, 2", STATE),
    "spend_by_category": duckdb_sql(
        f"SELECT election_cycle, category, category_desc, {SUMS} FROM by_category GROUP BY 1, 2, 3", CATEGORY),
}

# A report called from SQL has the rows of the report.
ORACLES |= {
    f"sql_{name}": ORACLES[name] for name in (
        "member_summary", "top_committees", "expenditure_breakdown", "committee_received", "committee_given", "committee_search",
        "large_contributions", "individual_totals", "monthly_trend", "served_candidates", "fundraising_over_time",
        "funders_of_candidates", "flow_between_committees", "spend_by_state", "spend_by_category")
}
