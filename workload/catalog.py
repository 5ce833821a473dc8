"""Registered queries: library operators over the given tables in campaign-finance shape."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warchest import functions as fx
from warchest.operators import clean, combine, crosswalk, legislators, manifest, name_index, quality, rollup
from warchest.plans import jobs, refresh, report_sql, reports
from warchest.session import shared_dir
from warchest.sources import catalog as report_tables
from warchest.sources import files, lines, tables
from warchest.specs import LEGISLATOR, MONEY, SPECS, DatasetSpec
from warchest.streaming import ingest

from .views import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OPEN_CYCLE = 2002  # newest cycle of the given tables
CYCLE = clean.CYCLE


def query(fn: Query) -> Query:
    """Register; money leaves as DOUBLE so that both engines report one type."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(spark, sf_dir)
        money = [f.name for f in out.schema if isinstance(f.dataType, T.DecimalType)]
        return out.withColumns({c: F.col(c).cast("double") for c in money}) if money else out

    QUERIES[fn.__name__] = run
    return fn


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------------------


def txn(spark, d):
    return view(spark, d, "txn")


def committees(spark, d):
    return view(spark, d, "committees")


def candidates(spark, d):
    return view(spark, d, "candidates")


def summaries(spark, d):
    return view(spark, d, "summaries")


def members(spark: SparkSession, d: str) -> DataFrame:
    """Nested legislator records.  A member has at most one term per calendar year and a few
    ids, so the collected lists are short whatever the size of the tables."""
    people, terms, ids = view(spark, d, "members"), view(spark, d, "member_terms"), view(spark, d, "member_ids")
    term = F.struct(
        F.col("term_start").alias("start"), F.col("term_end").alias("end"),
        F.col("term_type").alias("type"), "state", "party")
    listed = terms.groupBy("k").agg(F.sort_array(F.collect_list(term), asc=False).alias("terms"))
    owned = ids.groupBy("k").agg(F.sort_array(F.collect_list("cand_id")).alias("fec"))
    null = F.lit(None).cast("string")
    full_term = lambda t: F.struct(*[
        (t[f.name] if f.name in ("type", "start", "end", "state", "party") else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in LEGISLATOR["terms"].dataType.elementType])
    text = lambda struct, known: F.struct(*[
        known.get(f.name, null).alias(f.name) for f in LEGISLATOR[struct].dataType])
    return people.join(listed, "k", "left").join(owned, "k", "left").select(
        text("id", {"bioguide": F.col("bioguide_id"),
                    "fec": F.coalesce("fec", F.array().cast("array<string>"))}).alias("id"),
        text("name", {"first": F.col("first_name"), "last": F.col("last_name"), "suffix": F.col("suffix"),
                      "nickname": F.col("nickname")}).alias("name"),
        text("bio", {}).alias("bio"),
        F.transform(F.coalesce("terms", F.array().cast(
            "array<struct<start:string,end:string,type:string,state:string,party:string>>")), full_term).alias("terms"),
    )


def links(spark, d):
    """Crosswalk of the declared, registered ids."""
    return crosswalk.authoritative(members(spark, d), candidates(spark, d))


def raw_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All raw columns of a family; those the given tables cannot fill are NULL."""
    have = {f.name for f in df.schema}
    return df.select(CYCLE, *[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.raw_schema])


def land(spark: SparkSession, df: DataFrame, spec: DatasetSpec, name: str, again: str | None = None) -> str:
    """Write raw rows as ``|`` files named by cycle, as they would be delivered.

    The writer names files itself, so each cycle is written to a folder and its files are
    moved to delivered names inside the same file system.  Each task writes a file a cycle; lines are not shuffled for it.  With ``again``, a landing folder, files
    of the same names there are overwritten, and further ones of these cycles are taken away.
    """
    root = scratch(spark, name)
    landing = again or f"{root}/landing"
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns])
    df.select(CYCLE, line.alias("value")).write.partitionBy(CYCLE).text(f"{root}/parts")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.globStatus(path(f"{root}/parts/{CYCLE}=*")):
        cycle = folder.getPath().getName().split("=")[1]
        for earlier in fs.globStatus(path(f"{landing}/*/{cycle}_*")) if again else ():
            fs.delete(earlier.getPath(), False)
        for i, part in enumerate(fs.globStatus(path(f"{folder.getPath()}/part-*"))):
            target = path(f"{landing}/{i}/{cycle}_{spec.prefix}{cycle[2:]}.txt")
            fs.mkdirs(target.getParent())
            fs.rename(part.getPath(), target)
    return landing


# ---------------------------------------------------------------------------------------
# Scans, sinks, loads
# ---------------------------------------------------------------------------------------

OTH = SPECS["committee_transaction_summaries"]
PAS2 = SPECS["committee_to_candidate_summaries"]
BY_CATEGORY = SPECS["expenditures_by_category"]
BY_STATE = SPECS["expenditures_by_state"]


@query
def scan_pipe(spark, d):
    """Round trip through delivered files: quotes, empty fields and dates survive as text."""
    landing = land(spark, raw_rows(txn(spark, d), OTH), OTH, "scan_pipe")
    return files.read_dataset(spark, landing, OTH).select(
        CYCLE, "cmte_id", "amndt_ind", "transaction_tp", "name", "transaction_dt", "transaction_amt",
        "memo_cd", "memo_text", "sub_id")


@query
def cycle_from_path(spark, d):
    landing = land(spark, raw_rows(txn(spark, d), OTH), OTH, "cycle_from_path")
    return quality.cycle_counts(files.read_dataset(spark, landing, OTH))


@query
def scan_csv_projected(spark, d):
    out = scratch(spark, "csv")
    rows = txn(spark, d).select(CYCLE, "cmte_id", "name", "memo_text", "transaction_dt", "transaction_amt", "sub_id")
    tables.export_csv(rows, out)
    return files.read_csv(spark, out, rows.schema, ["cmte_id", "name", "memo_text", "transaction_amt"])


@query
def snake_case_headers(spark, d):
    rows = txn(spark, d).select("cmte_id", "transaction_dt", "sub_id")
    return combine.snake_case(rows.toDF("CMTE_ID", "Transaction_DT", "SUB_ID"))


@query
def legislators_scan(spark, d):
    out = scratch(spark, "legislators")
    members(spark, d).write.json(out)
    read = files.read_legislators(spark, out)
    return read.select(
        F.col("id.bioguide").alias("bioguide_id"), F.col("name.last").alias("last_name"),
        F.size("id.fec").cast("bigint").alias("ids"), F.size("terms").cast("bigint").alias("terms"),
        F.get("terms", F.lit(0))["start"].alias("latest_start"), F.col("name.first").alias("first_name"), F.col("name.nickname").alias("nickname"),
        F.array_join("id.fec", ",").alias("id_list"), F.array_join(F.transform("terms", lambda t: F.concat(
            t["start"], F.lit("/"), F.coalesce(t["end"], F.lit("")), F.lit("/"), t["type"], F.lit("/"), t["state"], F.lit("/"),
            F.coalesce(t["party"], F.lit("")))), ",").alias("term_list"))


@query
def table_sink(spark, d):
    out = scratch(spark, "table")
    tables.write_table(rollup.rollup(txn(spark, d), PAS2), out, refresh.sort_columns(PAS2))
    return tables.read_table(spark, out)


@query
def partitioned_sink(spark, d):
    out = scratch(spark, "partitioned")
    tables.write_partitioned(combine.combine_individuals(raw_rows(txn(spark, d), OTH)), out, ["cmte_id"])
    return tables.read_table(spark, out).select(
        CYCLE, "cmte_id", "name", "employer", "occupation", "transaction_amt", "sub_id")


@query
def replace_cycle(spark, d):
    """Cycle 2000 is rebuilt from its direct contributions only; the others stay as they were."""
    out = scratch(spark, "replace")
    raw = txn(spark, d)
    tables.write_partitioned(rollup.rollup(raw, BY_STATE), out)
    later = rollup.rollup(raw.where("election_cycle = 2000 AND transaction_tp = '24K'"), BY_STATE)
    tables.replace_cycle(later, out, 2000, refresh.sort_columns(BY_STATE))
    return tables.read_table(spark, out)


@query
def expenditures_two_rollups(spark, d):
    category, state = rollup.expenditure_rollups(txn(spark, d))
    none = F.lit(None).cast("string")
    shape = lambda df, kind, cat, desc, st: df.select(
        F.lit(kind).alias("kind"), CYCLE, "transaction_year", "cmte_id", cat.alias("category"),
        desc.alias("category_desc"), st.alias("state"), "total_amount", "transaction_count")
    return shape(category, "category", F.col("category"), F.col("category_desc"), none).unionByName(
        shape(state, "state", none, none, F.col("state")))


@query
def typed_table_load(spark, d):
    spec = report_tables.REPORT_TABLES["fec_committee_to_candidate"]
    out = scratch(spark, "typed")
    tables.write_table(report_tables.report_table(rollup.rollup(txn(spark, d), PAS2), spec, since=1998), out)
    return tables.read_table(spark, out)


# ---------------------------------------------------------------------------------------
# Derived columns, filters
# ---------------------------------------------------------------------------------------


@query
def combine_cycles(spark, d):
    spec = SPECS["all_candidate_summaries"]
    return combine.combine_cycles(raw_rows(summaries(spark, d), spec), spec).select(
        CYCLE, "cand_id", "cand_name", "cand_ici", "ttl_receipts", "ttl_disb", "cvg_end_dt")


@query
def add_transaction_year(spark, d):
    rows = txn(spark, d).select(CYCLE, "sub_id", "cmte_id", "transaction_dt")
    return clean.add_transaction_year(rows)


@query
def net_totals(spark, d):
    return combine.net_totals(summaries(spark, d)).select(
        CYCLE, "cand_id", "net_receipts", "net_disbursements", "self_funding")


@query
def decode_codes(spark, d):
    return committees(spark, d).select(
        CYCLE, "cmte_id", "cand_id", fx.decode("cmte_tp").alias("type_label"),
        fx.decode("cmte_dsgn").alias("designation_label"))


@query
def category_fold(spark, d):
    folded = txn(spark, d).withColumn("category", fx.fold_category(F.col("category")))
    return folded.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transaction_amt").alias("amount")
    ).withColumn("label", fx.decode("category"))


@query
def decode_candidate_codes(spark, d):
    status = F.expr(f"CASE {CYCLE} % 8 WHEN 0 THEN 'C' WHEN 2 THEN 'P' WHEN 4 THEN 'F' ELSE 'X' END")
    return candidates(spark, d).withColumn("cand_status", status).select(
        "cand_id", CYCLE, fx.decode("cand_pty_affiliation").alias("party"), fx.decode("cand_ici").alias("incumbency"),
        fx.decode("cand_office").alias("office"), fx.decode("cand_status").alias("status"))


@query
def decode_transaction_types(spark, d):
    return txn(spark, d).groupBy("transaction_tp").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "label", fx.decode("transaction_tp"))


@query
def category_exclude(spark, d):
    """Non-standard categories left out instead of folded."""
    known = txn(spark, d).withColumn("category", fx.known_category(F.col("category"))).where("category IS NOT NULL")
    return known.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("transaction_amt").alias("amount"))


@query
def exclude_memos(spark, d):
    return clean.exclude_memos(txn(spark, d)).select(CYCLE, "sub_id", "memo_cd", "transaction_amt")


@query
def exclude_amendments(spark, d):
    return clean.exclude_amendments(txn(spark, d)).select(CYCLE, "sub_id", "amndt_ind", "transaction_amt")


@query
def committee_lookup(spark, d):
    return rollup.committee_lookup(committees(spark, d))


@query
def cycle_slice(spark, d):
    return clean.cycle_slice(txn(spark, d), 2000).select(CYCLE, "sub_id", "cmte_id", "transaction_amt")


@query
def cycle_lookback(spark, d):
    rows = view(spark, d, "manifest_new").withColumn("start_year", F.length("dataset") + 1990)
    return manifest.lookback(rows, OPEN_CYCLE, F.col("start_year")).select("dataset", "cycle")


@query
def terms_in_range(spark, d):
    kept = legislators.terms_in_range(members(spark, d), 1996, 1999)
    return kept.select(
        F.col("id.bioguide").alias("bioguide_id"), F.size("terms").cast("bigint").alias("terms"),
        F.array_min(F.transform("terms", lambda t: t["start"])).alias("first_start"))


@query
def change_audit(spark, d):
    rows = txn(spark, d)
    return clean.changed_values(rows, {
        "name": fx.capitalize_name, "employer": fx.capitalize_name, "transaction_dt": fx.iso_date})


@query
def id_format_check(spark, d):
    """Candidate ids, committee ids, and committee ids that lack a character."""
    whole = committees(spark, d).select(F.col("cmte_id").alias("id")).distinct()
    ids = view(spark, d, "member_ids").select(F.col("cand_id").alias("id")).unionAll(whole).unionAll(
        whole.select(F.substring("id", 1, 8)).distinct())
    return ids.groupBy(F.substring("id", 1, 1).alias("letter")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fx.is_candidate_id(F.col("id"))).alias("candidate_ids"),
        F.count_if(fx.is_committee_id(F.col("id"))).alias("committee_ids"))


# ---------------------------------------------------------------------------------------
# Roll-ups
# ---------------------------------------------------------------------------------------


@query
def committee_transactions(spark, d):
    return rollup.rollup(txn(spark, d), OTH)


@query
def committee_to_candidate(spark, d):
    return rollup.rollup(txn(spark, d), PAS2)


@query
def expenditures_by_category(spark, d):
    return rollup.rollup(txn(spark, d), BY_CATEGORY)


@query
def expenditures_by_state(spark, d):
    return rollup.rollup(txn(spark, d), BY_STATE)


@query
def dedupe_sub_id(spark, d):
    return clean.dedupe(txn(spark, d).select(CYCLE, "sub_id", "cmte_id", "transaction_dt", "transaction_amt"))


@query
def exclusion_audit(spark, d):
    return rollup.exclusion_audit(txn(spark, d), OTH)


def individual_rollup(spark, d):
    return rollup.individual_by_candidate(txn(spark, d), committees(spark, d), links(spark, d), OPEN_CYCLE)


@query
def individual_by_candidate(spark, d):
    return individual_rollup(spark, d)


@query
def cycle_counts(spark, d):
    return quality.cycle_counts(txn(spark, d), last=2)


# ---------------------------------------------------------------------------------------
# Functions
# ---------------------------------------------------------------------------------------


@query
def transaction_year(spark, d):
    return txn(spark, d).groupBy("transaction_dt").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "transaction_year", fx.transaction_year("transaction_dt"))


@query
def transaction_month(spark, d):
    return txn(spark, d).groupBy("transaction_dt").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "transaction_month", fx.transaction_month("transaction_dt"))


@query
def iso_dates(spark, d):
    """Each distinct date text is converted once."""
    dates = txn(spark, d).groupBy("transaction_dt").agg(F.count(F.lit(1)).alias("n"))
    return dates.select(
        "transaction_dt", "n", fx.iso_date("transaction_dt").alias("iso"),
        fx.calendar_date("transaction_dt").cast("string").alias("day"))


@query
def capitalize_names(spark, d):
    return txn(spark, d).select("name").distinct().select("name", fx.capitalize_name("name").alias("capitalized"))


@query
def name_key(spark, d):
    return candidates(spark, d).select("cand_id", CYCLE, fx.name_key("cand_name").alias("name_key"))


@query
def parse_name(spark, d):
    return candidates(spark, d).select("cand_id", CYCLE, fx.parse_name("cand_name").alias("p")).select(
        "cand_id", CYCLE, "p.last", "p.first", "p.suffix")


@query
def name_match_score(spark, d):
    """Every candidate against the member of the same family name and state."""
    people = view(spark, d, "members").select("bioguide_id", "first_name", "last_name", "suffix", "state")
    named = candidates(spark, d).select(
        "cand_id", "cand_name", F.col("cand_office_st").alias("state"),
        F.upper(fx.parse_name("cand_name")["last"]).alias("last_name")).distinct()
    return named.join(people, ["state", "last_name"]).select(
        "cand_id", "bioguide_id", fx.name_match_score("cand_name", "first_name", "last_name", "suffix").alias("score"))


@query
def term_cycles(spark, d):
    return view(spark, d, "member_terms").select(
        "bioguide_id", "term_start",
        F.explode(fx.term_cycles(F.col("term_type"), F.col("term_start"), F.col("term_end"))).alias("cycle"))


@query
def standardize_names(spark, d):
    rows = committees(spark, d).select(CYCLE, "cmte_id", "cand_id", "cmte_nm", "tres_nm", "connected_org_nm")
    return clean.standardize_names(rows, SPECS["committee_registrations"].name_columns)


@query
def standardize_dates(spark, d):
    rows = summaries(spark, d).select(CYCLE, "cand_id", "cvg_end_dt")
    once = clean.standardize_dates(rows, ["cvg_end_dt"])
    return clean.standardize_dates(once, ["cvg_end_dt"])


# ---------------------------------------------------------------------------------------
# Crosswalk and legislators
# ---------------------------------------------------------------------------------------


@query
def crosswalk_authoritative(spark, d):
    return links(spark, d)


@query
def crosswalk_validate(spark, d):
    return crosswalk.validate_ids(crosswalk.declared_ids(members(spark, d)), candidates(spark, d))


@query
def crosswalk_unverified(spark, d):
    return crosswalk.unverified(members(spark, d), candidates(spark, d))


@query
def crosswalk_name_match(spark, d):
    return crosswalk.name_matches(members(spark, d), candidates(spark, d))


@query
def crosswalk_resolve(spark, d):
    return crosswalk.build_crosswalk(members(spark, d), candidates(spark, d))


@query
def crosswalk_stats(spark, d):
    return crosswalk.crosswalk_stats(
        crosswalk.build_crosswalk(members(spark, d), candidates(spark, d), keep=None))


@query
def crosswalk_expand(spark, d):
    return crosswalk.expand_by_name(links(spark, d), candidates(spark, d))


@query
def expansion_audit(spark, d):
    return crosswalk.audit_expansion(links(spark, d), candidates(spark, d), grown=False)


@query
def crosswalk_overrides(spark, d):
    """Overrides named after the members themselves: suffix holders get a corrected id."""
    people = view(spark, d, "members").select(
        "bioguide_id", F.concat_ws(" ", "first_name", "last_name", "suffix").alias("full_name"))
    table = people.where("full_name LIKE '%Jr'").select(
        F.trim(F.regexp_replace(F.regexp_replace(F.lower("full_name"), "[.,']", " "), " +", " ")).alias("name"),
        F.concat(F.lit("Z"), F.substring("bioguide_id", 2, 9)).alias("bioguide_id"),
        F.col("full_name").alias("display_name"))
    found = people.withColumn("bioguide_id", F.when(F.substring("bioguide_id", 1, 1) > "M", F.col("bioguide_id")))
    return crosswalk.apply_overrides(found, table, "full_name", "bioguide_id")


@query
def expected_pairs_check(spark, d):
    expected = view(spark, d, "member_ids").select("cand_id", "bioguide_id")
    return crosswalk.check_expected(crosswalk.build_crosswalk(members(spark, d), candidates(spark, d)), expected)


@query
def legislators_merge(spark, d):
    """Two overlapping files; the current one carries newer names."""
    everyone = members(spark, d)
    renamed = everyone.withColumn("name", F.col("name").withField("first", F.upper("name.first")))
    current = renamed.where(F.exists("terms", lambda t: t["start"] >= "2000"))
    merged = legislators.merge_legislators(everyone, current)
    return merged.select(F.col("id.bioguide").alias("bioguide_id"), F.col("name.first").alias("first_name"),
                         F.size("terms").cast("bigint").alias("terms"))


@query
def legislator_stats(spark, d):
    return legislators.legislator_stats(members(spark, d))


# ---------------------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------------------


def _checked(spark, d) -> dict[str, DataFrame | None]:
    """Finished tables, one with missing cycles, one without a cycle column, one not there."""
    late = F.when(F.col("cand_ici") == "I", F.col(CYCLE))
    return {
        "by_state": rollup.rollup(txn(spark, d), BY_STATE),
        "candidates": candidates(spark, d),
        "summaries": summaries(spark, d).withColumn(CYCLE, late),
        "members": view(spark, d, "members"),
        "absent": tables.read_table_or_none(spark, scratch(spark, "absent")),
        "none_left": candidates(spark, d).where("cand_id = 'nobody'"),
    }


@query
def table_profile(spark, d):
    return quality.table_profile(txn(spark, d), "txn").drop("issues")


@query
def quality_report(spark, d):
    return quality.quality_report(spark, _checked(spark, d)).withColumn(
        "issues", F.array_join(F.array_sort("issues"), "; "))


@query
def quality_issues(spark, d):
    return quality.quality_issues(quality.quality_report(spark, _checked(spark, d)))


@query
def amount_check(spark, d):
    """Raw amounts in millionths, so that some totals are extreme; net counts, so that some are negative."""
    large = txn(spark, d).withColumn("transaction_amt", (F.col("transaction_amt") * 1000000).cast(MONEY))
    return quality.amount_check(rollup.rollup(large, BY_STATE).withColumn(
        "transaction_count", F.col("transaction_count") - 5))


@query
def key_uniqueness(spark, d):
    return quality.key_uniqueness(committees(spark, d), [CYCLE, "cmte_id"])


@query
def raw_value_audit(spark, d):
    """Amounts as text, some spoilt, some with a third decimal."""
    kind = F.length("sub_id") % 5 + F.substring("sub_id", -1, 1).cast("int")
    text = F.col("transaction_amt").cast("string")
    spoilt = F.when(kind == 0, F.concat(text, F.lit("x"))).when(kind == 1, F.concat(text, F.lit("5"))).otherwise(text)
    rows = txn(spark, d).select(F.coalesce(spoilt, F.lit("")).alias("transaction_amt"))
    return quality.raw_value_audit(rows, OTH.raw_schema)


@query
def raw_width_check(spark, d):
    """Landed lines, some without their last field, some with one more."""
    rows = raw_rows(txn(spark, d), OTH)
    spoilt = DatasetSpec(OTH.name, OTH.prefix, OTH.start_year, ("line",))
    fields = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in OTH.columns])
    line = F.when(F.col("sub_id").endswith("3"), F.regexp_replace(fields, r"\|[^|]*\z", "")).when(
        F.col("sub_id").endswith("4"), F.concat(fields, F.lit("|more"))).otherwise(fields)
    landing = land(spark, rows.select(CYCLE, line.alias("line")), spoilt, "widths")
    found = quality.width_audit(files.read_lines(spark, landing, files.landing_glob(OTH)), len(OTH.columns))
    return found.groupBy(CYCLE).agg(*[F.sum(c).alias(c) for c in ("n_lines", "short_lines", "long_lines")])


def _spoilt_landing(spark, d) -> str:
    """Landed lines, some without their last field, some with one more, some with an amount that is no number.

    The order's number and the whole line are columns of their own: mentioned several times, each would be computed as often, by code
    too large for the JVM to compile."""
    rows = raw_rows(txn(spark, d), OTH).withColumns({
        "transaction_amt": F.col("transaction_amt").cast("string"), "_order": F.regexp_extract("tran_id", "([0-9]+)", 1).cast("bigint")})
    order = F.col("_order")
    spoilt = rows.withColumn("transaction_amt", F.when(order % 9 == 0, F.concat("transaction_amt", F.lit("x"))).otherwise(F.col("transaction_amt")))
    shape = DatasetSpec(OTH.name, OTH.prefix, OTH.start_year, ("line",))
    fields = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in OTH.columns])
    whole = spoilt.select(CYCLE, "_order", fields.alias("_whole"))
    line = F.when(order % 5 == 3, F.regexp_replace("_whole", r"\|[^|]*\z", "")).when(
        order % 5 == 4, F.concat("_whole", F.lit("|more"))).otherwise(F.col("_whole"))
    return land(spark, whole.select(CYCLE, line.alias("line")), shape, "spoilt")


@query
def rejected_lines(spark, d):
    """What a load rejects, with its reasons; a number per line is checked by the lines' count."""
    stored = lines.store(spark, _spoilt_landing(spark, d), OTH, scratch(spark, "lines"))
    rejected = tables.read_table(spark, stored.rejected)
    cells = F.split("line", "[|]", -1)
    return rejected.select(
        CYCLE, F.get(cells, F.lit(16)).alias("tran_id"), F.get(cells, F.lit(14)).alias("amount"), F.get(cells, F.lit(13)).alias("transaction_dt"),
        F.array_join("reasons", ", ").alias("reason"))


@query
def accepted_lines(spark, d):
    """The typed rows of the same load."""
    stored = lines.store(spark, _spoilt_landing(spark, d), OTH, scratch(spark, "lines"))
    return tables.read_table(spark, stored.rows).select(CYCLE, "cmte_id", "sub_id", "name", "transaction_dt", "transaction_amt")


@query
def rejected_line_counts(spark, d):
    """Per cycle and reason."""
    stored = lines.store(spark, _spoilt_landing(spark, d), OTH, scratch(spark, "lines"))
    return lines.summary(tables.read_table(spark, stored.rejected))


@query
def required_nulls(spark, d):
    return quality.required_nulls(txn(spark, d), ["cmte_id", "transaction_amt", "name", "memo_cd"])


@query
def out_of_range(spark, d):
    """Transactions dated outside the first year of their cycle."""
    rows = txn(spark, d).select(CYCLE, "sub_id", "transaction_dt", fx.transaction_year("transaction_dt").alias("transaction_year"))
    first = F.col(CYCLE) - 1
    return quality.out_of_range(rows, "transaction_year", first, first)


@query
def report_tables_load(spark, d):
    """Store the finished tables, load all eight reporting tables, read them back."""
    root, target = _finished(spark, d), scratch(spark, "reporting")
    jobs.load_report_tables(spark, root, target, on_violation="report")
    out = None
    for name, spec in report_tables.REPORT_TABLES.items():
        loaded = tables.read_table(spark, f"{target}/{name}")
        total = next((c for c in ("total_amount", "ttl_receipts") if c in loaded.columns), None)
        part = loaded.agg(F.count(F.lit(1)).alias("row_count"), (F.sum(total) if total else F.lit(None)).cast("double").alias("total"))
        part = part.select(F.lit(name).alias("table_name"), "row_count", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query
def report_key_violations(spark, d):
    return jobs.load_report_tables(spark, _finished(spark, d), scratch(spark, "reporting"))


def _row_text(df: DataFrame, name: str) -> DataFrame:
    """(table_name, row): whole rows as text, numbers with two decimals."""
    kinds = dict(df.dtypes)
    cells = [F.coalesce((F.col(c).cast("decimal(30,2)") if kinds[c] == "double" else F.col(c)).cast("string"), F.lit("-")) for c in df.columns]
    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("row"))


@query
def report_tables_rows(spark, d):
    """Every row of every reporting table after a load."""
    root, target = _finished(spark, d), scratch(spark, "reporting")
    jobs.load_report_tables(spark, root, target, on_violation="report")
    out = None
    for name in report_tables.REPORT_TABLES:
        part = _row_text(tables.read_table(spark, f"{target}/{name}"), name)
        out = part if out is None else out.unionByName(part)
    return out


def _later_committees(spark, d, spoilt_cycle: int) -> DataFrame:
    """Committees with one row a key, but for one cycle, where keys repeat as in the given tables."""
    once = committees(spark, d).groupBy(CYCLE, "cmte_id").agg(F.min("cand_id").alias("cand_id"))
    again = committees(spark, d).where(F.col(CYCLE) == spoilt_cycle).select(CYCLE, "cmte_id", "cand_id")
    return raw_rows(once.where(F.col(CYCLE) != spoilt_cycle).unionByName(again), SPECS["committee_registrations"])


def _loads(spark, d, on_violation: str) -> DataFrame:
    """A load without violations, then one with: what is published and what is rejected."""
    path, name = f"{scratch(spark, 'loads')}/fec_committees", "fec_committees"
    report_tables.load_table(_later_committees(spark, d, 0), name, path)
    later = _later_committees(spark, d, OPEN_CYCLE - 4).withColumn("cand_id", F.concat(F.lit("+"), "cand_id"))
    report_tables.load_table(later, name, path, on_violation=on_violation)
    shape = lambda df, state, why: df.select(F.lit(state).alias("state"), "cmte_id", "year", "cand_id", why.alias("reason"))
    return shape(tables.read_table(spark, path), "published", F.lit(None).cast("string")).unionByName(
        shape(tables.read_table(spark, f"{path}.rejected"), "rejected", F.array_join("reasons", ", ")))


@query
def report_load_held(spark, d):
    """A load with repeated keys is not published: the table stays, the rows are listed."""
    return _loads(spark, d, "hold")


@query
def report_load_diverted(spark, d):
    """The rows that hold are published, the others listed."""
    return _loads(spark, d, "divert")


@query
def report_load_unreadable(spark, d):
    """Summaries as text, some amounts spoilt, some ids missing: the reasons, and what is published of the others."""
    path = f"{scratch(spark, 'unreadable')}/fec_candidate_summaries"
    digit = F.substring("cand_id", -1, 1)
    text = raw_rows(summaries(spark, d), SPECS["all_candidate_summaries"])
    spoilt = text.withColumns({
        "ttl_receipts": F.when(digit == "3", "n/a").when(digit == "4", " ").otherwise(F.col("ttl_receipts").cast("string")),
        "cand_id": F.when(digit == "5", F.lit(None)).otherwise(F.col("cand_id"))})
    report_tables.load_table(spoilt, "fec_candidate_summaries", path, on_violation="divert")
    kept = tables.read_table(spark, path).select("cand_id", "year", F.lit(None).cast("string").alias("reason"), "ttl_receipts")
    gone = tables.read_table(spark, f"{path}.rejected").select("cand_id", "year", F.array_join("reasons", ", ").alias("reason"), "ttl_receipts")
    return kept.unionByName(gone)


def _finished(spark, d) -> str:
    """A folder of finished tables, one for each source of a reporting table."""
    root = scratch(spark, "finished")
    made = {
        "cand_id_bioguide_crosswalk": links(spark, d),
        "all_candidate_summaries": raw_rows(summaries(spark, d), SPECS["all_candidate_summaries"]),
        "committee_registrations": raw_rows(committees(spark, d), SPECS["committee_registrations"]),
    }
    itemized = (PAS2, OTH, BY_CATEGORY, BY_STATE)

    def write(name: str, df: DataFrame) -> Callable[[], None]:
        return lambda: tables.write_table(df, f"{root}/{name}")

    def prepared() -> rollup.Prepared:
        shared = scratch(spark, "prepared")
        return rollup.prepare(txn(spark, d), list(itemized), lambda df, name: tables.stored(df, f"{shared}/{name}"))

    rows = refresh.side_by_side(spark, {"prepared": prepared, **{n: write(n, df) for n, df in made.items()}})["prepared"]
    registered = tables.read_table(spark, f"{root}/committee_registrations")
    pacs = registered.where("cmte_tp IN ('N', 'Q', 'O')").groupBy(CYCLE, "cmte_id").agg(F.max("cmte_nm").alias("cmte_nm"), F.max("cmte_tp").alias("cmte_tp"))
    made = {s.name: rollup.rollup(rows, s) for s in itemized} | {"pac_party_summaries": raw_rows(pacs, SPECS["pac_party_summaries"])}
    refresh.side_by_side(spark, {n: write(n, df) for n, df in made.items()})
    return root


# ---------------------------------------------------------------------------------------
# Refresh
# ---------------------------------------------------------------------------------------


@query
def manifest_diff(spark, d):
    return manifest.manifest_diff(view(spark, d, "manifest_old"), view(spark, d, "manifest_new"), changed_only=False)


@query
def manifest_force(spark, d):
    known = view(spark, d, "manifest_new").groupBy("dataset").agg(F.min("cycle").alias("first"))
    started = known.select("dataset", (F.col("first") + F.length("dataset") - 6).cast("int").alias("start_year"))
    lookback = [OPEN_CYCLE - 4, OPEN_CYCLE - 2, OPEN_CYCLE]
    return manifest.forced_changes(started, lookback).select("dataset", "cycle", "reason")


def _both_spending(spark, root):
    category, state = (tables.read_table(spark, f"{root}/{s.name}") for s in (BY_CATEGORY, BY_STATE))
    return category.unionByName(state, allowMissingColumns=True)


@query
def apply_changes(spark, d):
    """Land the itemized files, apply every change, read both rebuilt tables back."""
    landing = land(spark, raw_rows(txn(spark, d), BY_STATE), BY_CATEGORY, "apply")
    root = scratch(spark, "applied")
    changes = txn(spark, d).groupBy(F.col(CYCLE).alias("cycle")).agg(F.count(F.lit(1)).alias("content_length")).select(
        F.lit("expenditures_by_category").alias("dataset"), "cycle", F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), "content_length")
    refresh.apply_changes(spark, changes, landing, root, f"{root}/manifest")
    state = refresh.read_manifest(spark, f"{root}/manifest").select(F.col("cycle").alias(CYCLE), "content_length")
    return _both_spending(spark, root).join(state, CYCLE)


@query
def refresh_figures(spark, d):
    """What a refresh tells about itself: the exclusion audit and the quality figures, counted while it writes."""
    landing = land(spark, raw_rows(txn(spark, d), BY_STATE), BY_CATEGORY, "figures")
    root = scratch(spark, "figures")
    changes = txn(spark, d).groupBy(F.col(CYCLE).alias("cycle")).agg(F.count(F.lit(1)).alias("content_length")).select(
        F.lit("expenditures_by_category").alias("dataset"), "cycle", F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), "content_length")
    return refresh.apply_changes(spark, changes, landing, root, f"{root}/manifest").drop("error", "dataset")


@query
def refresh_preview(spark, d):
    """Dry run: rows and the first finished row of each cycle."""
    landing = land(spark, raw_rows(txn(spark, d), BY_STATE), BY_CATEGORY, "preview")
    cycles = sorted(r[0] for r in txn(spark, d).select(CYCLE).distinct().collect())
    shown = refresh.preview(spark, BY_CATEGORY.name, cycles, landing, sample=1)
    first = F.from_json(shown["sample"][0], "cmte_id string, category string, transaction_year int")
    return shown.select("cycle", "row_count", first.alias("f")).select("cycle", "row_count", "f.cmte_id", "f.category", "f.transaction_year")


@query
def scan_text_csv(spark, d):
    """A CSV file read by its header with every column as text, columns in another order than asked."""
    out = scratch(spark, "text_csv")
    tables.export_csv(txn(spark, d).select("sub_id", "memo_text", "transaction_amt", CYCLE, "name"), out)
    return files.read_text_csv(spark, out, [CYCLE, "name", "memo_text", "transaction_amt", "sub_id"])


@query
def refresh_status(spark, d):
    return manifest.refresh_status(view(spark, d, "manifest_old"))


@query
def stream_cycle_ingest(spark, d):
    landing = land(spark, raw_rows(txn(spark, d), OTH), OTH, "stream")
    root = scratch(spark, "streamed")
    ingest.cycle_ingest(spark, landing, OTH, f"{root}/table", f"{root}/state").awaitTermination()
    return tables.read_table(spark, f"{root}/table")


@query
def stream_redelivery(spark, d):
    """Everything is delivered with double amounts first; the cycles from 1996 on are delivered again under their
    names as they are, and the same stream goes on."""
    rows = raw_rows(txn(spark, d), BY_STATE)
    first = rows.withColumn("transaction_amt", (F.col("transaction_amt") * 2).cast(MONEY))
    landing = land(spark, first, BY_STATE, "stream3")
    root = scratch(spark, "streamed3")
    run = lambda: ingest.cycle_ingest(spark, landing, BY_STATE, f"{root}/table", f"{root}/state").awaitTermination()
    run()
    land(spark, rows.where(f"{CYCLE} >= 1996"), BY_STATE, "stream3", again=landing)
    run()
    return tables.read_table(spark, f"{root}/table")


@query
def stream_two_tables(spark, d):
    """New files of a family rebuild every table made of them."""
    landing = land(spark, raw_rows(txn(spark, d), BY_CATEGORY), BY_CATEGORY, "stream2")
    root = scratch(spark, "streamed2")
    ingest.cycle_ingest(spark, landing, BY_CATEGORY, f"{root}/{BY_CATEGORY.name}", f"{root}/state").awaitTermination()
    return _both_spending(spark, root)


# ---------------------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------------------


@query
def member_summary(spark, d):
    return reports.member_summary(summaries(spark, d), links(spark, d))


@query
def top_committees(spark, d):
    return reports.top_committees(rollup.rollup(txn(spark, d), PAS2), links(spark, d))


@query
def expenditure_breakdown(spark, d):
    return reports.expenditure_breakdown(
        rollup.rollup(txn(spark, d), BY_CATEGORY), committees(spark, d), links(spark, d))


@query
def committee_received(spark, d):
    return reports.committee_received(rollup.rollup(txn(spark, d), OTH))


@query
def committee_given(spark, d):
    return reports.committee_given(rollup.rollup(txn(spark, d), PAS2), summaries(spark, d), links(spark, d))


@query
def committee_search(spark, d):
    return reports.committee_search(committees(spark, d), "pac", k=5)


SEARCHED = ("pac", "ommit_ee", "c%1", "pa", "")


@query
def committee_search_indexed(spark, d):
    """Searches over an index of trigrams, with wildcards and texts that have no trigram."""
    path = scratch(spark, "names")
    name_index.write_index(committees(spark, d), path)
    return reduce(DataFrame.unionAll, [
        name_index.indexed_search(spark, path, text, 200).withColumn("asked", F.lit(text)) for text in SEARCHED])


@query
def large_contributions(spark, d):
    return reports.large_contributions(rollup.rollup(txn(spark, d), PAS2), summaries(spark, d), 100000)


@query
def individual_totals(spark, d):
    return reports.individual_totals(individual_rollup(spark, d))


@query
def monthly_trend(spark, d):
    return reports.monthly_trend(individual_rollup(spark, d), OPEN_CYCLE)


@query
def served_candidates(spark, d):
    return reports.served_candidates(candidates(spark, d), links(spark, d)).select(
        "cand_id", CYCLE, "cand_name", "bioguide_id")


@query
def served_candidate_count(spark, d):
    return reports.count_served(candidates(spark, d), links(spark, d))


@query
def fundraising_over_time(spark, d):
    return reports.fundraising_over_time(summaries(spark, d))


@query
def funders_of_candidates(spark, d):
    return reports.funders_of_candidates(rollup.rollup(txn(spark, d), PAS2))


@query
def flow_between_committees(spark, d):
    return reports.flow_between_committees(rollup.rollup(txn(spark, d), OTH))


@query
def spend_by_state(spark, d):
    return reports.spend_by_state(rollup.rollup(txn(spark, d), BY_STATE))


@query
def spend_by_category(spark, d):
    return reports.spend_by_category(rollup.rollup(txn(spark, d), BY_CATEGORY))


# ---------------------------------------------------------------------------------------
# The same reports, called from SQL
# ---------------------------------------------------------------------------------------

# Views of the stored tables that a report may need.
_STORED = {
    "all_candidate_summaries": summaries, "cand_id_bioguide_crosswalk": links, "candidate_registrations": candidates,
    "committee_registrations": committees, PAS2.name: lambda spark, d: rollup.rollup(txn(spark, d), PAS2),
    OTH.name: lambda spark, d: rollup.rollup(txn(spark, d), OTH), BY_CATEGORY.name: lambda spark, d: rollup.rollup(txn(spark, d), BY_CATEGORY),
    BY_STATE.name: lambda spark, d: rollup.rollup(txn(spark, d), BY_STATE), jobs.INDIVIDUAL_TOTALS: individual_rollup,
}
_CALLS = {"committee_search": "'pac', 5", "large_contributions": "100000D", "monthly_trend": str(OPEN_CYCLE)}


def _sql_report(name: str) -> Query:
    def run(spark, d):
        report_sql.register_views({table: _STORED[table](spark, d) for table in report_sql.needed(name)})
        return spark.sql(f"SELECT * FROM {name}({_CALLS.get(name, '')})")

    run.__name__ = f"sql_{name}"
    return run


for _name in report_sql.FUNCTIONS:
    query(_sql_report(_name))
