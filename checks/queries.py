"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlab.functions import calendar, coerce, dates, numbers, terms, text
from martlab.functions.sqlfuncs import register_sql_functions
from martlab.operators import changes as ch
from martlab.operators import freshness as fr
from martlab.operators import intervals as iv
from martlab.operators import membership as mb
from martlab.operators import narrow
from martlab.operators import quality as q
from martlab.operators import record_filters as rf
from martlab.operators import snapshots as sn
from martlab.operators import stored, text_index
from martlab.operators.filter_tree import filter_tree
from martlab.operators.positions import Ordered
from martlab.plans import dashboard, loans, risk, workforce
from martlab.session import shared_folder, tune
from martlab.sources.files import read_seed
from martlab.sources.jdbc import read_catalog_query
from martlab.sources.tables import export_files, materialize, read_table, write_table
from martlab.sources.versioned import VersionedTable
from martlab.sources.workbook import workbook_rows

from .shapes import AS_OF, CHECK_DATE, EARLIER, PRODUCTIVE, Tables
from .workbooks import workbook_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Tables(tune(spark), folder))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- loan marts -------------------------------------------------------------------------------------------------------


def _matched(t: Tables, **how) -> DataFrame:
    segment = loans.segment_loans(loans.stage_core_loans(t.core_loans()), loans.stage_ncino_loans(t.ncino_loans()), AS_OF)
    return loans.match_collateral(segment, loans.stage_collaterals(t.core_collaterals(), t.xref()), AS_OF, **how)


def _stress_input(t: Tables) -> DataFrame:
    return loans.stress_test_input(_matched(t), AS_OF).drop("dbt_loaded_at")


def _discovery(t: Tables) -> DataFrame:
    return loans.filter_discovery(loans.stage_core_loans(t.core_loans()), t.march_set(), t.december_set(), [AS_OF, EARLIER])


@query
def stress_test_input(t):
    return _stress_input(t)


@query
def stg_core_loans(t):
    return loans.stage_core_loans(t.core_loans())


@query
def stg_ncino_loans(t):
    return loans.stage_ncino_loans(t.ncino_loans())


@query
def stg_collaterals(t):
    return loans.stage_collaterals(t.core_collaterals(), t.xref())


@query
def cre_noo_loans(t):
    return loans.segment_loans(loans.stage_core_loans(t.core_loans()), loans.stage_ncino_loans(t.ncino_loans()), AS_OF)


@query
def loan_collateral_match(t):
    return _matched(t)


@query
def collateral_rollup(t):
    return _matched(t, mode="aggregate")


@query
def data_quality_summary(t):
    return loans.data_quality_summary(_stress_input(t))


@query
def match_rate_by(t):
    return loans.match_rate_by(_stress_input(t), ["branch_code", "loan_officer_id"])


@query
def filter_discovery(t):
    return _discovery(t).select("loan_id", "as_of_date", "in_march_input", "in_dec_input", "in_either_input", "in_both_inputs", "input_membership")


@query
def filter_pattern_analysis(t):
    return loans.filter_pattern_analysis(_discovery(t), loans.stage_core_loans(t.core_loans()), t.december_set(), AS_OF)


@query
def loans_as_of(t):
    """Each loan as it was known at three report dates between and after the snapshots."""
    found = sn.snapshots_at(loans.stage_core_loans(t.core_loans()), ["loan_id"], "as_of_date", ["2000-10-15", "2000-11-15", "2001-01-15"])
    return found.select("period", "loan_id", "as_of_date", "loan_status", "outstanding_balance")


@query
def period_diff(t):
    core = loans.stage_core_loans(t.core_loans()).select(
        "loan_id", "as_of_date", "loan_status", F.format_string("%.2f", "outstanding_balance").alias("outstanding_balance"))
    return sn.period_diff(core, ["loan_id"], "as_of_date", [EARLIER, AS_OF], ["loan_status", "outstanding_balance"])


@query
def match_rates_over_time(t):
    staged = loans.stage_collaterals(t.core_collaterals(), t.xref())
    return loans.match_rates_over_time(loans.stage_core_loans(t.core_loans()), staged, [EARLIER, AS_OF], ["branch_code"])


@query
def check_collateral_match(t):
    return q.check_rate(_stress_input(t), "has_collateral_match")


@query
def mart_parity(t):
    """The mart itself against the hand-made set."""
    mart = _stress_input(t).select("loan_id", "loan_number").distinct()
    return mb.key_parity(mart, t.december_set(), "loan_id", ["loan_id", "loan_number"], ours_name="dbt", theirs_name="manual")


@query
def other_segments(t):
    """The alternative segment filters, by occupancy code and by owner flag; the types are those of the given tables."""
    core, phases = loans.stage_core_loans(t.core_loans()), loans.stage_ncino_loans(t.ncino_loans())
    types = {"col": "loan_type_code", "op": "in", "value": ["1-URGENT", "2-HIGH"]}
    parts = []
    for name in ("occupancy", "owner_flag"):
        tree = {"and": [loans.SEGMENTS[name]["and"][0], types]}
        parts.append(loans.segment_loans(core, phases, AS_OF, segment=tree).select(F.lit(name).alias("segment"), "loan_id", "loan_phase"))
    return parts[0].unionByName(parts[1])


@query
def sample_mart(t):
    core = t.core_loans().select("loan_id", F.col("product_type").alias("loan_type"), "outstanding_balance")
    values = t.xref().join(t.core_collaterals(), "collateral_id").select("loan_id", F.col("appraised_value").alias("collateral_value"))
    return loans.sample_mart(core, values, "ARC")


@query
def remaining_terms(t):
    core = loans.stage_core_loans(t.core_loans())
    return core.select("loan_id", *[c.alias(n) for n, c in terms.remaining_terms(AS_OF, origination="origination_date").items()])


@query
def key_parity(t):
    return mb.key_parity(t.march_set(), t.december_set(), "loan_id", ["loan_id", "loan_number"], ours_name="dbt", theirs_name="manual")


@query
def missing_keys(t):
    return mb.missing_keys(t.december_set(), t.core_loans(), "loan_id")


@query
def keys_in_lookup(t):
    return mb.keep_in_lookup(t.core_loans().select("loan_id", "loan_number"), t.december_set(), "loan_id")


@query
def dataset_diff(t):
    return ch.dataset_diff(t.march_set().withColumn("v", F.col("loan_id") % 10),
                           t.december_set().withColumn("v", F.col("loan_id") % 20), "loan_id")


@query
def narrowed_parity(t):
    return narrow.narrowed_parity(t.march_set(), t.december_set(), "loan_id", ["loan_id", "loan_number"], ours_name="dbt", theirs_name="manual")


@query
def narrowed_diff(t):
    return narrow.narrowed_diff(t.march_set().withColumn("v", F.col("loan_id") % 10),
                                t.december_set().withColumn("v", F.col("loan_id") % 20), "loan_id")


@query
def filter_pattern_positions(t):
    """The report with the place of each row in its output order."""
    report = loans.filter_pattern_analysis(_discovery(t), loans.stage_core_loans(t.core_loans()), t.december_set(), AS_OF)
    order = [F.col("filter_field").asc(), F.col("dec_input_count").desc(), F.col("field_value").asc()]
    return Ordered(report.select("filter_field", "field_value", "dec_input_count"), *order).rows()


# --- addresses, text, dates -------------------------------------------------------------------------------------------


def _flags(t: Tables, **how) -> DataFrame:
    return t.addresses().select("p_partkey", *[c.alias(n) for n, c in text.address_flags("street", "zip", **how).items()])


@query
def address_flags_basic(t):
    return _flags(t)


@query
def address_flags_extended(t):
    return _flags(t, profile="extended", ignore_case=True)


@query
def address_flags_loose(t):
    return _flags(t, profile="loose", state="state")


@query
def normalize_state(t):
    return t.addresses().select("p_partkey", text.normalize_state("state").alias("state_code"), text.zip5("zip").alias("zip5"))


@query
def hhmmss(t):
    seconds = F.col("value") * 1000 - 20000
    return t.given("events").select("event_id", dates.hhmmss(seconds).alias("clock"),
                                    dates.month_diff(F.to_date("ts"), F.lit("2025-03-01").cast("date")).alias("months"))


@query
def holiday_calendar(t):
    return calendar.federal_holidays(t.given("orders").select(F.year("o_orderdate").alias("Year")))


@query
def calendar_flags(t):
    return t.given("orders").select("o_orderkey", *[c.alias(n) for n, c in calendar.calendar_flags(F.to_date("o_orderdate")).items()])


@query
def sql_functions(t):
    register_sql_functions(t.spark)
    t.given("orders").createOrReplaceTempView("sql_functions_orders")
    return t.spark.sql(
        "SELECT o_orderkey, hhmmss(o_totalprice) AS clock, month_diff(DATE(o_orderdate), DATE '2000-12-31') AS months, "
        "safe_pct(o_orderkey % 7, o_orderkey % 3) AS share FROM sql_functions_orders"
    )


@query
def coerce_date(t):
    return coerce.coerce_columns(t.raw_text(), {"raw": "date"})


@query
def coerce_timestamp(t):
    return coerce.coerce_columns(t.raw_text(), {"raw": "datetime"})


@query
def coerce_int(t):
    return coerce.coerce_columns(t.raw_text(), {"raw": int}, fractional="null")


@query
def coerce_float(t):
    return coerce.coerce_columns(t.raw_text(), {"raw": "Float64"})


@query
def coerce_bool(t):
    return coerce.coerce_columns(t.raw_text(), {"raw": bool, "p_partkey": "int32"})


# --- filter tree ------------------------------------------------------------------------------------------------------


def _tree(name: str, tree: dict, **how) -> None:
    def run(t: Tables) -> DataFrame:
        columns = ["loan_id", "call_report_code", "occupancy_type_code", "loan_status", "maturity_date", "outstanding_balance"]
        return filter_tree(loans.stage_core_loans(t.core_loans()), tree, **how).select(*columns)

    run.__name__ = f"filter_tree_{name}"
    query(run)


_tree("compare", {"and": [{"col": "outstanding_balance", "op": ">=", "value": 100000},
                          {"col": "original_amortization_term_months", "op": "!=", "value": 84},
                          {"col": "loan_status", "op": "!=", "value": "PAID_OFF"}]})
_tree("null", {"or": [{"col": "maturity_date", "op": "is_null"},
                      {"and": [{"col": "io_end_date", "op": "notnull"}, {"col": "occupancy_type_code", "op": "isnull"}]}]})
_tree("in", {"AND": [{"col": "call_report_code", "op": "in", "value": ["1-a", None]},
                     {"col": "product_type", "op": "not_in", "value": ["ARC"]},
                     {"col": "loan_status", "op": "notin", "value": "PAID_OFF"}]})
_tree("between", {"and": [{"col": "outstanding_balance", "op": "between", "value": [50000, 150000]},
                          {"col": "maturity_date", "op": "between", "value": ["1999-01-01", "2000-12-31"]}]})
_tree("text", {"and": [{"col": "loan_type_code", "op": "contains", "value": "URGENT"},
                       {"col": "branch_code", "op": "not_contains", "value": "5"},
                       {"col": "loan_number", "op": "startswith", "value": "LN-1"},
                       {"col": "loan_id", "op": "endswith", "value": 7}]})
_tree("not", {"not": [{"col": "call_report_code", "op": "==", "value": "1-a"},
                      {"col": "outstanding_balance", "op": ">", "value": 60000},
                      {"not": {"col": "maturity_date", "op": "<", "value": "2000-06-30"}}]})
_tree("fold", {"not": {"or": [{"col": "loan_status", "op": "==", "value": "active"},
                              {"col": "occupancy_type_code", "op": "!=", "value": "noo"}]}}, case_insensitive=True)
_tree("nested", {"or": [{"and": [{"col": "outstanding_balance", "op": "<", "value": 120000},
                                 {"col": "occupancy_type_code", "op": "in", "value": ["NOO", "OO"]}]},
                        {"not": {"col": "loan_status", "op": "contains", "value": "act"}}]}, case_insensitive=True)


# --- workforce --------------------------------------------------------------------------------------------------------


@query
def event_intervals(t):
    return iv.close_events(t.log(), ["payroll"], "tstamp", then_by=["newstatus"]).select(
        "payroll", iv.DAY, iv.START, iv.END, "newstatus"
    )


def _windows(t: Tables) -> DataFrame:
    return workforce.roster_days(t.roster()).select(
        "payroll", "work_date", F.col("roster_start").alias("window_start"), F.col("roster_finish").alias("window_end")
    )


@query
def clip_to_window(t):
    closed = iv.close_events(t.log(), ["payroll"], "tstamp", then_by=["newstatus"])
    return iv.clip_to_window(closed, _windows(t), ["payroll", "work_date"]).select(
        "payroll", "work_date", "newstatus", "clipped_start", "clipped_end"
    )


def _overlap(t: Tables) -> DataFrame:
    left = t.leave().select("payroll", F.to_date("start").alias("work_date"), "start", "stop")
    shared = iv.overlap_micros(
        left, workforce.break_intervals(t.breaks(), only_breaks=False), ["payroll", "work_date"], start="start", end="stop",
        right_start="break_start", right_end="break_end",
    )
    return shared.withColumn("overlap_seconds", F.col("overlap_us") / 1e6).drop("overlap_us")


@query
def overlap_seconds(t):
    return _overlap(t)


@query
def overlap_running_sum(t):
    return _overlap(t)


@query
def duration_by_day(t):
    summed = iv.duration_by_day(t.breaks().where(F.col("break") == 1), ["roster_key", "person"], "from", "to")
    return summed.select("roster_key", "person", "work_date", dates.hours_from_micros(F.col("duration_us")).alias("break_hours"))


@query
def productive_intervals(t):
    return workforce.productive_intervals(t.log(), t.roster(), t.breaks())


@query
def adherence_daily(t):
    return workforce.adherence_daily(t.log(), t.roster(), t.breaks(), t.personnel(), productive=PRODUCTIVE)


@query
def absenteeism_daily(t):
    return workforce.absenteeism_daily(t.roster(), t.breaks(), t.leave(), t.partial_leave(), t.personnel())


@query
def absenteeism_by_type(t):
    return workforce.absenteeism_by_type(t.roster(), t.breaks(), t.leave(), t.partial_leave(), t.personnel())


# --- records ----------------------------------------------------------------------------------------------------------


def _rounded_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_value", F.round("avg_value", 6))


@query
def month_trend(t):
    return _rounded_mean(dashboard.month_trend(t.records()))


@query
def item_breakdown(t):
    return _rounded_mean(dashboard.item_breakdown(rf.filter_records(t.records(), "1-URGENT", "6")))


@query
def top_items(t):
    return _rounded_mean(dashboard.top_items(t.records()))


@query
def acceptance_by_category(t):
    return dashboard.acceptance_by_category(t.records())


@query
def review_grid(t):
    return dashboard.review_grid(t.records())


@query
def filter_records(t):
    return rf.filter_records(t.records(), "5-LOW", 3)


@query
def record_choices(t):
    months = rf.distinct_values(t.records(), "month").select(F.lit("month").alias("field"), F.col("month").cast("string").alias("choice"))
    kinds = rf.distinct_values(t.records(), "category").select(F.lit("category").alias("field"), F.col("category").alias("choice"))
    return months.unionByName(kinds)


GRID_FILTERS = {
    "category": {"mode": "set", "allowed": ["1-URGENT", "2-HIGH"]},
    "value_text": {"mode": "range", "min": 20000, "max": 300000},
    "month": {"mode": "range", "min": 3, "max": None},
    "item": None,
}


@query
def column_filters(t):
    return rf.apply_column_filters(dashboard.review_grid(t.records()), GRID_FILTERS)


@query
def facet_values(t):
    return rf.facet_values(dashboard.review_grid(t.records()), GRID_FILTERS, "category")


@query
def record_search(t):
    found = [rf.search_records(t.records(), term).withColumn("term", F.lit(term)) for term in ("urgent", "123", "furn")]
    every = reduce(DataFrame.unionByName, found)
    return every.withColumn("parsed_id", rf.suggestion_id("suggestion"))


@query
def all_facets(t):
    return rf.all_facets(dashboard.review_grid(t.records()), GRID_FILTERS, ["category", "month", "item"])


@query
def indexed_search(t):
    """The same search by postings; the last term is too short for them."""
    database, _ = _scratch(t)
    rows = t.records()
    text_index.build_index(rows, f"{database}.pieces", ["category", "item"])
    found = [text_index.indexed_search(rows, f"{database}.pieces", ["category", "item"], term).withColumn("term", F.lit(term))
             for term in ("urgent", "FURN", "h%n_ry", "5-")]
    return reduce(DataFrame.unionByName, found).select("term", "id", "category", "item")


def _sorted_grid(t: Tables) -> Ordered:
    grid = dashboard.review_grid(t.records())
    return Ordered(grid, rf.sort_order(grid, "value_text", kind="num", ascending=False), F.col("id"))


@query
def typed_sort_positions(t):
    return _sorted_grid(t).rows().select("id", "value_text", "position")


@query
def grid_page(t):
    return _sorted_grid(t).page(101, 50)


@query
def record_lookup(t):
    return rf.get_record(t.records(), 77)


@query
def typed_sort(t):
    return rf.typed_sort(dashboard.review_grid(t.records()), "value_text", kind="num", ascending=False, then="id")


@query
def apply_changes(t):
    return ch.apply_changes(t.records(), t.changes())


@query
def rejected_changes(t):
    broken = t.changes().withColumn("new_value", F.when(F.col("seq") % 50 == 0, "13").otherwise(F.col("new_value")))
    return ch.rejected_changes(broken)


def _risky_changes(t: Tables) -> DataFrame:
    """The changes, some of which break a record rule."""
    bad = F.when(F.col("field") == "month", "13").when(F.col("field") == "accepted", "7").otherwise("  ")
    return t.changes().withColumn("new_value", F.when(F.col("seq") % 7 == 0, bad).otherwise(F.col("new_value")))


@query
def apply_checked_changes(t):
    return ch.apply_changes(t.records(), _risky_changes(t))


@query
def edit_stored_records(t):
    """A stored table after a batch of edits, with whether the partitions without an edited record kept their files."""
    database, _ = _scratch(t)
    name = f"{database}.records"
    stored.store_records(t.records(), name, rows_per_part=400)
    # what the batch will touch: ids below 1,000, so the first partitions
    changes = _risky_changes(t)
    touched = [r["p"] for r in changes.select(F.floor(F.col("id") / 400).cast("long").alias("p")).distinct().collect()]
    before = stored.file_digest(t.spark, name, but=touched)
    parts, refused = stored.edit_records(t.spark, name, changes)
    same = stored.file_digest(t.spark, name, but=touched) == before and set(parts) <= set(touched)
    edited = read_table(t.spark, "records", database).drop(stored.PART)
    return edited.withColumns({"others_untouched": F.lit(same), "refused": F.lit(refused.count()).cast("long")})


@query
def toggle_accepted(t):
    return ch.toggle_flag(t.records(), t.changes())


# --- checks, freshness, sources ---------------------------------------------------------------------------------------


@query
def check_not_null(t):
    return q.check_not_null(loans.stage_core_loans(t.core_loans()), "maturity_date").select("loan_id", "loan_number")


@query
def check_unique(t):
    return q.check_unique(t.given("lineitem"), "l_orderkey")


@query
def check_accepted(t):
    return q.check_accepted(t.core_loans(), "loan_type_code", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query
def check_predicate(t):
    return q.check_predicate(t.records(), F.expr("month BETWEEN 1 AND 11 AND trim(item) <> 'FURNITURE'"))


@query
def check_match_rate(t):
    return q.check_rate(_stress_input(t), "has_complete_collateral_data")


@query
def run_checks(t):
    return q.run_checks(
        loans.stage_core_loans(t.core_loans()),
        not_null=["loan_id", "maturity_date"],
        unique=["loan_id", "loan_officer_id"],
        accepted={"loan_status": ["ACTIVE"]},
        rules={"positive": F.col("outstanding_balance") > 0, "short": "original_amortization_term_months < 200"},
    )


def _sources(t: Tables) -> dict:
    return {
        "orders": (t.given("orders"), "o_orderdate"),
        "lineitem": (t.given("lineitem"), "l_shipdate"),
        "events": (t.given("events"), "ts"),
    }


def _run_log(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "SUCCESS").when(F.col("event_type") == "error", "ERROR").otherwise("SKIPPED_SOURCES")
    return t.given("events").select(F.col("event_id").alias("log_id"), F.col("ts").cast("timestamp").alias("run_timestamp"),
                                    status.alias("status"))


@query
def source_freshness(t):
    return fr.source_freshness(_sources(t), CHECK_DATE)


@query
def sources_ready(t):
    ready = fr.sources_ready(fr.source_freshness(_sources(t), CHECK_DATE))
    flags = fr.all_true(t.given("orders").select((F.col("o_totalprice") > 0).alias("ok")), "ok")
    none = F.lit(None).cast("long")
    return ready.withColumn("what", F.lit("sources")).unionByName(flags.select(
        none.alias("total_sources"), none.alias("ready_sources"), F.col("all_true").alias("sources_ready"), F.lit("prices").alias("what")
    ))


@query
def run_decision(t):
    fresh = {"events": _sources(t)["events"]}
    log, quiet = _run_log(t), _run_log(t).where(F.col("status") != "SUCCESS")
    rows = [
        fr.run_decision(log, fr.source_freshness(fresh, CHECK_DATE), CHECK_DATE, "2024-01-30 12:00:00"),
        fr.run_decision(log, fr.source_freshness(_sources(t), "2024-02-15"), "2024-02-15", "2024-02-15 12:00:00"),
        fr.run_decision(quiet, fr.source_freshness(fresh, CHECK_DATE), CHECK_DATE, "2024-01-30 13:00:00"),
    ]
    every = reduce(DataFrame.unionByName, rows)
    return every.withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


@query
def last_runs(t):
    return fr.last_runs(_run_log(t)).withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


@query
def control_flag(t):
    control = t.given("customer").select(F.col("c_name").alias("task_name"), (F.col("c_nationkey") == 0).alias("has_run"),
                                         F.lit(None).cast("timestamp_ntz").alias("ran_at"))
    stamp = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return fr.set_control_flag(control, "Customer#000000007", stamp)


def _scratch(t: Tables) -> tuple[str, str]:
    """A new database in the shared folder, and a new folder beside it."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(t.spark)}/{name}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/database'")
    return name, folder


@query
def write_modes(t):
    database, _ = _scratch(t)
    lines = t.given("lineitem").select("l_orderkey", "l_returnflag")
    first = write_table(lines, "lines", database=database, if_exists="replace")
    second = write_table(lines.where(F.col("l_returnflag") == "A"), "lines", database=database, if_exists="append")
    counted = read_table(t.spark, "lines", database).groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))
    return counted.withColumns({"replaced": F.lit(first).cast("long"), "appended": F.lit(second).cast("long")})


@query
def csv_export_import(t):
    _, folder = _scratch(t)
    export_files(t.given("customer"), f"{folder}/csv", "csv")
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_seed(t.spark, f"{folder}/csv", schema)


@query
def versioned_replace(t):
    """Two loads and a failed one: readers see the second, and the first is expired."""
    database, folder = _scratch(t)
    table = VersionedTable(t.spark, f"{database}.lines", f"{folder}/versions")
    lines = t.given("lineitem").select("l_orderkey", "l_returnflag")
    first = table.replace(lines.where("l_returnflag = 'A'"))
    second = table.replace(lines)
    try:
        table.replace(lines.withColumn("l_orderkey", F.when(F.col("l_returnflag") == "N", F.raise_error(F.lit("no"))).otherwise(F.col("l_orderkey"))))
        failed = False
    except Exception:
        failed = True
    kept = len(table.versions()) - len(table.expire(keep=1))
    counted = table.read().groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))
    return counted.withColumns({"first": F.lit(first).cast("long"), "second": F.lit(second).cast("long"), "failed": F.lit(failed), "versions": F.lit(kept)})


@query
def logged_runs(t):
    """A run log in a table, after gated runs of two schedulers on one day, of the next day, and of a day with a source behind."""
    database, folder = _scratch(t)
    name = f"{database}.run_log"
    write_table(t.spark.createDataFrame([], fr.LOG_SCHEMA), name)
    day = t.given("events").agg(F.max(F.col("ts").cast("date")).cast("string").alias("d")).first()["d"]
    later = str(pd.Timestamp(day).date() + pd.Timedelta(days=1))
    fresh = {"events": _sources(t)["events"]}
    for today in (day, day, later):
        claim = fr.RunClaim(t.spark, folder, "loans", today)
        fr.gated_run(t.spark, name, lambda d=today: fr.source_freshness(fresh, d), lambda: None, today=today, now=f"{today} 12:00:00", claim=claim)
    return t.spark.table(name).select("log_id", F.col("run_timestamp").cast("timestamp_ntz").alias("run_timestamp"), "status", "sources_ready", "already_ran")


@query
def catalog_query(t):
    """A guarded query with parameters over a materialised view and a table."""
    database, _ = _scratch(t)
    materialize(t.given("orders"), "catalog_query_orders", "view")
    materialize(t.given("customer").select("c_custkey", "c_mktsegment"), "buyers", "table", database)
    return read_catalog_query(
        t.spark, f"select c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total from catalog_query_orders "
        f"join {database}.buyers on o_custkey = c_custkey where o_totalprice >= :low and c_mktsegment in (:first, :second) group by c_mktsegment;",
        {"low": 100000, "first": "BUILDING", "second": "FURNITURE"})


def _as_workbook(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    table = [["P-PartKey", " P Name", "P_RetailPrice", "Wide", "Made On"]]
    for r in rows.sort_values("p_partkey").itertuples():
        table.append([int(r.p_partkey), r.p_name, float(r.p_retailprice), bool(r.p_size > 20), r.made_on.to_pydatetime()])
    content = workbook_bytes({"Notes": [["nothing"]], "Parts": table})
    return pd.DataFrame({"path": [f"parts_{key[0]}.xlsx"], "content": [content]})


@query
def workbook_ingest(t):
    """Parts packed into workbooks of 500 rows, then read back through the workbook source."""
    parts = t.given("part").withColumns({
        "book": F.floor(F.col("p_partkey") / 500),
        "made_on": F.timestamp_add("HOUR", F.col("p_size"), F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")),
    })
    books = parts.groupBy("book").applyInPandas(_as_workbook, "path string, content binary")
    return workbook_rows(books, "Parts")


# --- risk -------------------------------------------------------------------------------------------------------------


def _loan_periods(t: Tables) -> DataFrame:
    """Order lines as the quarters of a loan with small rates."""
    lines = t.given("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_discount").alias("d"), F.max("l_tax").alias("x"), F.max("l_quantity").alias("qty")
    )
    return lines.select("l_orderkey", "l_linenumber", (F.col("x") / 3).alias("cpdr"), (F.col("x") / 7).alias("cpr"),
                        (F.col("d") / 9).alias("cdr"), (F.col("qty") / 70).alias("lgd"))


@query
def survival_curve(t):
    curve = risk.survival_curve(_loan_periods(t), "l_orderkey", "l_linenumber")
    return curve.select("l_orderkey", "l_linenumber", F.round("survival", 9).alias("survival"),
                        F.round("survival_before", 9).alias("survival_before"))


@query
def expected_loss(t):
    losses = risk.expected_loss(risk.survival_curve(_loan_periods(t), "l_orderkey", "l_linenumber"))
    return losses.select("l_orderkey", "l_linenumber", F.round("pd", 9).alias("pd"), F.round("el", 9).alias("el"))


@query
def projected_risk(t):
    """Projected coverage and leverage, distances to default and default rate from order lines."""
    li = t.given("lineitem").groupBy("l_orderkey").agg(
        F.max("l_extendedprice").alias("top"), F.min("l_extendedprice").alias("low"), F.max("l_quantity").alias("qty")
    )
    dscr = risk.projected_dscr(F.lit(1.4), "low", "top", F.col("qty"), F.col("qty") + 5)
    ltv = risk.projected_ltv(F.lit(0.6), "low", "top", F.col("qty") + 5, "qty")
    z1, z2 = risk.z_dscr(dscr, 0.2), risk.z_ltv(ltv, 0.25)
    rate = risk.term_cdr(z1, z2, F.col("qty") / 50, (-0.8, -0.6, 0.3))
    columns = {"dscr": dscr, "ltv": ltv, "z": risk.z_weighted(z1, z2, 0.4), "cdr": rate,
               "baseline_cdr": risk.multiplier_cdr(F.lit(0.02), z2)}
    totals = risk.total_risk(li.select("l_orderkey", *[c.alias(n) for n, c in columns.items()]).withColumns({
        "term_pd": F.col("cdr"), "refi_pd": F.lit(0.01), "term_lgd": F.lit(0.3), "refi_lgd": F.lit(0.1),
        "term_el": F.col("cdr") * 0.3, "refi_el": F.lit(0.001),
    }))
    return totals.select("l_orderkey", *[F.round(c, 9).alias(c) for c in (*columns, "total_pd", "total_el")])


@query
def signal_labels(t):
    per_agent = t.given("events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type").isin("click", "view", "purchase", "signup")).alias("hits")
    )
    shares = per_agent.withColumn("share", numbers.pct(F.col("hits"), F.col("n")))
    return shares.withColumn("signal", numbers.signal_strength("share", "n"))
