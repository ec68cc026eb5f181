"""Loan marts: staging, segment, collateral match, vendor input, quality summary and filter discovery.

Every function maps DataFrames to a lazy DataFrame. Where one mart feeds several others, write it with
`sources.tables.materialize(..., "table")` and pass the table on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_stale
from ..functions.numbers import count_where, exact_sum, pct, ratio, signal_strength
from ..functions.terms import effective_origination, remaining_terms
from ..functions.text import US_STATES, address_flags, flag_is_set, normalize_state, zip5
from ..operators.filter_tree import tree_predicate
from ..operators.membership import missing_keys, tag_membership
from ..operators.pick import pick_first
from ..operators.profile import profile_fields
from ..operators.snapshots import with_previous

# The columns of the source tables and of the staged ones.
# Output column, source column, type (None keeps the type of the source).
CORE_LOANS = (
    ("loan_id", "loan_id", None),
    ("loan_number", "loan_number", None),
    ("loan_type_code", "loan_type_code", None),
    ("loan_type_description", "loan_type_description", None),
    ("call_report_code", "call_report_code", None),
    ("occupancy_type_code", "occupancy_type_code", None),
    ("owner_occupied_flag", "owner_occupied_flag", None),
    ("product_type", "product_type", None),
    ("loan_status", "loan_status", None),
    ("purpose_code", "purpose_code", None),
    ("committed_balance", "committed_balance", "double"),
    ("outstanding_balance", "outstanding_balance", "double"),
    ("unfunded_balance", "unfunded_balance", "double"),
    ("origination_date", "origination_date", "date"),
    ("maturity_date", "maturity_date", "date"),
    ("modification_date", "modification_date", "date"),
    ("original_amortization_term_months", "original_amortization_term", "int"),
    ("io_period_months", "io_period_months", "int"),
    ("io_end_date", "io_end_date", "date"),
    ("rate_type", "rate_type", None),
    ("interest_rate", "interest_rate", "double"),
    ("index_type", "index_type", None),
    ("spread", "spread", "double"),
    ("branch_code", "branch_code", None),
    ("loan_officer_id", "loan_officer_id", None),
    ("as_of_date", "as_of_date", None),
)
NCINO_LOANS = (
    ("ncino_id", "id", None),
    ("loan_number", "ll__loan_number__c", None),
    ("borrower_cif", "ll__cif__c", None),
    ("loan_type_code", "ll__loan_type__c", None),
    ("property_type", "ll__property_type__c", None),
    ("occupancy_type_code", "ll__occupancy_type__c", None),
    ("product_type", "ll__product_type__c", None),
    ("loan_status", "ll__stage__c", None),
    ("committed_balance", "ll__committed_amount__c", "double"),
    ("outstanding_balance", "ll__outstanding_principal__c", "double"),
    ("origination_date", "ll__original_close_date__c", "date"),
    ("maturity_date", "ll__maturity_date__c", "date"),
    ("original_amortization_term_months", "ll__amortization_term__c", "int"),
    ("io_period_months", "ll__io_period__c", "int"),
    ("rate_type", "ll__rate_type__c", None),
    ("interest_rate", "ll__interest_rate__c", "double"),
    ("loan_phase", "ll__loan_phase__c", None),
    ("conversion_date", "ll__construction_to_perm_date__c", "date"),
    ("record_type", "recordtypename", None),
    ("as_of_date", "as_of_date", None),
)

# Codes of the segment, collateral and construction rules.
SEGMENT_CODE = "1-a"
CLOSED_STATUSES = ("PAID_OFF", "CHARGED_OFF", "CLOSED")
REAL_ESTATE_CODES = ("RE", "REAL_ESTATE", "CRE", "LAND")
CONSTRUCTION_PHASES = ("CONSTRUCTION", "MINI-PERM")
CONSTRUCTION_PRODUCTS = ("%ARC%", "%CONSTRUCTION%")

# Texts of a flag that is not set; a boolean column uses the boolean.
FALSE_FLAGS = ["false", "False", "FALSE", "f", "F", "no", "No", "NO", "n", "N", "0"]

# Segment filters as filter trees; the first is the default.
SEGMENTS = {
    "call_report": {"col": "call_report_code", "op": "==", "value": SEGMENT_CODE},
    "occupancy": {"and": [{"col": "occupancy_type_code", "op": "==", "value": "NOO"},
                          {"col": "loan_type_code", "op": "in", "value": ["CRE", "RE", "COMM_RE"]}]},
    "owner_flag": {"and": [{"col": "owner_occupied_flag", "op": "in", "value": [False, *FALSE_FLAGS]},
                           {"col": "loan_type_code", "op": "in", "value": ["CRE", "RE"]}]},
}

PROFILE_FIELDS = (
    "call_report_code", "occupancy_type_code", "loan_type_code", "product_type", "loan_status", "purpose_code",
)
PROFILE_COMBOS = {
    "COMBO: call_report + occupancy + loan_type": ("call_report_code", "occupancy_type_code", "loan_type_code"),
}


def rename_and_cast(df: DataFrame, columns: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    return df.select(*[(F.col(s).cast(t) if t else F.col(s)).alias(name) for name, s, t in columns])


def stage_core_loans(loans: DataFrame) -> DataFrame:
    return rename_and_cast(loans, CORE_LOANS)


def stage_ncino_loans(nc_loan: DataFrame) -> DataFrame:
    return rename_and_cast(nc_loan, NCINO_LOANS)


def stage_collaterals(collaterals: DataFrame, xref: DataFrame, states: Mapping[str, str] = US_STATES) -> DataFrame:
    """One row per loan and collateral pairing with the details of the collateral and a normalised state."""
    details = collaterals.select(
        "collateral_id",
        "collateral_type_code",
        "collateral_description",
        "primary_flag",
        F.col("appraised_value").cast("double").alias("appraised_value"),
        F.col("appraisal_date").cast("date").alias("appraisal_date"),
        F.col("book_value").cast("double").alias("book_value"),
        F.col("street_address").alias("street_address_raw"),
        F.col("city").alias("city_raw"),
        normalize_state("state_code", states).alias("state_code"),
        F.col("state_code").alias("state_code_raw"),
        F.col("zip_code").alias("zip_code_raw"),
        "as_of_date",
    )
    pairs = xref.select("loan_id", "collateral_id", F.col("primary_flag").alias("xref_primary_flag"))
    joined = pairs.join(details, "collateral_id", "left")
    flag = F.coalesce("primary_flag", "xref_primary_flag").alias("primary_flag")
    rest = [c for c in details.columns if c not in ("collateral_id", "primary_flag")]
    return joined.select("loan_id", "collateral_id", flag, *rest)


def segment_loans(
    core_loans: DataFrame,
    ncino_loans: DataFrame,
    as_of: str,
    *,
    segment: Mapping | None = None,
    excluded_statuses: Sequence[str] = CLOSED_STATUSES,
    products: Sequence[str] = CONSTRUCTION_PRODUCTS,
    one_phase_per_loan: bool = False,
) -> DataFrame:
    """Loans of the segment at the as-of date, with construction class and effective origination date.

    A loan number with several phase rows yields several loan rows; `one_phase_per_loan` keeps the latest instead.
    A NULL status is left out, as by SQL `not in`.
    """
    phases = ncino_loans.where(F.col("loan_number").isNotNull())
    if one_phase_per_loan:
        order = [F.col("as_of_date").desc_nulls_last(), F.col("conversion_date").desc_nulls_last(), F.col("ncino_id").asc()]
        phases = pick_first(phases, ["loan_number"], order)
    arc = F.col("loan_phase").isin(*CONSTRUCTION_PHASES)
    for pattern in products:
        arc = arc | F.col("product_type").ilike(pattern)
    arc = F.coalesce(arc, F.lit(False)).alias("is_arc_loan")
    phases = phases.select("loan_number", arc, "loan_phase", "conversion_date")

    kept = core_loans.where(
        tree_predicate(core_loans, segment or SEGMENTS["call_report"])
        & ~F.col("loan_status").isin(*excluded_statuses)
        & (F.col("as_of_date") == F.lit(as_of).cast("date"))
    )
    joined = kept.join(phases, "loan_number", "left")
    start = effective_origination("is_arc_loan", "conversion_date", "origination_date")
    return joined.select(*core_loans.columns, *phases.columns[1:], start.alias("effective_origination_date"))


COLLATERAL_COLUMNS = (
    "collateral_id", "appraised_value", "appraisal_date", "book_value", "street_address", "city", "state_code", "zip_code",
    "zip5", "is_null_address", "is_po_box", "has_street_number", "is_valid_street_address", "is_valid_zip",
)
LOAN_COLUMNS = (
    "loan_id", "loan_number", "loan_type_code", "call_report_code", "occupancy_type_code", "product_type", "is_arc_loan",
    "loan_status", "committed_balance", "outstanding_balance", "origination_date", "effective_origination_date",
    "maturity_date", "original_amortization_term_months", "io_period_months", "io_end_date", "rate_type", "interest_rate",
    "branch_code", "loan_officer_id",
)


def primary_order() -> list[Column]:
    """Flagged first, then latest appraisal, then highest value; the id makes the choice repeatable."""
    return [
        flag_is_set("primary_flag").desc(),
        F.col("appraisal_date").desc_nulls_last(),
        F.col("appraised_value").desc_nulls_last(),
        F.col("collateral_id").asc(),
    ]


def address_columns(profile: str = "basic", ignore_case: bool = False) -> dict[str, Column]:
    columns = address_flags("street_address_raw", "zip_code_raw", profile=profile, ignore_case=ignore_case)
    return columns | {
        "street_address": F.trim("street_address_raw"),
        "city": F.trim("city_raw"),
        "zip_code": F.trim("zip_code_raw"),
        "zip5": zip5("zip_code_raw"),
    }


def match_collateral(
    loans: DataFrame,
    collaterals: DataFrame,
    as_of: str,
    *,
    codes: Sequence[str] = REAL_ESTATE_CODES,
    mode: str = "primary",
    profile: str = "basic",
    ignore_case: bool = False,
) -> DataFrame:
    """Loans with one collateral each and completeness flags.

    `primary` takes the best ranked collateral; `aggregate` sums values over all of them, takes the latest appraisal
    and the address of the best ranked one. Only then are addresses judged: once per loan, not once per collateral.
    """
    eligible = collaterals.where(
        F.col("collateral_type_code").isin(*codes) & (F.col("as_of_date") == F.lit(as_of).cast("date"))
    )
    needed = ["loan_id", "collateral_id", "appraised_value", "appraisal_date", "book_value", "street_address_raw",
              "city_raw", "state_code", "zip_code_raw"]
    if mode == "primary":
        chosen = pick_first(eligible, ["loan_id"], primary_order()).select(*needed)
    elif mode == "aggregate":
        chosen = roll_up_collateral(eligible)
    else:
        raise ValueError("mode must be one of: 'primary', 'aggregate'")
    chosen = chosen.withColumns(address_columns(profile, ignore_case)).select("loan_id", *COLLATERAL_COLUMNS)
    joined = loans.select(*LOAN_COLUMNS).join(chosen, "loan_id", "left")
    found = F.col("collateral_id").isNotNull()
    complete = (
        found
        & F.col("is_valid_street_address")
        & F.col("is_valid_zip")
        & F.col("appraised_value").isNotNull()
        & F.col("appraisal_date").isNotNull()
    )
    flags = {
        "has_collateral_match": found,
        "has_complete_collateral_data": F.coalesce(complete, F.lit(False)),
    }
    return joined.withColumns(flags).select(*LOAN_COLUMNS, *COLLATERAL_COLUMNS, *flags)


def roll_up_collateral(collaterals: DataFrame) -> DataFrame:
    """Per loan: summed values, latest appraisal, and address of the best ranked collateral, in one grouping.

    `primary_order` as one struct: its least value is the first row. Negated numbers turn the order round, and a value
    that is missing comes after all others.
    """
    order = F.struct(
        (~flag_is_set("primary_flag")).alias("a"),
        F.col("appraisal_date").isNull().alias("b"), (-F.unix_date("appraisal_date")).alias("c"),
        F.col("appraised_value").isNull().alias("d"), (-F.col("appraised_value")).alias("e"),
        F.col("collateral_id").alias("f"),
    )
    texts = ["collateral_id", "street_address_raw", "city_raw", "state_code", "zip_code_raw"]
    return collaterals.groupBy("loan_id").agg(
        exact_sum("appraised_value").alias("appraised_value"),
        F.max("appraisal_date").alias("appraisal_date"),
        exact_sum("book_value").alias("book_value"),
        F.min_by(F.struct(*texts), order).alias("_best"),
    ).select("loan_id", "_best.collateral_id", "appraised_value", "appraisal_date", "book_value", *[f"_best.{c}" for c in texts[1:]])


STRESS_COLUMNS = (
    "loan_id", "loan_number", "loan_type_code", "call_report_code", "occupancy_type_code", "product_type", "is_arc_loan",
    "loan_status", "rate_type", "interest_rate", "committed_balance", "outstanding_balance", "origination_date",
    "effective_origination_date", "maturity_date", "original_amortization_term_months", "io_period_months", "io_end_date",
    "months_to_maturity", "amortization_term_remaining", "io_term_remaining", "is_matured", "is_io_expired",
    "collateral_id", "appraised_value", "appraisal_date", "book_value", "street_address", "city", "state_code", "zip_code",
    "zip5", "has_collateral_match", "has_complete_collateral_data", "is_null_address", "is_po_box", "has_street_number",
    "is_valid_street_address", "is_valid_zip", "branch_code", "loan_officer_id",
)


def stress_test_input(matched: DataFrame, as_of: str, loaded_at: Column | None = None) -> DataFrame:
    """The vendor input: matched loans with remaining terms, report date and load time."""
    with_terms = matched.withColumns(remaining_terms(as_of))
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return with_terms.select(
        *STRESS_COLUMNS, F.lit(as_of).cast("date").alias("report_date"), stamp.alias("dbt_loaded_at")
    )


def data_quality_summary(stress_input: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares per report date, and per further columns such as branch or officer."""
    matched, valid = F.col("has_collateral_match"), F.col("is_valid_street_address")
    blank, box = F.col("is_null_address"), F.col("is_po_box")
    counted = stress_input.groupBy("report_date", *by).agg(
        F.count("*").alias("total_loans"),
        exact_sum("outstanding_balance").alias("total_outstanding_balance"),
        exact_sum("committed_balance").alias("total_committed_balance"),
        count_where(matched).alias("loans_with_collateral"),
        count_where(~matched).alias("loans_without_collateral"),
        count_where(F.col("has_complete_collateral_data")).alias("loans_with_complete_collateral"),
        count_where(matched & valid).alias("valid_addresses"),
        count_where(matched & blank).alias("null_addresses"),
        count_where(matched & box).alias("po_box_addresses"),
        count_where(matched & ~valid & ~blank & ~box).alias("invalid_format_addresses"),
        count_where(F.col("months_to_maturity").isNotNull()).alias("loans_with_maturity_term"),
        # The floored months are never NULL, so the date itself tells how many loans really have a term.
        count_where(F.col("maturity_date").isNotNull()).alias("loans_with_maturity_date"),
        count_where(F.col("amortization_term_remaining").isNotNull()).alias("loans_with_amort_term"),
        count_where(F.col("is_matured")).alias("matured_loans"),
        count_where(F.col("is_arc_loan")).alias("arc_loans"),
        count_where(is_stale("appraisal_date", "report_date")).alias("stale_appraisals"),
    )
    return counted.withColumns(
        {
            "collateral_match_pct": pct(F.col("loans_with_collateral"), F.col("total_loans")),
            "complete_collateral_pct": pct(F.col("loans_with_complete_collateral"), F.col("total_loans")),
            "valid_address_pct": pct(F.col("valid_addresses"), F.col("loans_with_collateral")),
        }
    )


def match_rate_by(stress_input: DataFrame, by: Sequence[str]) -> DataFrame:
    counted = stress_input.groupBy(*by).agg(
        F.count("*").alias("total_loans"), count_where(F.col("has_collateral_match")).alias("matched_loans")
    )
    return counted.withColumn("match_rate", ratio(F.col("matched_loans"), F.col("total_loans"), 4))


def match_rates_over_time(
    core_loans: DataFrame, collaterals: DataFrame, dates: Sequence[str], by: Sequence[str] = (), *, codes: Sequence[str] = REAL_ESTATE_CODES,
) -> DataFrame:
    """Share of loans with an eligible collateral per snapshot and group, with the rate of the snapshot before and the change.

    All snapshots are counted in one pass: a loan meets the collaterals of its own date, reduced to one key each.
    """
    days = [F.lit(d).cast("date") for d in dates]
    wanted = F.col("as_of_date").isin(*days)
    covered = collaterals.where(wanted & F.col("collateral_type_code").isin(*codes)).select("loan_id", "as_of_date").distinct()
    tagged = core_loans.where(wanted).join(covered.withColumn("has_collateral_match", F.lit(True)), ["loan_id", "as_of_date"], "left")
    rates = match_rate_by(tagged.fillna(False, ["has_collateral_match"]), ["as_of_date", *by])
    changes = with_previous(rates, by, "as_of_date", ["match_rate"])
    return changes.withColumn("match_rate_change", F.round(F.col("match_rate") - F.col("previous_match_rate"), 4))


def filter_discovery(core_loans: DataFrame, march: DataFrame, december: DataFrame, snapshots: Sequence[str]) -> DataFrame:
    """All loans of the snapshots with flags for membership of the two reference files."""
    days = [F.lit(d).cast("date") for d in snapshots]
    return tag_membership(
        core_loans.where(F.col("as_of_date").isin(*days)),
        {"march_input": march, "dec_input": december},
        "loan_id",
        any_name="in_either_input",
        all_name="in_both_inputs",
        label_name="input_membership",
    )


def filter_pattern_analysis(
    discovery: DataFrame,
    core_loans: DataFrame,
    december: DataFrame,
    as_of: str,
    fields: Sequence[str] = PROFILE_FIELDS,
    combos: Mapping[str, Sequence[str]] = PROFILE_COMBOS,
) -> DataFrame:
    """Membership counts per field value, then reference keys which the core table lacks, with a signal label."""
    day = F.lit(as_of).cast("date")
    profile = profile_fields(
        discovery.where(F.col("as_of_date") == day),
        fields,
        {
            "total_core_count": F.count("*"),
            "march_input_count": count_where(F.col("in_march_input")),
            "dec_input_count": count_where(F.col("in_dec_input")),
            "either_input_count": count_where(F.col("in_either_input")),
            "total_outstanding_balance": exact_sum("outstanding_balance"),
        },
        combos=combos,
    ).withColumn("dec_input_pct", pct(F.col("dec_input_count"), F.col("total_core_count")))
    unknown = missing_keys(december.select("loan_id"), core_loans.where(F.col("as_of_date") == day), "loan_id").select(
        F.lit("MISSING FROM CORE").alias("filter_field"),
        F.col("loan_id").cast("string").alias("field_value"),
        F.lit(0).cast("long").alias("total_core_count"),
        F.lit(0).cast("long").alias("march_input_count"),
        F.lit(1).cast("long").alias("dec_input_count"),
        F.lit(1).cast("long").alias("either_input_count"),
        F.lit(None).cast("double").alias("dec_input_pct"),
        F.lit(None).cast("double").alias("total_outstanding_balance"),
    )
    labelled = profile.select(*unknown.columns).unionByName(unknown)
    labelled = labelled.withColumn("signal_strength", signal_strength("dec_input_pct", "total_core_count"))
    return labelled.orderBy(F.col("filter_field").asc(), F.col("dec_input_count").desc(), F.col("field_value").asc())


def sample_mart(loans: DataFrame, collaterals: DataFrame, loan_type: str = "CRE_NOO") -> DataFrame:
    """Loans of one type with the values of their collaterals, or NULL for none.

    A left join cannot be split on its right side when one loan holds very many collaterals. An inner join can, so
    matched loans and loans without collateral are found apart.
    """
    wanted = loans.where(F.col("loan_type") == loan_type)
    values = collaterals.select("loan_id", "collateral_value")
    value_type = collaterals.schema["collateral_value"].dataType
    lonely = missing_keys(wanted, values, "loan_id").withColumn("collateral_value", F.lit(None).cast(value_type))
    return wanted.join(values, "loan_id").select(*lonely.columns).unionByName(lonely)
