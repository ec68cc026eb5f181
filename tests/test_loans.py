import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlab.operators import changes, membership, pick, profile
from martlab.plans import dashboard, loans, risk

from .conftest import plan_of, rows

D = dt.date
AS_OF = "2025-12-31"
LOAN_SCHEMA = ", ".join(f"`{s}` {t or 'string'}" for _, s, t in loans.CORE_LOANS)


def loan(loan_id, **given):
    base = {
        "loan_id": loan_id, "loan_number": f"LN-{loan_id}", "loan_type_code": "CRE", "call_report_code": "1-a", "occupancy_type_code": "NOO",
        "product_type": "TERM", "loan_status": "ACTIVE", "committed_balance": 1000.0, "outstanding_balance": 800.0,
        "origination_date": D(2021, 3, 15), "maturity_date": D(2026, 3, 15), "original_amortization_term": 300, "as_of_date": AS_OF,
    }
    return tuple((base | given).get(s) for _, s, _ in loans.CORE_LOANS)


NC_SCHEMA = ", ".join(f"`{s}` {t or 'string'}" for _, s, t in loans.NCINO_LOANS)


def phase(number, kind, converted=None, product=None, ncino_id="N1"):
    base = {"id": ncino_id, "ll__loan_number__c": number, "ll__loan_phase__c": kind, "ll__construction_to_perm_date__c": converted,
            "ll__product_type__c": product, "as_of_date": AS_OF}
    return tuple(base.get(s) for _, s, _ in loans.NCINO_LOANS)


COLLATERAL_SCHEMA = ("collateral_id string, collateral_type_code string, collateral_description string, primary_flag string, appraised_value double, "
                     "appraisal_date date, book_value double, street_address string, city string, state_code string, zip_code string, as_of_date string")


def collateral(cid, **given):
    base = {"collateral_id": cid, "collateral_type_code": "RE", "appraised_value": 100.0, "appraisal_date": D(2022, 6, 1), "book_value": 50.0,
            "street_address": "123 Main St", "city": " Tampa ", "state_code": "Florida", "zip_code": "33601", "as_of_date": AS_OF}
    return tuple((base | given).get(c.split()[0]) for c in COLLATERAL_SCHEMA.split(", "))


@pytest.fixture(scope="module")
def parts(spark):
    core = spark.createDataFrame([
        loan("L1"), loan("L2", product_type="ARC"), loan("L3"), loan("L4", call_report_code="1-b"), loan("L5", loan_status=None),
        loan("L6", loan_status="PAID_OFF"), loan("L7", as_of_date="2025-03-31"), loan("L8", maturity_date=None),
    ], LOAN_SCHEMA)
    nc = spark.createDataFrame([
        phase("LN-L2", "CONSTRUCTION", D(2023, 1, 1)), phase("LN-L3", "PERMANENT", D(2023, 1, 1), "March special"),
        phase("LN-L8", None, None, ncino_id="N1"), phase("LN-L8", "PERMANENT", D(2024, 1, 1), ncino_id="N2"), phase(None, "CONSTRUCTION"),
    ], NC_SCHEMA)
    xref = spark.createDataFrame([
        ("L1", "C1", None), ("L1", "C2", "Y"), ("L1", "C3", "N"), ("L2", "C4", None), ("L2", "C5", None), ("L3", "C6", "Y"), ("L8", "GONE", "Y"),
    ], "loan_id string, collateral_id string, primary_flag string")
    collaterals = spark.createDataFrame([
        collateral("C1", primary_flag="true", appraisal_date=D(2020, 1, 1)), collateral("C2", appraised_value=300.0), collateral("C3", appraisal_date=D(2025, 1, 1)),
        collateral("C4", appraisal_date=None, appraised_value=900.0), collateral("C5", street_address="PO BOX 1", zip_code="1"),
        collateral("C6", collateral_type_code="EQUIP"),
    ], COLLATERAL_SCHEMA)
    return loans.stage_core_loans(core), loans.stage_ncino_loans(nc), loans.stage_collaterals(collaterals, xref)


def test_segment(parts):
    core, nc, _ = parts
    got = loans.segment_loans(core, nc, AS_OF).select("loan_id", "is_arc_loan", "effective_origination_date")
    assert rows(got) == sorted([
        ("L1", None, D(2021, 3, 15)), ("L2", True, D(2023, 1, 1)),
        ("L3", True, D(2023, 1, 1)),  # the pattern also meets words such as March
        ("L8", False, D(2021, 3, 15)), ("L8", False, D(2021, 3, 15)),  # two phase rows, two loan rows
    ], key=repr)
    assert loans.segment_loans(core, nc, AS_OF, one_phase_per_loan=True).where("loan_id = 'L8'").count() == 1
    by_occupancy = loans.segment_loans(core, nc, AS_OF, segment=loans.SEGMENTS["occupancy"])
    assert "L4" in {r["loan_id"] for r in by_occupancy.collect()}


def test_match_and_vendor_input(parts):
    core, nc, staged = parts
    segment = loans.segment_loans(core, nc, AS_OF, one_phase_per_loan=True)
    matched = loans.match_collateral(segment, staged, AS_OF)
    got = rows(matched.select("loan_id", "collateral_id", "city", "state_code", "has_collateral_match", "has_complete_collateral_data"))
    assert got == sorted([
        ("L1", "C2", "Tampa", "FL", True, True),  # flagged twice, so the later appraisal wins
        ("L2", "C5", "Tampa", "FL", True, False), ("L3", None, None, None, False, False), ("L8", None, None, None, False, False),
    ], key=repr)
    final = loans.stress_test_input(matched, AS_OF)
    assert final.columns == [*loans.STRESS_COLUMNS, "report_date", "dbt_loaded_at"]
    terms = {r["loan_id"]: (r["months_to_maturity"], r["amortization_term_remaining"]) for r in final.collect()}
    assert terms["L1"] == (3, 243) and terms["L2"] == (3, 265) and terms["L8"][0] == 0
    summary = loans.data_quality_summary(final).first()
    assert (summary["total_loans"], summary["loans_with_collateral"], summary["collateral_match_pct"]) == (4, 2, 50.0)
    assert (summary["loans_with_maturity_term"], summary["loans_with_maturity_date"]) == (4, 3)
    assert (summary["po_box_addresses"], summary["stale_appraisals"], summary["arc_loans"]) == (1, 2, 2)
    assert rows(loans.match_rate_by(final, ["product_type"])) == [("ARC", 1, 1, 1.0), ("TERM", 3, 1, 0.3333)]


def test_roll_up(parts):
    core, nc, staged = parts
    got = loans.match_collateral(loans.segment_loans(core, nc, AS_OF), staged, AS_OF, mode="aggregate")
    row = got.where("loan_id = 'L1'").first()
    assert (row["collateral_id"], row["appraised_value"], row["appraisal_date"], row["book_value"]) == ("C2", 500.0, D(2025, 1, 1), 150.0)
    with pytest.raises(ValueError):
        loans.match_collateral(core, staged, AS_OF, mode="other")


def test_primary_pick_limits_groups_before_the_shuffle(parts):
    plan = plan_of(pick.pick_first(parts[2], ["loan_id"], loans.primary_order()))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange hashpartitioning(loan_id") < plan.rindex("WindowGroupLimit")


def test_membership_and_profile(spark, parts):
    core = parts[0]
    march = spark.createDataFrame([("L1",), ("L1",), ("L2",), (None,)], "loan_id string")
    december = spark.createDataFrame([("L2",), ("L3",), ("ZZ",)], "loan_id string")
    found = loans.filter_discovery(core, march, december, [AS_OF])
    labels = {r["loan_id"]: r["input_membership"] for r in found.collect()}
    assert labels == {"L1": "MARCH_ONLY", "L2": "BOTH", "L3": "DEC_ONLY", "L4": "NEITHER", "L5": "NEITHER", "L6": "NEITHER", "L8": "NEITHER"}
    result = loans.filter_pattern_analysis(found, core, december, AS_OF)
    table = {(r["filter_field"], r["field_value"]): r for r in result.collect()}
    assert table["loan_status", "(null)"]["total_core_count"] == 1
    assert table["product_type", "ARC"]["signal_strength"].startswith("STRONG")
    assert table["COMBO: call_report + occupancy + loan_type", "1-a | NOO | CRE"]["total_core_count"] == 6
    assert table["MISSING FROM CORE", "ZZ"]["dec_input_pct"] is None
    assert [r["filter_field"] for r in result.collect()] == sorted(r["filter_field"] for r in result.collect())
    assert plan_of(result).count("Scan") <= plan_of(found).count("Scan") + 4


def test_profile_scans_once_and_keeps_real_nulls_apart(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = profile.profile_fields(orders, ["o_orderstatus", "o_orderpriority"], {"n": F.count("*")})
    assert plan_of(got).count("FileScan") == 1
    df = spark.createDataFrame([(None, "b"), ("(null)", "b"), ("a | b", "c"), ("a", "b | c")], "x string, y string")
    got = profile.profile_fields(df, ["x"], {"n": F.count("*")}, combos={"both": ["x", "y"]})
    values = [r["field_value"] for r in got.collect()]
    assert values.count("(null)") == 2 and values.count("a | b | c") == 2


def test_three_sets_and_parity(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    sets = {n: spark.createDataFrame([(v,) for v in vs], "k long") for n, vs in (("a", [1, 2]), ("b", [1]), ("c", [1, 2]))}
    got = membership.tag_membership(df, sets, "k", any_name="any", all_name="all", label_name="label")
    assert {r["k"]: r["label"] for r in got.collect()} == {1: "ALL", 2: "A+C", 3: "NONE", None: "NONE"}
    ours, theirs = df.selectExpr("k", "'n' AS n"), spark.createDataFrame([(2, "n"), (9, "n"), (9, "n")], "k long, n string")
    found = membership.key_parity(ours, theirs, "k", ["k", "n"], ours_name="us", theirs_name="them")
    assert [r["k"] for r in found.where("discrepancy_type LIKE '%under%'").collect()] == [9, 9]
    assert sorted(str(r["k"]) for r in found.where("discrepancy_type LIKE '%over%'").collect()) == ["1", "3", "None"]


def test_differences(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (5, "d", 0.0), (5, "d", 0.0)], "id long, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (4, "w", 4.0), (5, "d", 0.0)], "id long, s string, v double")
    assert rows(changes.dataset_diff(a, b, "id")) == sorted([
        (2, "CHANGED", "v", None, "2.0"), (3, "REMOVED", None, None, None), (4, "ADDED", None, None, None), (5, "DUPLICATE_KEY", None, None, None),
    ], key=repr)
    assert changes.column_diff(a, b.withColumn("n", F.lit(1)).drop("s").withColumn("v", F.lit("t"))) == {
        "added": ["n"], "dropped": ["s"], "retyped": ["v"]}


def test_sample_mart(spark):
    left = spark.createDataFrame([(1, "CRE_NOO"), (2, "OTHER"), (3, "CRE_NOO")], "loan_id long, loan_type string")
    right = spark.createDataFrame([(1, 5.0)], "loan_id long, collateral_value double")
    assert rows(loans.sample_mart(left, right)) == [(1, "CRE_NOO", 5.0), (3, "CRE_NOO", None)]


def test_panels(spark):
    df = spark.createDataFrame([(1, "N", 1, "a", 10.0, 1), (2, "N", 1, "b", 20.0, 0), (3, "S", 2, "a", 30.0, 1)],
                               "id long, category string, month int, item string, value double, accepted int")
    assert [tuple(r) for r in dashboard.month_trend(df).collect()] == [(1, 15.0), (2, 30.0)]
    assert [tuple(r) for r in dashboard.top_items(df, 1).collect()] == [("a", 20.0, 2, 2, "20.00")]
    assert [tuple(r) for r in dashboard.acceptance_by_category(df).collect()] == [("N", 1, 2, 50.0, "50.0"), ("S", 1, 1, 100.0, "100.0")]
    assert dashboard.review_grid(df).first()["accepted_text"] == "Yes"


def test_risk(spark):
    df = spark.createDataFrame([("L", 1, 0.1, 0.0, 0.1, 0.4), ("L", 2, 1.0, 0.0, 0.0, 0.4), ("L", 3, 0.0, 0.0, 0.5, 0.4)],
                               "loan string, t int, cpdr double, cpr double, cdr double, lgd double")
    got = risk.expected_loss(risk.survival_curve(df, "loan", "t")).orderBy("t").collect()
    assert [round(r["survival"], 9) for r in got] == [0.8, 0.0, 0.0]  # a full pay-down ends the curve
    assert [round(r["pd"], 9) for r in got] == [0.1, 0.0, 0.0]
    assert round(got[0]["el"], 9) == 0.04
    row = spark.range(1).select(
        risk.z_dscr(F.lit(1.25), 0.2).alias("a"), risk.z_ltv(F.lit(0.75), 0.5).alias("b"),
        risk.projected_dscr(F.lit(1.2), F.lit(100.0), F.lit(110.0), F.lit(10.0), F.lit(11.0)).alias("c"),
        risk.projected_ltv(F.lit(0.6), F.lit(100.0), F.lit(120.0), F.lit(50.0), F.lit(40.0)).alias("d"),
        risk.term_cdr(F.lit(0.0), F.lit(0.0), F.lit(0.0), (1, 1, 1)).alias("e"),
    ).first()
    assert [round(x, 9) for x in row] == [1.0, 0.5, 1.2, 0.4, 0.5]


# --- snapshots ---


def test_as_of_rows_equal_a_scan(spark):
    import random

    from martlab.operators.snapshots import as_of_rows

    rng = random.Random(4)
    day = lambda n: None if n is None else D(2024, 1, 1) + dt.timedelta(n)
    facts = [(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 3000, 7)]), rng.randrange(5)) for _ in range(200)]
    asked = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-50, 3100)])) for _ in range(150)] * 2
    f = spark.createDataFrame([(k, day(d), v) for k, d, v in facts], "k string, d date, v int")
    a = spark.createDataFrame([(k, day(d)) for k, d in asked], "k string, at date")
    want = []
    for k, at in asked:
        older = [(d, v) for fk, d, v in facts if k is not None and fk == k and d is not None and at is not None and d <= at]
        want.append((k, day(at), (day(max(older)[0]), max(older)[1]) if older else None))
    for slot_days in (1, 30, 100000):
        got = [(r.k, r["at"], r.found and (r.found.d, r.found.v)) for r in as_of_rows(a, f, ["k"], asked_day="at", fact_day="d", slot_days=slot_days).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert "NestedLoop" not in plan_of(as_of_rows(a, f, ["k"], asked_day="at", fact_day="d"))


def test_period_diff_and_previous(spark):
    from martlab.operators.snapshots import period_diff, snapshots_at, with_previous

    df = spark.createDataFrame([(1, D(2024, 1, 1), "x"), (1, D(2024, 2, 1), "y"), (1, D(2024, 3, 1), "y"), (2, D(2024, 1, 1), None), (2, D(2024, 3, 1), None),
                                (3, D(2024, 2, 15), "no")], "id int, d date, v string")
    got = period_diff(df, ["id"], "d", ["2024-01-01", "2024-02-01", "2024-03-01"], ["v"])
    assert rows(got) == sorted([(D(2024, 2, 1), 1, "CHANGED", "v", "x", "y"), (D(2024, 2, 1), 2, "REMOVED", None, None, None),
                                (D(2024, 3, 1), 2, "ADDED", None, None, None)], key=repr)
    with pytest.raises(ValueError):
        period_diff(df, ["id"], "d", ["2024-01-01"], ["v"])
    known = snapshots_at(df, ["id"], "d", ["2023-12-31", "2024-02-20"])
    assert rows(known) == sorted([(D(2024, 2, 20), 1, D(2024, 2, 1), "y"), (D(2024, 2, 20), 2, D(2024, 1, 1), None), (D(2024, 2, 20), 3, D(2024, 2, 15), "no")], key=repr)
    before = with_previous(df, ["id"], "d", ["v"]).where("id = 1").select("d", "previous_v")
    assert rows(before) == sorted([(D(2024, 1, 1), None), (D(2024, 2, 1), "x"), (D(2024, 3, 1), "y")], key=repr)


def test_snapshot_filters_are_observed(spark, monkeypatch):
    """Without its date filter a mart gives other rows, so the oracles would notice."""
    from checks.shapes import AS_OF as TODAY, Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    core, nc = loans.stage_core_loans(t.core_loans()), loans.stage_ncino_loans(t.ncino_loans())
    staged = loans.stage_collaterals(t.core_collaterals(), t.xref())
    kept = loans.segment_loans(core, nc, TODAY)
    same = loans.segment_loans(core.withColumn("as_of_date", F.lit(TODAY).cast("date")), nc, TODAY)
    assert kept.count() < same.count()
    flat = staged.withColumn("as_of_date", F.lit(TODAY).cast("date"))
    a = loans.match_collateral(kept, staged, TODAY).select("loan_id", "appraised_value")
    b = loans.match_collateral(kept, flat, TODAY).select("loan_id", "appraised_value")
    assert rows(a) != rows(b)
    found = loans.filter_discovery(core, t.march_set(), t.december_set(), [TODAY])
    assert 0 < found.count() < core.count()
