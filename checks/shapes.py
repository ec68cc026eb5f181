"""The given test tables projected to the shapes the library works on. Every column is derived, nothing is made up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2000-12-31"
# The loan and collateral tables hold these snapshots; one of them no query asks for.
EARLIER, UNWANTED = "2000-09-30", "2000-10-31"
CHECK_DATE = "2024-01-30"
PRODUCTIVE = ("click", "view", "purchase")
SCHEMAS: dict = {}


class Tables:
    """Lazy access to the given Parquet tables and the shapes derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:  # a catalog would know it without opening a file
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    # --- loans ---

    def core_loans(self) -> DataFrame:
        """Every order at one date or several: some come late, some are gone at the last date, and values move."""
        key, kind = F.col("o_orderkey"), F.col("at.kind")
        opened = F.to_date("o_orderdate")
        o = _at_dates(self.given("orders"), {
            AS_OF: key % 23 != 5, EARLIER: (key % 4 == 0) | (key % 23 == 5), UNWANTED: key % 6 == 0})
        return o.select(
            key.alias("loan_id"),
            F.concat(F.lit("LN-"), key).alias("loan_number"),
            F.col("o_orderpriority").alias("loan_type_code"),
            F.lower("o_orderpriority").alias("loan_type_description"),
            F.when(F.col("o_orderstatus") == "F", "1-a").when(F.col("o_orderstatus") == "O", "1-b").alias("call_report_code"),
            F.when(key % 3 == 0, "NOO").when(key % 3 == 1, "OO").alias("occupancy_type_code"),
            (key % 3 == 1).alias("owner_occupied_flag"),
            _product(key).alias("product_type"),
            F.when((key % 13 == 0) & ((kind == 0) | (key % 8 == 0)), "PAID_OFF").when(key % 13 != 1, "ACTIVE").alias("loan_status"),
            F.concat(F.lit("P"), key % 4).alias("purpose_code"),
            (F.col("o_totalprice") * 1.25).alias("committed_balance"),
            (F.col("o_totalprice") + kind * (key % 3) * 10).alias("outstanding_balance"),
            (F.col("o_totalprice") * 0.25).alias("unfunded_balance"),
            opened.alias("origination_date"),
            F.when(key % 17 != 0, F.date_add(opened, (30 * (12 + key % 85)).cast("int"))).alias("maturity_date"),
            F.lit(None).cast("date").alias("modification_date"),
            F.when(key % 19 != 0, (24 + 60 * (key % 5)).cast("int")).alias("original_amortization_term"),
            F.when(key % 4 == 0, 24).alias("io_period_months"),
            F.when(key % 4 == 0, F.date_add(opened, 730)).alias("io_end_date"),
            F.when(key % 2 == 0, "FIXED").otherwise("VARIABLE").alias("rate_type"),
            (3 + (key % 40) / 10).alias("interest_rate"),
            F.lit(None).cast("string").alias("index_type"),
            (key % 8).cast("double").alias("spread"),
            F.concat(F.lit("BR-"), key % 10).alias("branch_code"),
            F.concat(F.lit("LO-"), F.col("o_custkey") % 100).alias("loan_officer_id"),
            F.col("at.day").alias("as_of_date"),
        )

    def ncino_loans(self) -> DataFrame:
        """A phase for every order; some have no loan number, and some share the number of the order before."""
        key = F.col("o_orderkey")
        opened = F.to_date("o_orderdate")
        return self.given("orders").select(
            F.concat(F.lit("NC-"), key).alias("id"),
            F.when(key % 50 != 3, F.concat(F.lit("LN-"), key - F.when(key % 10 == 9, 1).otherwise(0))).alias("ll__loan_number__c"),
            F.col("o_custkey").cast("string").alias("ll__cif__c"),
            F.col("o_orderpriority").alias("ll__loan_type__c"),
            F.lit("OFFICE").alias("ll__property_type__c"),
            F.lit("NOO").alias("ll__occupancy_type__c"),
            _product(key).alias("ll__product_type__c"),
            F.lit("BOOKED").alias("ll__stage__c"),
            (F.col("o_totalprice") * 1.25).alias("ll__committed_amount__c"),
            F.col("o_totalprice").alias("ll__outstanding_principal__c"),
            opened.alias("ll__original_close_date__c"),
            F.date_add(opened, 3650).alias("ll__maturity_date__c"),
            (24 + 60 * (key % 5)).cast("int").alias("ll__amortization_term__c"),
            F.lit(24).alias("ll__io_period__c"),
            F.lit("FIXED").alias("ll__rate_type__c"),
            (3 + (key % 40) / 10).alias("ll__interest_rate__c"),
            F.when(key % 3 == 0, "CONSTRUCTION").when(key % 3 == 1, "MINI-PERM").otherwise("PERMANENT").alias("ll__loan_phase__c"),
            F.when(key % 7 != 0, F.date_add(opened, 365)).alias("ll__construction_to_perm_date__c"),
            F.lit("Loan").alias("recordtypename"),
            F.lit(AS_OF).cast("date").alias("as_of_date"),
        )

    def xref(self) -> DataFrame:
        line = F.col("l_linenumber")
        return self.given("lineitem").select("l_orderkey", "l_linenumber").distinct().select(
            F.col("l_orderkey").alias("loan_id"),
            (F.col("l_orderkey") * 10 + line).alias("collateral_id"),
            F.when(line == 2, "Y").when(line != 3, "N").alias("primary_flag"),
        )

    def core_collaterals(self) -> DataFrame:
        """Lines share (order, line number) pairs, so they are grouped to one collateral each; every third line also has older snapshots."""
        grouped = self.given("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.max("l_extendedprice").alias("top"),
            F.min("l_extendedprice").alias("low"),
            F.max("l_shipdate").alias("shipped"),
            F.min("l_partkey").alias("n"),
        )
        n, line, order = F.col("n"), F.col("l_linenumber"), F.col("l_orderkey")
        at_dates = _at_dates(grouped, {AS_OF: (line != 3) | (order % 7 != 0), EARLIER: line % 3 == 0, UNWANTED: line % 3 == 0})
        return at_dates.select(
            (order * 10 + line).alias("collateral_id"),
            F.when(line % 5 == 0, "EQUIP").otherwise("RE").alias("collateral_type_code"),
            F.concat(F.lit("Part "), n).alias("collateral_description"),
            F.when((line == 6) & (order % 4 == 0), "true").when(line == 1, "N").alias("primary_flag"),
            (F.col("top") + F.col("at.kind") * 1000).alias("appraised_value"),
            F.when(line != 4, F.to_date("shipped")).alias("appraisal_date"),
            F.col("low").alias("book_value"),
            _address(n).alias("street_address"),
            F.concat(F.lit(" City"), n % 50).alias("city"),
            _state(n).alias("state_code"),
            _zip(n).alias("zip_code"),
            F.col("at.day").alias("as_of_date"),
        )

    def march_set(self) -> DataFrame:
        o = self.given("orders").where(F.year("o_orderdate") <= 1997)
        return o.select(F.col("o_orderkey").alias("loan_id"), F.concat(F.lit("LN-"), "o_orderkey").alias("loan_number"))

    def december_set(self) -> DataFrame:
        """Finished orders, and for every 750th order a key far above the range of the table."""
        o = self.given("orders")
        known = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 10 != 0)).select(F.col("o_orderkey").alias("loan_id"))
        beyond = o.where(F.col("o_orderkey") % 750 == 0).select((F.col("o_orderkey") + 10**12).alias("loan_id"))
        both = known.unionByName(beyond)
        return both.withColumn("loan_number", F.concat(F.lit("LN-"), "loan_id"))

    # --- workforce ---

    def log(self) -> DataFrame:
        return self.given("events").select(
            F.col("ts").alias("tstamp"), F.col("user_id").cast("string").alias("payroll"),
            F.lit(None).cast("string").alias("oldstatus"), F.col("event_type").alias("newstatus"),
        )

    def _agent_days(self) -> DataFrame:
        days = self.given("events").select("user_id", F.to_date("ts").alias("day")).distinct()
        return days.withColumn("roster_key", F.col("user_id") * 100000 + F.unix_date("day"))

    def roster(self) -> DataFrame:
        midnight = F.col("day").cast("timestamp_ntz")
        return self._agent_days().select(
            "roster_key", F.col("user_id").cast("string").alias("payroll"),
            F.lit("1899-12-30 08:00:00").cast("timestamp_ntz").alias("start"),
            F.lit("1899-12-30 17:00:00").cast("timestamp_ntz").alias("finish"),
            F.lit(8.0).alias("hours"), midnight.alias("lastmodify"), midnight.alias("rdate"),
        )

    def breaks(self) -> DataFrame:
        slots = [(585, 600, 1, "Break"), (600, 660, 0, "Meeting"), (705, 765, 1, "Lunch"), (885, 900, 1, "Break")]
        entries = F.array(*[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(k).alias("k"), F.lit(t).alias("t")) for a, b, k, t in slots
        ])
        midnight = F.col("day").cast("timestamp_ntz")
        return self._agent_days().withColumn("e", F.explode(entries)).select(
            "roster_key", F.col("user_id").cast("string").alias("person"),
            F.timestamp_add("MINUTE", F.col("e.a"), midnight).alias("from"),
            F.timestamp_add("MINUTE", F.col("e.b"), midnight).alias("to"),
            F.col("e.k").alias("break"), F.col("e.t").alias("label"), F.lit("").alias("notes"),
        )

    def _timed(self, kind: str, shift: int) -> DataFrame:
        minutes = F.round("value").cast("int") + shift
        return self.given("events").where(F.col("event_type") == kind).withColumn(
            "until", F.timestamp_add("MINUTE", minutes, F.col("ts"))
        )

    def leave(self) -> DataFrame:
        kind = F.when(F.col("event_id") % 2 == 0, "Protected Leave").otherwise("PTO - Vacation")
        return self._timed("error", 0).select(
            F.col("user_id").cast("string").alias("payroll"), F.col("ts").alias("start"), F.col("until").alias("stop"),
            F.lit(1).alias("days"), F.lit(8.0).alias("hours"), kind.alias("type"),
        )

    def partial_leave(self) -> DataFrame:
        kind = F.when(F.col("event_id") % 2 == 0, "Late Arrival").otherwise("Early Dept - Flex")
        return self._timed("signup", -30).select(
            F.col("user_id").cast("string").alias("payroll"), F.col("ts").alias("leavestart"),
            F.col("until").alias("leavefinish"), kind.alias("leavetype"),
        )

    def personnel(self) -> DataFrame:
        return self.given("customer").select(
            F.col("c_custkey").cast("string").alias("payroll"), F.concat(F.lit("S"), F.col("c_custkey") % 7).alias("surname"),
            F.col("c_name").alias("firstname"), F.concat(F.lit("TEAM_"), F.col("c_nationkey")).alias("team"),
            F.col("c_mktsegment").alias("lob"),
        )

    # --- records and raw text ---

    def records(self) -> DataFrame:
        o, c = self.given("orders"), self.given("customer")
        return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("category"), F.month("o_orderdate").alias("month"),
            F.col("c_mktsegment").alias("item"), F.col("o_totalprice").alias("value"),
            (F.col("o_orderstatus") == "F").cast("int").alias("accepted"),
        )

    def changes(self) -> DataFrame:
        """Events as edits: of id event_id % 1000, of one of three fields, in order of event_id."""
        e, n = self.given("events"), F.col("event_id")
        return e.select(
            (n % 1000).alias("id"),
            F.when(n % 3 == 0, "month").when(n % 3 == 1, "accepted").otherwise("item").alias("field"),
            F.when(n % 3 == 0, (1 + n % 12).cast("string")).when(n % 3 == 1, (n % 2).cast("string")).otherwise(F.col("event_type")).alias("new_value"),
            n.alias("seq"),
        )

    def raw_text(self) -> DataFrame:
        k = F.col("p_partkey")
        serial = 40000 + k % 8000
        iso = F.date_add(F.lit("2001-01-01").cast("date"), (k % 3000).cast("int"))
        return self.given("part").select(
            "p_partkey",
            F.when(k % 12 == 8, F.date_format(iso, "M/d/yy")).when(k % 12 == 9, F.date_format(iso, "d-MMM-yy"))
            .when(k % 12 == 10, F.regexp_replace(F.date_format(iso, "MMMM d, yyyy"), "September", "Sept"))
            .when(k % 12 == 11, F.concat(F.date_format(iso, "MMM d, yyyy"), F.lit(" 10:00")))
            .when(k % 8 == 0, serial.cast("string"))
            .when(k % 8 == 1, F.concat(serial.cast("string"), F.lit(".5")))
            .when(k % 8 == 2, F.date_format(iso, "yyyy-MM-dd"))
            .when(k % 8 == 3, F.lit("  "))
            .when(k % 8 == 4, F.lit("junk"))
            .when(k % 8 == 5, F.lit(" Yes "))
            .when(k % 8 == 6, F.lit("0"))
            .otherwise(F.lit("1.5"))
            .alias("raw"),
        )

    def addresses(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.given("part").select("p_partkey", _address(k).alias("street"), _zip(k).alias("zip"), _state(k).alias("state"))


def _at_dates(df: DataFrame, held: dict[str, Column]) -> DataFrame:
    """Every row once for each date whose condition holds, as `at`: the date and its number in `held`."""
    entries = [F.when(c, F.struct(F.lit(d).cast("date").alias("day"), F.lit(i).alias("kind"))) for i, (d, c) in enumerate(held.items())]
    return df.withColumn("at", F.explode(F.array_compact(F.array(*entries))))


def _product(key: Column) -> Column:
    return F.when(key % 11 == 0, "ARC").when(key % 11 == 1, "CONSTRUCTION").otherwise("TERM")


def _address(n: Column) -> Column:
    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    return (
        F.when(n % 8 == 1, "   ").when(n % 8 == 2, text("PO BOX ", n)).when(n % 8 == 3, text("P.O. ", n))
        .when(n % 8 == 4, text(n, " Name St")).when(n % 8 == 5, text(n, " NAME ST")).when(n % 8 == 6, text(" ", n, " Name"))
        .when(n % 8 == 7, text(n, "a Name Ave."))
    )


def _zip(n: Column) -> Column:
    five = F.lpad((n % 100000).cast("string"), 5, "0")
    return F.when(n % 4 == 0, five).when(n % 4 == 1, F.concat(five, F.lit("-1234"))).when(n % 4 == 2, F.left(five, F.lit(4)))


def _state(n: Column) -> Column:
    return (
        F.when(n % 6 == 0, "FL").when(n % 6 == 1, " tx ").when(n % 6 == 2, "New York").when(n % 6 == 3, "PUERTO RICO")
        .when(n % 6 == 4, "XX").otherwise(" ")
    )
