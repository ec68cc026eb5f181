"""Files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the vendor input files.
VENDOR_INPUT_SCHEMA = (
    "loan_id string, loan_number string, loan_type_code string, call_report_code string, occupancy_type_code string, "
    "product_type string, outstanding_balance double, committed_balance double, origination_date date, "
    "maturity_date date, original_amortization_term_months int, io_period_months int, interest_rate double, "
    "rate_type string, collateral_id string, appraised_value double, appraisal_date date, street_address string, "
    "city string, state_code string, zip_code string, branch_code string, loan_officer_id string"
)
STATE_LOOKUP_SCHEMA = "full_name string, abbreviation string"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; the schema is declared, so the files are read once and ZIP codes keep their zeros.

    A header that does not match the schema, or a broken row, fails the job.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    # quotes are doubled inside quotes, and a quoted text may hold line breaks
    reader = reader.option("escape", '"').option("multiLine", True)
    return reader.csv(path)
