"""Source freshness, run decisions and the run log."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import write_table

LOG_SCHEMA = (
    "log_id long, run_timestamp timestamp, status string, message string, sources_ready boolean, already_ran boolean, "
    "error_detail string"
)
SUCCESS, SKIPPED_SOURCES, ALREADY, ERROR = "SUCCESS", "SKIPPED_SOURCES", "SKIPPED_ALREADY_RAN", "ERROR"
# Log messages.
MESSAGES = {
    ALREADY: "Pipeline refresh skipped. Project already ran.",
    SKIPPED_SOURCES: "Pipeline refresh skipped. Underlying sources not ready.",
    SUCCESS: "Pipeline refreshed successfully.",
    ERROR: "Pipeline refresh failed during dbt execution.",
}
FRESHNESS_FAILED = "Pipeline refresh skipped. Could not validate source freshness."


def _date(day: Column | str | None) -> Column:
    if day is None:
        return F.current_date()
    return F.lit(day).cast("date") if not isinstance(day, Column) else day


def source_freshness(sources: Mapping[str, tuple[DataFrame, str]], check_date: Column | str | None = None) -> DataFrame:
    """Latest date of every source and whether it is the check date; NULL for a source without dates."""
    latest = [
        df.agg(F.max(F.col(column).cast("date")).alias("latest_prod_date")).select(
            F.lit(name).alias("source_name"), "latest_prod_date"
        )
        for name, (df, column) in sources.items()
    ]
    table = reduce(DataFrame.unionByName, latest).withColumn("check_date", _date(check_date))
    return table.withColumn("is_current", F.col("latest_prod_date") == F.col("check_date"))


def sources_ready(freshness: DataFrame) -> DataFrame:
    """One row: number of sources, number current, and whether there are any and all are current."""
    counted = freshness.agg(F.count("*").alias("total_sources"), F.count_if("is_current").alias("ready_sources"))
    ready = (F.col("total_sources") > 0) & (F.col("total_sources") == F.col("ready_sources"))
    return counted.withColumn("sources_ready", ready)


def all_true(df: DataFrame, flag: str) -> DataFrame:
    """One row: whether every flag is true; FALSE for no rows."""
    return df.agg(F.coalesce(F.bool_and(flag), F.lit(False)).alias("all_true"))


def run_decision(log: DataFrame, freshness: DataFrame, today: Column | str | None = None,
                 now: Column | str | None = None) -> DataFrame:
    """The log row this run should write: skipped because it ran or sources lag, otherwise SUCCESS when it is run."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp") if isinstance(now, str) else now
    ran_today = (F.col("status") == SUCCESS) & (F.col("run_timestamp").cast("date") == _date(today))
    history = log.agg(
        (F.coalesce(F.max("log_id"), F.lit(0)) + 1).cast("long").alias("log_id"),
        (F.count_if(ran_today) > 0).alias("already_ran"),
    )
    ready = sources_ready(freshness).select(
        F.lit(None).cast("long").alias("log_id"), F.lit(None).cast("boolean").alias("already_ran"), "sources_ready"
    )
    both = history.withColumn("sources_ready", F.lit(None).cast("boolean")).unionByName(ready).agg(
        F.max("log_id").alias("log_id"), F.bool_or("already_ran").alias("already_ran"), F.bool_or("sources_ready").alias("sources_ready")
    )
    status = F.when(F.col("already_ran"), ALREADY).when(~F.col("sources_ready"), SKIPPED_SOURCES).otherwise(SUCCESS)
    table = F.create_map(*[F.lit(v) for pair in MESSAGES.items() for v in pair])
    return both.withColumn("status", status).select(
        "log_id",
        stamp.alias("run_timestamp"),
        "status",
        F.element_at(table, F.col("status")).alias("message"),
        F.when(~F.col("already_ran"), F.col("sources_ready")).alias("sources_ready"),
        "already_ran",
        F.lit(None).cast("string").alias("error_detail"),
    )


def append_log(row: DataFrame, table: str) -> int:
    return write_table(row, table, if_exists="append")


def last_runs(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.col("run_timestamp").desc(), F.col("log_id").desc()).limit(n)


class RunClaim:
    """The right to run a task on a day, held as a folder that only one caller can create.

    The folder lies in `root`, which all schedulers share. A run that succeeded keeps its claim; one that failed gives it back. The
    claim of a scheduler that died stays until `release` is called.
    """

    def __init__(self, spark: SparkSession, root: str, task: str, day: str):
        jvm = spark._jvm
        name = "".join(c if c.isalnum() else f"_{ord(c):x}_" for c in f"{task}@{day}")
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/claims/{name}")
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def take(self) -> bool:
        """Whether this caller got the claim."""
        self._fs.mkdirs(self._path.getParent())
        if self._fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then; mkdir is one step
            return self._jvm.java.io.File(self._path.toUri().getPath()).mkdir()
        try:
            self._fs.create(self._path, False).close()
            return True
        except Exception:
            if self._fs.exists(self._path):
                return False
            raise

    def release(self) -> None:
        self._fs.delete(self._path, True)


def gated_run(
    spark: SparkSession,
    log_table: str,
    freshness: Callable[[], DataFrame],
    job: Callable[[], None],
    *,
    today: Column | str | None = None,
    now: Column | str | None = None,
    claim: RunClaim | None = None,
) -> str:
    """Run `job` once a day when all sources are current, and log the outcome. Returns the status.

    With a `claim`, of several schedulers that pass the gate at once one runs the job and the others skip it.
    """
    log = spark.table(log_table)
    empty = spark.createDataFrame([], "source_name string, is_current boolean")
    row = run_decision(log, empty, today, now)

    def record(status: str, message: str, ready: bool | None, ran: bool, detail: str | None) -> str:
        values = {
            "status": F.lit(status), "message": F.lit(message), "sources_ready": F.lit(ready).cast("boolean"),
            "already_ran": F.lit(ran), "error_detail": F.lit(detail).cast("string"),
        }
        append_log(row.withColumns(values), log_table)
        return status

    if row.first()["already_ran"]:
        return record(ALREADY, MESSAGES[ALREADY], None, True, None)
    try:
        ready = sources_ready(freshness()).first()["sources_ready"]
    except Exception as error:
        return record(ERROR, FRESHNESS_FAILED, None, False, str(error))
    if not ready:
        return record(SKIPPED_SOURCES, MESSAGES[SKIPPED_SOURCES], False, False, None)
    if claim and not claim.take():
        return record(ALREADY, MESSAGES[ALREADY], None, True, None)
    try:
        job()
    except Exception as error:
        if claim:
            claim.release()
        return record(ERROR, MESSAGES[ERROR], True, False, str(error))
    return record(SUCCESS, MESSAGES[SUCCESS], True, False, None)


def set_control_flag(control: DataFrame, task: str, now: Column | str | None = None) -> DataFrame:
    """Control table with has_run and ran_at set for the task where it had not run yet."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp") if isinstance(now, str) else now
    due = (F.col("task_name") == task) & ~F.col("has_run")
    return control.withColumns(
        {"ran_at": F.when(due, stamp).otherwise(F.col("ran_at")), "has_run": F.col("has_run") | F.coalesce(due, F.lit(False))}
    ).select(*control.columns)
