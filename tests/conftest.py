import tempfile

import pytest

from martlab.session import build_session


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="martlab-tests-")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df, whole: bool = False) -> str:
    """Physical plan; `whole` keeps long filter lists in full."""
    if not whole:
        return df._jdf.queryExecution().executedPlan().toString()
    jvm = df.sparkSession._jvm
    mode = getattr(getattr(jvm.org.apache.spark.sql.execution, "ExplainMode$"), "MODULE$").fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def optimized_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
