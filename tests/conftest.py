import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from statflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        4,
        spark__checkpoint__dir=str(home / "shared"),
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="4000",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plans(spark, after: int = -1) -> dict[int, str]:
    """The plans of everything that ran since an execution, also of what a query wrote on its way."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    runs = (found.apply(n) for n in range(found.size()))
    return {run.executionId(): run.physicalPlanDescription() for run in runs if run.executionId() > after}
