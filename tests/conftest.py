import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest  # noqa: E402

from footfall import build_session  # noqa: E402
from footfall.session import remove_work_dirs  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "footfall-tests",
        master="local[4]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_work_dirs(session)
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh folder's path as text."""
    return lambda name: str(tmp_path / name)


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over one text column ``x``."""

    def run(expression, values, kind="string"):
        df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
        return [row[0] for row in df.select(expression).collect()]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
