import sys
from pathlib import Path
from uuid import uuid4

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeferry import Warehouse  # noqa: E402
from lakeferry.session import start  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = start(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={root}/derby.log",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    tag = uuid4().hex[:8]
    return Warehouse(spark, f"masked_{tag}", f"raw_{tag}").create(str(tmp_path / "lake"))


def rows(frame):
    """All rows as tuples, in an order that does not depend on the plan."""
    return sorted(map(tuple, frame.collect()), key=repr)


def plan_of(frame) -> str:
    """The formatted plan, as explain() prints it."""
    view = f"plan_{uuid4().hex}"
    frame.createOrReplaceTempView(view)
    return frame.sparkSession.sql(f"EXPLAIN FORMATTED SELECT * FROM {view}").first()[0]
