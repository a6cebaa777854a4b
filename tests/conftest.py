import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from tidewell.session import TASK_ROWS_KEY, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def small_tasks(spark):
    """Lower the per-task row limit so that small tables take the path of large ones."""
    spark.conf.set(TASK_ROWS_KEY, "40")
    yield 40
    spark.conf.unset(TASK_ROWS_KEY)


@pytest.fixture
def people(tmp_path):
    """The five rows that the file tests share, as a folder to write into."""
    rows = [(1, "Alice", 25, 95.5), (2, "Bob", 30, 80.3), (3, "Charlie", 35, 75.9), (4, "David", 40, 90.2), (5, "Eva", 45, 88.7)]
    return tmp_path, rows
