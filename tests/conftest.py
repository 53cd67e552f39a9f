import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paylens.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", "tests", **{
        "spark_sql_shuffle_partitions": "4", "spark_ui_enabled": "false", "spark_driver_memory": "4g",
        "spark_checkpoint_dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder():
    """A new scratch folder; it is left behind."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
