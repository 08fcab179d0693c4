import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfcast.settings import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Lower the hot-group limit so that small test groups are cut into pieces."""
    spark.conf.set("shelfcast.skew.hotRows", "40")
    yield
    spark.conf.unset("shelfcast.skew.hotRows")
