import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from nestloom.runtime import build_session

    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
