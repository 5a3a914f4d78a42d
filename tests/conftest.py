import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="cartwright-tests-")
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/scratch",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_files(tmp_path_factory):
    from sample_day import write_files

    return write_files(tmp_path_factory.mktemp("extracts"))


@pytest.fixture(scope="session")
def sample_day(spark, sample_files, tmp_path_factory):
    """The sample day, landed: (landing root, load log)."""
    from cartwright.sources.loads import ingest

    from sample_day import DAY

    root = str(tmp_path_factory.mktemp("landing"))
    return root, ingest(spark, sample_files, root, DAY, run_id="r1")


@pytest.fixture(scope="session")
def warehouse(spark, sample_day):
    from sample_day import AS_OF, DAY, LOADED_AT

    from cartwright.plans.warehouse import open_landing

    return open_landing(spark, sample_day[0], DAY, AS_OF, loaded_at=LOADED_AT)
