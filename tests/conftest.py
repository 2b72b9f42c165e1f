import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import logtide  # noqa: E402
from logtide.session import build_session  # noqa: E402

cloudpickle.register_pickle_by_value(logtide)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "logtide-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def run_dir(spark):
    from logtide.session import new_run_dir

    return new_run_dir(spark, "test")
