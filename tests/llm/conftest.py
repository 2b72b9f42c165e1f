import pytest

from logtide.llm.workspace import Workspace


@pytest.fixture
def work(spark):
    return Workspace(spark, "llm-test")
