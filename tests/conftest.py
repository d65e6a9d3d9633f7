import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tradewind.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def generated(spark, tmp_path_factory):
    """A written data set of scale 0.01."""
    from tradewind.operators.warehouse import load_step
    from tradewind.sources.generate import Generator
    folder = str(tmp_path_factory.mktemp("generated"))
    load_step(Generator(spark, 0.01), folder)
    return folder
