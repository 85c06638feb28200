import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from delaylens.session import build_session
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
