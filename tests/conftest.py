import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from trailmark.session import get_session
    s = get_session("local[4]", 4, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.checkpointLocation": tempfile.mkdtemp(prefix="tm-stream-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def logs(spark):
    from log_data import DATA
    from trailmark.sources.logs import read_log
    return {
        "order": read_log(spark, "order", os.path.join(DATA, "order_log.csv")).cache(),
        "receipt": read_log(spark, "receipt", os.path.join(DATA, "receipt_log.csv")).cache(),
        "login": read_log(spark, "login", os.path.join(DATA, "login_log.csv")).cache(),
    }
