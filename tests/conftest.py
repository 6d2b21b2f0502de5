import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from donorlens.schemas import ORDERS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="donorlens-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", ckpt)
    yield s


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def orders_df(spark):
    """Build canonical orders from (customer, order_id, status, 'YYYY-MM-DD HH:MM', amount) rows."""
    from decimal import Decimal

    def make(rows):
        data = [(c, o, s, ts(t) if t else None, Decimal(str(a)) if a is not None else None)
                for c, o, s, t, a in rows]
        return spark.createDataFrame(data, ORDERS)
    return make


@pytest.fixture
def tmpdir_run():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
