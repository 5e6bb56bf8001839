import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMOKE = [
    ("C1", 100.0, 10.0, "2025-01-01 12:00:00", "A", "web", 0),
    ("C1", 50.0, 5.0, "2025-01-02 13:00:00", "A", "app", 0),
    ("C2", 200.0, 20.0, "2025-01-01 10:00:00", "B", "web", 1),
    ("C2", 150.0, 15.0, "2025-01-03 14:00:00", "B", "web", 1),
]
SMOKE_SCHEMA = "CustomerId string, Amount double, Value double, t string, ProductCategory string, ChannelId string, FraudResult int"


@pytest.fixture(scope="session")
def smoke(spark):
    """Four transactions of two customers, with goldens worked out by hand."""
    df = spark.createDataFrame(SMOKE, SMOKE_SCHEMA)
    return df.selectExpr("CustomerId", "Amount", "Value", "cast(t as timestamp) as TransactionStartTime", "ProductCategory", "ChannelId", "FraudResult")


def by_key(df, key="CustomerId"):
    return {r[key]: r.asDict() for r in df.collect()}
