import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskframe.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="riskframe-tests", shuffle_partitions=8)
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-tests-"))
    yield s


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture(scope="session")
def micro(spark):
    """FIXTURES.md section 3: two symbols, one portfolio, a missing FX day."""
    prices = spark.createDataFrame(
        [("A", D("2025-01-02"), 100.0), ("A", D("2025-01-03"), 110.0), ("A", D("2025-01-06"), 120.0),
         ("A", D("2025-01-07"), 99.0), ("B", D("2025-01-02"), 200.0), ("B", D("2025-01-03"), 200.0),
         ("B", D("2025-01-07"), 220.0)], "symbol string, date date, close double")
    from pyspark.sql import functions as F
    equity = prices.select("symbol", "date", F.col("close").alias("open"), F.col("close").alias("high"),
                           F.col("close").alias("low"), "close", F.lit(1).cast("bigint").alias("volume"),
                           F.lit("t").alias("source"))
    fx = spark.createDataFrame([("USDGBP", D("2025-01-02"), 0.5), ("USDGBP", D("2025-01-03"), 0.5),
                                ("USDGBP", D("2025-01-07"), 0.5), ("EURGBP", D("2025-01-06"), 0.9)],
                               "pair string, date date, rate double")
    dim = spark.createDataFrame([("A", "Alpha", "USD")], "symbol string, company_name string, currency string")
    txns = spark.createDataFrame(
        [("t1", "P1", "A", 10.0, D("2025-01-01"), "BUY"), ("t2", "P1", "B", 5.0, D("2025-01-03"), "BUY"),
         ("t3", "P1", "A", -4.0, D("2025-01-07"), "SELL"), ("t4", "P1", "A", 1.0, D("2025-01-07"), "BUY")],
        "transaction_id string, portfolio_id string, symbol string, quantity_delta double, "
        "transaction_date date, transaction_type string")
    bench = spark.createDataFrame([("SPY", D("2025-01-02"), 400.0), ("SPY", D("2025-01-03"), 404.0),
                                   ("SPY", D("2025-01-07"), 399.96)], "symbol string, date date, close double")
    return {"equity": equity, "fx": fx, "dim": dim, "txns": txns, "bench": bench}
