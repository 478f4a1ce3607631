import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("tickwise-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def feed_row(**kw):
    """One feed record; numbers become strings like the real feed."""
    base = dict(symbol="TESTUSDT", lastPrice="100", priceChangePercent="0",
                volume="1000", bidPrice="99.99", askPrice="100.01", openPrice="100",
                highPrice="101", lowPrice="99", quoteVolume="100000")
    base.update({k: (None if v is None else str(v)) for k, v in kw.items()})
    return base
