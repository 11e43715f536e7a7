import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candela.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8, app="candela-tests")
    yield s


def make_bars(spark, series: dict[str, list], start=dt.date(2020, 1, 1), high_low=None):
    """Bars from close lists (None = missing close); high/low = close +/- 1
    unless given; volume 100."""
    rows = []
    for t, closes in series.items():
        for i, c in enumerate(closes):
            d = start + dt.timedelta(days=i)
            hi = None if c is None else c + 1.0
            lo = None if c is None else c - 1.0
            if high_low:
                hi, lo = high_low(i, c)
            rows.append((d, t, c, hi, lo, None if c is None else float(c), 100))
    return spark.createDataFrame(
        rows, "date date, ticker string, open double, high double, low double, close double, volume bigint")
