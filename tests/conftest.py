import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourcast.schemas import PSEUDO, STAGE1  # noqa: E402
from hourcast.session import get_spark  # noqa: E402

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hourcast-test-ckpt-"))
    yield s
    s.stop()


def at(h, base=T0):
    return base + dt.timedelta(hours=h)


def stage1(spark, rows, ref="2024-01-01"):
    """rows: (site, ensemble, variable, hour, horizon, value[, base])"""
    data = []
    for r in rows:
        site, ens, var, h, hz, v = r[:6]
        base = r[6] if len(r) > 6 else T0
        data.append((site, "ensemble", ens, hz, at(h, base), var, v, ref))
    return spark.createDataFrame(data, STAGE1)


def pseudo(spark, rows):
    """rows: (site, ensemble, variable, hour, horizon, cycle, value, ref)"""
    data = [(s, "ensemble", e, hz, cy, at(h), var, v, ref) for s, e, var, h, hz, cy, v, ref in rows]
    return spark.createDataFrame(data, PSEUDO)


def series(df, site, ens, var):
    return {r["datetime"]: r["prediction"] for r in
            df.filter((df.site_id == site) & (df.ensemble == ens) & (df.variable == var)).collect()}
