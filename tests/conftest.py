import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from series_engine.session import get_session
    s = get_session(master="local[8]", app="series-engine-tests", shuffle_partitions=8,
                    conf={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, cols=None, digits=9):
    """Order-insensitive comparable form of a DataFrame (or list of Rows)."""
    data = df.collect() if hasattr(df, "collect") else df
    out = []
    for r in data:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        keys = cols or sorted(d)
        vals = []
        for k in keys:
            v = d[k]
            if isinstance(v, float):
                v = round(v, digits) + 0.0
            elif isinstance(v, list):
                v = tuple(round(e, digits) + 0.0 if isinstance(e, float) else e for e in v)
            vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)
