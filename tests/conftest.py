import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session, remove_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="ledgerlake-wh-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra_conf={"spark.sql.warehouse.dir": warehouse,
                                  "spark.driver.memory": "4g"})
    yield s
    remove_scratch(s)
    s.stop()


def rows(df, *cols):
    """Collect as sorted list of tuples (optionally selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
