import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from admitlab.session import get_spark
    wh = tempfile.mkdtemp(prefix="admitlab-wh-", dir=os.environ.get("TMPDIR", "/tmp"))
    s = get_spark("local[4]", 8, extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()
