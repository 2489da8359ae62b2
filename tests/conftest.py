import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pipewright import get_spark
    wh = tempfile.mkdtemp(prefix="pw-warehouse-")
    s = get_spark("local[4]", 4, app="pipewright-tests", extra={"spark.sql.warehouse.dir": wh})
    yield s


@pytest.fixture(scope="session")
def duck001():
    from pipewright.oracle.compare import duck_connect
    return duck_connect(SF001)


@pytest.fixture(scope="session")
def duck01():
    from pipewright.oracle.compare import duck_connect
    return duck_connect(SF01)
