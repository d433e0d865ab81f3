import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from lectern.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "3g", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not Path(DATA).exists():
        pytest.skip("no test tables here")
    return DATA
