import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventmart.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[2]", app="eventmart-tests", shuffle_partitions=2,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="eventmart-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="eventmart-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="eventmart-test-")
