import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, app_name="clickstream-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cs-test-ckpt-")})
    yield s
    s.stop()

