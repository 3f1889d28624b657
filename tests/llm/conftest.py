import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from clickstream.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark
