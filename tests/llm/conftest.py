from __future__ import annotations

import pytest

from cartpath.llm.common import ready


@pytest.fixture(autouse=True)
def workers(spark):
    """Python workers must find the package, also where no query is run first."""
    return ready(spark)
