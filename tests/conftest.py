from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isohour.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return local_session(
        app="tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": warehouse},
    )
