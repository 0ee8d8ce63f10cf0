from __future__ import annotations

import pytest

from tidemark.session import session_builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        session_builder("tidemark-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return "/root/testdata/sf0.001"
