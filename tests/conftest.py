from __future__ import annotations

import glob
import os

import pytest

from tallyspark.session import build_session

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def graded() -> str:
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def shuffled(spark, small, tmp_path_factory) -> str:
    """The small tables as folders of seven files each, rows dealt out anew."""
    root = tmp_path_factory.mktemp("shuffled")
    for path in glob.glob(f"{small}/*.parquet"):
        spark.read.parquet(path).repartition(7).write.parquet(f"{root}/{os.path.basename(path)}")
    return str(root)
