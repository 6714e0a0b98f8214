from __future__ import annotations

import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

for folder in (pathlib.Path(__file__).resolve().parent, pathlib.Path(__file__).resolve().parent.parent):
    sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def stage(spark):
    from siftwork.plans.stage import Stage

    return Stage(spark)


@pytest.fixture()
def sample_folder(tmp_path):
    """The sample tables as CSV files."""
    from samples import TABLES, as_csv

    folder = tmp_path / "raw"
    folder.mkdir()
    for name in TABLES:
        (folder / f"{name}.csv").write_text(as_csv(name))
    return str(folder)


@pytest.fixture()
def sample_inputs(sample_folder):
    return {name: f"{sample_folder}/{name}.csv" for name in ("customers", "products", "orders")}
