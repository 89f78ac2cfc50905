import tempfile

import pytest
from pyspark.sql import SparkSession

from chronoloom import configure

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="chronoloom-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet")


@pytest.fixture()
def database(spark):
    from uuid import uuid4

    from chronoloom.session import shared_dir

    name = f"t_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
