import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tradevigil.session import tune

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tradevigil-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tradevigil-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    from tradevigil.plans.views import SurveillanceViews

    return SurveillanceViews(spark, SF_DIR)


@pytest.fixture
def database(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tempfile.mkdtemp(prefix='tradevigil-db-')}'")
    return name


@pytest.fixture
def same_rows():
    def rows(df, columns=None):
        columns = columns or sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        assert rows(a) == rows(b)

    return check
