import pytest


@pytest.fixture(scope="package", autouse=True)
def few_partitions(spark):
    """The fixtures here are small: fewer tasks for their many short steps."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)
