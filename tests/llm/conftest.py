import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small fixtures run as many small jobs: two shuffle partitions are enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
