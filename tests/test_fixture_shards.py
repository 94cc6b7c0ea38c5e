from pyspark.sql import functions as F

from tessera.operators import dedup as DD
from tests.conftest import SF01


def test_every_source_has_four_shards(spark):
    from tessera.plans.inputs import Inputs
    shards = Inputs(spark, SF01).raw.groupBy("source").agg(F.count_distinct("shard").alias("n")).collect()
    assert {r.n for r in shards} == {4}


def test_greedy_decides_every_document_of_a_long_chain(spark):
    # document r shares a bucket with r + 1 only: one decision a round at the worst
    rows = [("s", r, b, f"{r - b}") for r in range(40) for b in (0, 1)]
    members = spark.createDataFrame(rows, "source string, rank long, band int, bucket string") \
        .select("source", "rank", F.lit(0).alias("band"), "bucket")
    got = {r["rank"]: r.kept for r in DD.greedy_first_wins(members).collect()}
    assert got == {r: r % 2 == 0 for r in range(40)}
