import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions.memory import release
from tessera.plans.inputs import Inputs
from tessera.session import small_batches
from tests.conftest import SF001

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_python_functions_get_bounded_batches(spark):
    """30 MB of text in one task: Spark's own bound would give them as one batch."""
    @F.arrow_udf("long")
    def size(rows: pa.Array) -> pa.Array:
        release()
        return pa.array([rows.nbytes] * len(rows), pa.int64())

    Inputs(spark, SF001)
    text = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert text.select(size("t").alias("n")).agg(F.max("n")).first()[0] <= 9 << 20


def test_a_bound_of_the_session_is_kept(spark):
    before = spark.conf.get(KEY, None)
    try:
        spark.conf.set(KEY, "1000000")
        small_batches(spark)
        assert int(spark.conf.get(KEY).rstrip("b")) == 1_000_000
    finally:
        spark.conf.set(KEY, before) if before is not None else spark.conf.unset(KEY)
