import __spark_entry__ as E
from tests.conftest import SF001


def test_registry_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"source", "reason", "docs"}
    total = sum(r.docs for r in rows if r.source == "TOTAL")
    assert total == spark.read.parquet(f"{SF001}/documents.parquet").count()
