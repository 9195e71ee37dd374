import pytest

from checks.compare import connect, differences
from tidemark.llm.queries import checks

ALL = checks()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in ALL.items() if sql))
def test_equals_its_sql(spark, sf, name):
    query, sql = ALL[name]
    assert differences(query(spark, sf), connect(sf), sql) is None


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in ALL.items() if not sql and n != "pipeline" and "op12" not in n))
def test_one_row_per_document(spark, sf, name):
    table = "pages" if name.startswith("op10") else "documents"
    assert ALL[name][0](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
