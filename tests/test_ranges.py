import pytest
from pyspark.sql import functions as F

from tidemark.functions.predicates import checkpoint_predicate
from tidemark.model import KEY_INCR_EXTRACT, ObjectSpec
from tidemark.operators.checkpoint import specs_of
from tidemark.sources import readers
from tidemark.sources.ranges import in_ranges, range_filters, range_predicates, split_points


@pytest.mark.parametrize("column", ["v", "at", "price", "day"])
def test_each_row_is_in_one_range_of_like_size(spark, column):
    rows = spark.range(4000).selectExpr(
        "id * id AS v", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * id) AS at",
        "cast(pow(id, 1.5) AS decimal(12,2)) AS price", "date_add(date'1990-01-01', cast(id AS int)) AS day",
    )
    points = split_points(rows, column, 10)
    sizes = [rows.where(f).count() for f in range_filters(column, points)]
    assert len(sizes) == 10 and sum(sizes) == 4000 and max(sizes) < 2 * 400
    texts = [rows.where(p).count() for p in range_predicates(column, points)]
    assert texts == sizes
    numbered = {r["range"]: r["count"] for r in in_ranges(rows, column, points).groupBy("range").count().collect()}
    assert numbered == dict(enumerate(sizes))


def test_slices_are_cut_by_their_own_quantiles(spark):
    rows = spark.range(10_000).withColumnRenamed("id", "v")
    assert min(split_points(rows, "v", 4, F.col("v") >= 9000)) > 9000


def test_nulls_ties_and_nothing(spark):
    rows = spark.createDataFrame([(None,)] * 5 + [(1,)] * 50 + [(2,)], "v int")
    points = split_points(rows, "v", 4)
    assert sum(rows.where(f).count() for f in range_filters("v", points)) == 56
    assert sum(rows.where(p).count() for p in range_predicates("v", points)) == 56
    assert split_points(rows.limit(0), "v", 4) == [] and split_points(rows, "v", 1) == []
    assert rows.where(range_filters("v", [])[0]).count() == rows.where(range_predicates("v", [])[0]).count() == 56


def test_checkpoint_slices_of_relational_tables_are_read_in_ranges(spark, sf, monkeypatch):
    """Up to what is handed to the reader: no database may run here."""
    orders, handed = spark.read.parquet(f"{sf}/orders.parquet"), {}
    monkeypatch.setattr(readers, "read_jdbc", lambda _, spec: orders)

    def jdbc(self, url, table, predicates, properties):
        handed.update(url=url, table=table, predicates=predicates, properties=properties)
        return orders

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    specs = specs_of("o_orderkey::numeric::>", "500")
    one = ObjectSpec("shop", "orders", "orders", "POSTGRESQL", KEY_INCR_EXTRACT, checkpoints=specs)
    readers.jdbc_loader(readers.JdbcSpec("jdbc:x", user="u"), {"orders": ("o_orderkey", 4)})(spark, one)
    assert handed["table"] == "orders" and len(handed["predicates"]) == 4
    slice_of = orders.where(checkpoint_predicate(specs))
    sizes = [slice_of.where(p).count() for p in handed["predicates"]]
    assert sum(sizes) == slice_of.count() and max(sizes) < 2 * slice_of.count() / 4
    assert "numPartitions" not in handed["properties"] and handed["properties"]["user"] == "u"
