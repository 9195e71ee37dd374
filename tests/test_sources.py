from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThan, InputPartition

from tests.conftest import rows_of
from tidemark.model import COLUMN_CATALOGUE, CheckpointSpec, ObjectSpec, Run
from tidemark.operators.transforms import void_to_string
from tidemark.sources import columns as co
from tidemark.sources.files import read_documents, read_files
from tidemark.sources.readers import (
    JdbcSpec,
    jdbc_loader,
    json_loader,
    parquet_loader,
    read_connector,
    read_source,
    wide_column_loader,
)

RUN = Run(datetime(2024, 5, 1), "/lake", region="eu-west-1")


def spec(system, method, table="t", target="t", checkpoints=()):
    return ObjectSpec("ns", table, target, system, method, checkpoints=checkpoints)


class _Reader(DataSourceReader):
    """A stand-in for a connector: four partitions, and a pushed comparison."""

    def __init__(self, options):
        self.table, self.low = options["table"], -1

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, GreaterThan) and f.attribute == ("id",):
                self.low = f.value
            else:
                yield f

    def partitions(self):
        return [InputPartition(i) for i in range(4)]

    def read(self, partition):
        for i in range(partition.value, 100, 4):
            if i > self.low:
                yield (i, f"{self.table}-{i}")


class _Source(DataSource):
    @classmethod
    def name(cls):
        return "wide_stand_in"

    def schema(self):
        return "id bigint, label string"

    def reader(self, schema):
        return _Reader(self.options)


@pytest.fixture
def wide(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(_Source)
    return {"CASSANDRA": wide_column_loader("wide_stand_in")}


def test_connector_full_read(spark, wide):
    rows = read_connector(spark, "wide_stand_in", table="t")
    assert rows.count() == 100 and rows.rdd.getNumPartitions() == 4
    assert read_source(spark, spec("CASSANDRA", "FULL_EXTRACT"), wide, RUN).count() == 100


def test_connector_checkpoint_read(spark, wide):
    one = spec("cassandra", "KEY_INCR_EXTRACT", checkpoints=(CheckpointSpec("id", "numeric", ">", "90"),))
    assert read_source(spark, one, wide, RUN).count() == 9


@pytest.mark.parametrize(
    "system,method",
    [("ORACLE", "FULL_EXTRACT"), ("MYSQL", "FULL_EXTRACT"), ("CASSANDRA", "SOMETIMES")],
)
def test_unknown_pairs_are_refused(spark, wide, system, method):
    with pytest.raises(ValueError):
        read_source(spark, spec(system, method), wide, RUN)


def test_documents_have_no_checkpoint_read(spark, tmp_path):
    with pytest.raises(ValueError, match="no checkpoint"):
        read_source(
            spark, spec("MONGODB", "KEY_INCR_EXTRACT"), {"MONGODB": json_loader(str(tmp_path))}, RUN
        )


def test_documents(spark, tmp_path):
    path = tmp_path / "docs"
    path.mkdir()
    (path / "a.json").write_text('{"id": 1, "n": {"x": null, "y": 2}, "e": []}\n{"id": 2}\n')
    rows = void_to_string(read_documents(spark, str(path)))
    assert "void" not in rows.schema.simpleString()
    assert rows.where("n.y = 2").count() == 1
    given = read_documents(spark, str(path), schema="id bigint")
    assert given.columns == ["id"] and given.count() == 2
    tagged = read_source(
        spark,
        spec("MONGODB", "FULL_EXTRACT", "docs", "docs-AU"),
        {"MONGODB": json_loader(str(tmp_path))},
        RUN,
    )
    assert {r.ITB_DB_REGION for r in tagged.collect()} == {"AU"}


def test_unknown_region_is_refused(spark, tmp_path):
    spark.createDataFrame([(1, "NA")], "id int, preference_region string").write.parquet(
        str(tmp_path / "partners")
    )
    loaders = {"MYSQL": parquet_loader(str(tmp_path), "")}
    one = spec("MYSQL", "FULL_EXTRACT", "partners")
    assert read_source(spark, one, loaders, RUN).count() == 1
    with pytest.raises(ValueError, match="market regions"):
        read_source(spark, one, loaders, Run(RUN.run_ts, "/lake", region="moon-1"))


def test_file_lists(spark, customers, tmp_path):
    with pytest.raises(ValueError):
        read_files(spark, [])
    assert read_files(spark, [], customers.schema).isEmpty()
    path = str(tmp_path / "c")
    customers.write.parquet(path)
    assert rows_of(read_files(spark, [path], customers.schema)) == rows_of(customers)


# No database is started for tests, so relational reads are checked up to the
# options handed to Spark's own reader.


def test_jdbc_options():
    whole = JdbcSpec("jdbc:x", table="orders", driver="d", user="u", password="p")
    assert whole.reader_options() == {
        "url": "jdbc:x",
        "dbtable": "orders",
        "driver": "d",
        "user": "u",
        "password": "p",
        "fetchsize": "10000",
    }
    assert "p'" not in repr(whole) and "password" not in repr(whole)
    split = JdbcSpec(
        "jdbc:x", table="orders", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=3
    ).reader_options()
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "3")
    assert JdbcSpec("jdbc:x", query="select 1").reader_options()["query"] == "select 1"
    sliced = JdbcSpec(
        "jdbc:x",
        query="select 1",
        partition_column="id",
        lower_bound=0,
        upper_bound=9,
        num_partitions=3,
    ).reader_options()
    assert sliced["dbtable"] == "(select 1) sliced" and "query" not in sliced


@pytest.mark.parametrize(
    "bad",
    [
        JdbcSpec("jdbc:x"),
        JdbcSpec("jdbc:x", table="t", query="q"),
        JdbcSpec("jdbc:x", table="t", partition_column="id"),
        JdbcSpec("jdbc:x", table="t", num_partitions=4),
    ],
)
def test_jdbc_options_that_cannot_work(bad):
    with pytest.raises(ValueError):
        bad.reader_options()


def test_jdbc_loader_splits(spark, monkeypatch):
    from tidemark.sources import readers

    seen, bounds = [], {"SELECT min(id) AS low, max(id) AS high FROM big": (3, 90)}

    def fake(_, s):
        seen.append(s)
        s.reader_options()
        return spark.createDataFrame([bounds.get(s.query, (None, None))], "low int, high int")

    monkeypatch.setattr(readers, "read_jdbc", fake)
    load = jdbc_loader(JdbcSpec("jdbc:x", query="ignored"), {"big": ("id", 8), "empty": ("id", 8)})
    for name in ("big", "small", "empty"):
        load(spark, spec("MYSQL", "FULL_EXTRACT", name))
    big, small, empty = (s for s in seen if s.query is None)
    assert (big.table, big.lower_bound, big.upper_bound, big.num_partitions) == ("big", 3, 90, 8)
    assert (small.table, small.num_partitions) == ("small", None)
    assert (empty.table, empty.partition_column) == ("empty", None)
    assert small.driver == "com.mysql.cj.jdbc.Driver"


def test_relational_catalogue_reads_five_columns(spark, monkeypatch):
    seen = []

    def fake(_, s):
        seen.append(s.table)
        return spark.createDataFrame(
            [("d", "s", "t", "c", "int", 1)],
            "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, "
            "DATA_TYPE string, ORDINAL_POSITION int",
        )

    monkeypatch.setattr(co, "read_jdbc", fake)
    found = co.read_columns(spark, JdbcSpec("jdbc:x", table="any"))
    assert seen == ["information_schema.columns"]
    assert found.columns == COLUMN_CATALOGUE.names and found.first().data_type == "int"


def test_catalogue_of_all_tables(spark, sf):
    frames = {
        n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("region", "orders", "embeddings")
    }
    found = co.discover_columns(co.from_frames(spark, frames, "lake", "bronze"))
    assert found.count() == sum(len(f.columns) for f in frames.values())
    kinds = {r.column_name: r.data_type for r in found.collect()}
    assert kinds["o_orderdate"] == "timestamp_ntz" and kinds["embedding"] == "array<float>"
    found.write.mode("overwrite").saveAsTable("catalogue_copy")
    assert spark.table("catalogue_copy").where(F.col("table_name") == "region").count() == 2
    spark.sql("DROP TABLE catalogue_copy")
