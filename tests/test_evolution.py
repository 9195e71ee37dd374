import os

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan_of, rows_of
from tidemark.functions.widening import common_schema, common_type, widened
from tidemark.operators.transforms import with_row_hash
from tidemark.tables.appends import AppendTable
from tidemark.tables.hashes import HashIndexes
from tidemark.tables.partitions import PartitionedLoads


def kind(text):
    return T.StructType.fromDDL(f"v {text}")["v"].dataType


WIDER = [
    ("tinyint", "bigint", "bigint"),
    ("int", "smallint", "int"),
    ("int", "double", "double"),
    ("smallint", "float", "double"),
    ("float", "double", "double"),
    ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"),
    ("date", "timestamp_ntz", "timestamp_ntz"),
    ("array<int>", "array<bigint>", "array<bigint>"),
    ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:string>", "struct<B:string,a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
    ("array<struct<a:int>>", "array<struct<a:int,b:array<int>>>", "array<struct<a:int,b:array<int>>>"),
    ("void", "int", "int"),
]


@pytest.mark.parametrize("a, b, common", WIDER)
def test_common_types_are_least_upper_bounds(a, b, common):
    assert common_type(kind(a), kind(b)).simpleString().lower() == common
    found = common_type(kind(b), kind(a)).simpleString().lower()
    assert sorted(found) == sorted(common)
    assert common_type(kind(common), kind(a)).simpleString().lower() == common


@pytest.mark.parametrize(
    "a, b", [("bigint", "double"), ("string", "int"), ("decimal(38,0)", "decimal(38,10)"), ("timestamp", "timestamp_ntz")]
)
def test_pairs_without_a_common_type_name_the_field(a, b):
    with pytest.raises(ValueError, match="x.v"):
        common_schema(T.StructType.fromDDL(f"x struct<v:{a}>"), T.StructType.fromDDL(f"x struct<v:{b}>"))


def test_casts_keep_values_and_nulls(spark):
    rows = spark.sql(
        "SELECT 1 AS k, named_struct('a', 1, 'l', array(named_struct('n', 2), null)) AS s UNION ALL SELECT 2, null"
    )
    wide = T.StructType.fromDDL("k bigint, s struct<a:bigint,l:array<struct<n:double,m:string>>,z:date>, extra map<string,int>")
    got = {r.k: r for r in widened(rows, wide).collect()}
    assert got[1].s.a == 1 and got[1].s.l[0].n == 2.0 and got[1].s.l[0].m is None and got[1].s.l[1] is None
    assert got[2].s is None and got[1].extra is None


def test_a_slice_that_fits_nowhere_is_refused_and_leaves_the_table(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path), "t")
    table.append(spark.sql("SELECT 1 AS a"), slice_key="one")
    with pytest.raises(ValueError, match="'a'"):
        table.append(spark.sql("SELECT 'x' AS a"), slice_key="two")
    assert rows_of(table.read()) == [(1,)]


def test_a_failed_repeat_keeps_the_rows(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path), "t")
    table.append(spark.range(5), slice_key="one")
    failing = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.append(failing, slice_key="one")
    assert table.read().count() == 5
    # A reader that began before a repeat still finds its files.
    before = table.read()
    table.append(spark.range(3), slice_key="one")
    assert before.count() == 5 and table.read().count() == 3


def test_undone_slices(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path), "t")
    table.append(spark.range(5), slice_key="one")
    table.undo("one")
    table.undo("never")
    assert table.read().isEmpty() and table.read().columns == ["id"]
    table.append(spark.range(2), slice_key="two")
    assert table.read().count() == 2


def test_schemas_not_slices_reach_the_driver(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path), "t")
    for k in range(6):
        table.append(spark.range(k, k + 1).withColumn("id", F.col("id").cast("int" if k % 2 else "bigint")), slice_key=str(k))
    assert len(table._schemas()[0]) == 2
    assert rows_of(table.read()) == [(k,) for k in range(6)]


def test_comparing_indexes_moves_nothing(spark, sf, tmp_path):
    rows = with_row_hash(spark.read.parquet(f"{sf}/lineitem.parquet"))
    indexes = HashIndexes(spark, str(tmp_path), bucket_rows=1000)
    indexes.write(rows, 2, rows.count())
    indexes.write(rows.where("l_orderkey % 2 = 0"), 1, rows.count())
    fresh = indexes.new_hashes(2, 1)
    plan = plan_of(fresh)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert rows_of(fresh) == rows_of(rows.where("l_orderkey % 2 = 1").select("hash").distinct())


def test_an_index_is_shuffled_once(spark, tmp_path):
    rows = with_row_hash(spark.range(5000).toDF("v"))
    indexes = HashIndexes(spark, str(tmp_path), bucket_rows=500)
    name, context = "spark.sql.shuffle.partitions", spark.sparkContext
    before = spark.conf.get(name)
    spark.conf.unset(name)  # also where no number is set
    context.setJobGroup("index-once", "writing an index")
    try:
        indexes.write(rows, 1, 5000)
        assert spark.conf.get(name) == "200"
    finally:
        spark.conf.set(name, before)
    jobs = context.statusTracker().getJobIdsForGroup("index-once")
    context.setJobGroup("index-read", "reading it")
    stages = {s for j in jobs for s in context.statusTracker().getJobInfo(j).stageIds}
    ran = [s for s in stages if (info := context.statusTracker().getStageInfo(s)) and info.numCompletedTasks]
    assert len(ran) == 2  # one that hashes and counts, one that counts and writes
    files = [f for f in os.listdir(f"{tmp_path}/snapshot_id=1/buckets=16") if f.endswith(".parquet")]
    assert len(files) == 16 and all(".zstd." in f for f in files)
    assert indexes.read(1).agg(F.count(F.lit(1)), F.sum("copies")).first()[:] == (5000, 5000)


def test_a_hot_row_is_one_entry(spark, tmp_path):
    rows = with_row_hash(spark.range(10_000).selectExpr("IF(id < 9000, 1, id) AS v"))
    indexes = HashIndexes(spark, str(tmp_path))
    indexes.write(rows, 1, 10_000)
    assert indexes.read(1).count() == 1001 and indexes.read(1).agg(F.max("copies")).first()[0] == 9000


def test_outgrown_buckets_still_compare(spark, tmp_path):
    rows = with_row_hash(spark.range(3000).toDF("v"))
    indexes = HashIndexes(spark, str(tmp_path), bucket_rows=500)
    indexes.write(rows.where("v < 100"), 1, 100)
    indexes.write(rows, 2, 3000)
    assert indexes.buckets(100) == 1 and indexes.buckets(3000) == 8
    assert indexes.new_hashes(2, 1).count() == 2900
    indexes.retire({2})
    assert indexes.has(2) and not indexes.has(1)


def test_partitions_prune(spark, run, customers, tmp_path):
    loads = PartitionedLoads(spark, str(tmp_path), "customer")
    loads.write(customers, run, "incr_load")
    rows = loads.after("incr_load", run.hour, customers.schema)
    assert "PartitionFilters: [isnotnull(load_kind" in plan_of(rows) and rows.isEmpty()
    assert loads.latest("incr_load").count() == customers.count()
    with pytest.raises(ValueError, match="load_kind"):
        loads.write(customers.withColumn("load_kind", F.lit("x")), run, "incr_load")


def test_dynamic_pruning_of_a_stored_child(spark, sf, tmp_path):
    from tidemark.operators.changes import region_semi_pruned

    path = f"{tmp_path}/by-nation"
    spark.read.parquet(f"{sf}/customer.parquet").write.partitionBy("c_nationkey").parquet(path)
    nations = spark.read.parquet(f"{sf}/nation.parquet")
    rows = region_semi_pruned(
        spark.read.parquet(path), nations, "c_nationkey", "n_nationkey", "n_name", "west", {"west": ("FRANCE", "GERMANY")}
    )
    assert "dynamicpruning" in plan_of(rows).lower()


def test_hash_text_ignores_the_order_of_maps_at_any_depth(spark):
    one = spark.sql("SELECT map('a', map('x', 1, 'y', 2), 'b', map('z', 3)) AS m, array(map(2, 'p', 1, 'q')) AS l, cast(null AS map<string,int>) AS n")
    two = spark.sql("SELECT map('b', map('z', 3), 'a', map('y', 2, 'x', 1)) AS m, array(map(1, 'q', 2, 'p')) AS l, cast(null AS map<string,int>) AS n")
    other = spark.sql("SELECT map('b', map('z', 3), 'a', map('y', 1, 'x', 2)) AS m, array(map(1, 'q', 2, 'p')) AS l, cast(null AS map<string,int>) AS n")
    hashes = [with_row_hash(rows).first()["hash"] for rows in (one, two, other)]
    assert hashes[0] == hashes[1] != hashes[2]


def test_maps_with_unusual_keys(spark):
    keyed = "map(named_struct('d', date'2024-01-01'), named_struct('m', map('a', null)), named_struct('d', date'2023-01-01'), null)"
    back = "map(named_struct('d', date'2023-01-01'), null, named_struct('d', date'2024-01-01'), named_struct('m', map('a', null)))"
    hashes = {with_row_hash(spark.sql(f"SELECT {m} AS m")).first()["hash"] for m in (keyed, back)}
    assert len(hashes) == 1
    for m in ("map(X'01', 1, X'02', 2)", "map(timestamp'2024-01-01', 1)"):
        assert with_row_hash(spark.sql(f"SELECT {m} AS m")).first()["hash"]
