import pytest

from tidemark import session


class _Conf:
    def get(self, *_):
        return None


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder + "/own"


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


def test_folder_named_by_the_session_is_used(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session("yarn"))


def test_local_session_gets_a_folder_of_its_own():
    local = _Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_staged_rows_start_from_files(spark, customers):
    staged = session.stage(customers.where("c_custkey > 5"), "t")
    plan = staged._jdf.queryExecution().toString()
    assert session.shared_folder(spark) in plan and "c_custkey > 5" not in plan
    assert staged.count() == customers.where("c_custkey > 5").count()


def test_broadcast_is_checked(spark, customers):
    n = customers.count()

    def hinted(limit):
        df = customers.join(session.broadcast_if_small(customers, limit), "c_custkey")
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(n) and not hinted(n - 1)


def test_few_rows_need_no_python(spark):
    from tidemark.model import SNAPSHOT_LOG

    for rows in ([], [(None,) * len(SNAPSHOT_LOG)]):
        df = session.few_rows(spark, rows, SNAPSHOT_LOG)
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in SNAPSHOT_LOG
        ]
        assert df.count() == len(rows)
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()


def test_broadcast_is_bounded_by_rows_and_by_bytes(spark):
    from pyspark.sql import functions as F

    def hinted(df, **bounds):
        return "ResolvedHint" in df.sparkSession._jvm.String.valueOf(
            session.broadcast_if_small(df, **bounds)._jdf.queryExecution().analyzed()
        )

    rows = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit("y" * 500)).alias("list"))
    assert hinted(rows) and hinted(rows.limit(0))
    assert not hinted(rows, limit=9) and not hinted(rows, size=10_000)
