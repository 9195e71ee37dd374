import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows_of
from tidemark.model import KEY_INCR_EXTRACT, ObjectSpec
from tidemark.sources.files import folder_names
from tidemark.tables.checkpoints import CheckpointMoves, current_moves
from tidemark.tables.events import EventLog
from tidemark.tables.tries import SEALED, Tries

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])


def names(log, kind):
    return folder_names(log.spark, f"{log.path}/{kind}")


def test_many_events_cost_few_files(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log", SCHEMA, ("key",))
    for k in range(100):
        log.note((f"k{k % 7}", k))
        assert len(log.read().inputFiles()) <= log.every
    assert len(names(log, "events")) <= 2 * log.every and len(names(log, "state")) <= 2
    assert rows_of(log.read().select("key", "value")) == sorted((f"k{k % 7}", k) for k in range(93, 100))
    log.fold()
    assert len(log.read().inputFiles()) == 1
    assert rows_of(log.read().select("key", "value")) == sorted((f"k{k % 7}", k) for k in range(93, 100))


def test_unfinished_writes_are_not_seen(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log", SCHEMA, ("key",), every=4)
    for k in range(5):
        log.note(("a", k))
    for kind, position in (("events", 6), ("state", 5)):
        path = f"{log.path}/{kind}/at={position:015d}"
        spark.createDataFrame([("a", 99, position)], log.schema).coalesce(1).write.mode("overwrite").parquet(path)
        spark._jvm.java.io.File(f"{path}/_SUCCESS").delete()
    assert rows_of(log.read()) == [("a", 4, 5)]
    # The next event passes over the place of the one that was left.
    assert log.note(("b", 1)) == 7
    assert rows_of(log.read().select("key", "value")) == [("a", 4), ("b", 1)]


def test_keys_that_are_gone_leave_the_state(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log", SCHEMA, ("key",), gone="value < 0", every=3)
    for k in range(9):
        log.note((f"k{k}", k))
        log.note((f"k{k}", -1))
    log.note(("last", 1))
    log.fold()
    assert rows_of(log.read().select("key", "value")) == [("last", 1)]
    assert spark.read.parquet(f"{log.path}/state").where("key <> 'last'").count() <= 1


def test_empty_log(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log", SCHEMA, ("key",))
    log.fold()
    assert log.read().isEmpty() and log.read().columns == ["key", "value", "position"]


def spec(**more):
    return ObjectSpec("shop", "orders", "orders", "POSTGRESQL", KEY_INCR_EXTRACT, **more)


def test_moves_of_years_stay_few(spark, tmp_path):
    moves, one = CheckpointMoves(spark, str(tmp_path)), spec(configured_checkpoint="0")
    for k in range(40):
        moves.advance(one, str(k), f"try{k}")
    assert len(moves.read().inputFiles()) <= 40
    assert current_moves(moves.read()).first().checkpoint == "39"
    assert moves.made_by(one) == {"try39"}


def test_a_value_from_before_brings_no_old_move_back(spark, tmp_path):
    moves, one, two = CheckpointMoves(spark, str(tmp_path)), spec(configured_checkpoint="0"), spec(configured_checkpoint="50")
    moves.advance(one, "100")
    moves.advance(two, "120")
    assert [(r.configured, r.checkpoint) for r in current_moves(moves.read()).collect()] == [("50", "120")]
    moves.saved(two, "120")
    assert [(r.configured, r.checkpoint) for r in current_moves(moves.read()).collect()] == [("120", "120")]


@pytest.mark.parametrize("moved", [None, set()])
def test_settling(spark, tmp_path, moved):
    from tidemark.operators.checkpoint import specs_of

    def tries(value):
        return Tries(spark, str(tmp_path), spec(checkpoints=specs_of("a::numeric::>", value)))

    first = tries("5")
    first.start("x/open", "open")
    for name, checkpoint in (("same", "5"), ("gone", "9")):
        first.start(f"x/{name}", name)
        first.seal(name, f"x/{name}", checkpoint)
    found = tries("5").settle(moved)
    assert found.replaced == [("open", "x/open"), ("gone", "x/gone")] and found.closed == ["same"]
    # Once the checkpoint is where the sealed try led, its rows stay.
    found = tries("9").settle({"gone"} if moved is not None else None)
    assert ("gone", "x/gone") not in found.replaced and "gone" in found.closed
    first.close("open", "same", "gone")
    assert first.read().where(F.col("event") == SEALED).isEmpty() and tries("9").settle(moved).replaced == []
