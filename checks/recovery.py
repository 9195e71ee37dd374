"""Runs that die, checkpoints that are set back, small states that grow for years."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F, types as T

from checks.derived import COLUMNS, RUN_TS, table
from tidemark.functions.predicates import checkpoint_predicate
from tidemark.model import (
    KEY_INCR_EXTRACT,
    KEY_INCR_LOAD,
    PIPELINE_CONFIG,
    POSTGRESQL,
    STORE_REPLACE,
    ObjectSpec,
    Run,
)
from tidemark.operators.checkpoint import specs_of
from tidemark.plans import flows
from tidemark.session import fresh_folder, stage
from tidemark.sources.files import read_files
from tidemark.sources.readers import parquet_loader
from tidemark.tables.checkpoints import CheckpointMoves, current_moves
from tidemark.tables.events import EventLog
from tidemark.tables.log import FileLog

DEFINITION = "o_orderkey::numeric::>"


class Died(BaseException):
    """The driver is gone: no handler of the flow runs."""


class DiesBeforeMove(CheckpointMoves):
    def advance(self, spec, checkpoint, try_id=None):
        raise Died


class DiesAfterMove(CheckpointMoves):
    def advance(self, spec, checkpoint, try_id=None):
        super().advance(spec, checkpoint, try_id)
        raise Died


class DiesAtLog(FileLog):
    def record(self, run, table, folder):
        raise Died


def extract_orders(spark, root, hour, rows, lake, moves, log=None):
    """One run of a checkpoint extract that starts from the stored moves."""
    run = Run(RUN_TS + timedelta(hours=hour), root)
    stores = flows.Stores.parquet(spark, run)
    if log is not None:
        stores = flows.Stores(spark, run, log, stores.table, stores.append_table)
    last = current_moves(moves.read()).first()
    specs = specs_of(DEFINITION, last.checkpoint if last else "-1")
    spec = ObjectSpec(
        "shop", "orders", "orders", POSTGRESQL, KEY_INCR_EXTRACT, checkpoints=specs,
        store_type=STORE_REPLACE if lake else "parquet", configured_checkpoint="-1",
    )
    flows.key_incr_extract(rows.where(checkpoint_predicate(specs)), spec, stores, moves)


def dying_run(spark, root, rows, lake, step):
    """A first run that dies while writing, before it is logged, before its move, after it."""
    dying = {"move": DiesBeforeMove, "close": DiesAfterMove}.get(step, CheckpointMoves)
    log = DiesAtLog(spark, root) if step == "log" else None
    if step == "write":
        # The last row can't be read.
        top = rows.agg(F.max("o_orderkey")).first()[0]
        failing = F.when(F.col("o_orderkey") == top, F.raise_error(F.lit("source lost"))).otherwise(F.col("o_orderstatus"))
        rows = rows.withColumn("o_orderstatus", failing.cast("string"))
    try:
        extract_orders(spark, root, 0, rows, lake, dying(spark, root), log)
    except (Died, Exception) as error:
        if step != "write" and not isinstance(error, Died):
            raise


def orders_kept(spark, orders, lake, step):
    """What three runs leave, the first of which died."""
    root = fresh_folder(spark, "dying")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    parts = [orders.where(F.col("o_orderkey") <= top * (h + 1) // 3) for h in range(3)]
    dying_run(spark, root, parts[0], lake, step)
    for hour in (1, 2):
        extract_orders(spark, root, hour, parts[hour], lake, CheckpointMoves(spark, root))
    if lake:
        stores = flows.Stores.parquet(spark, Run(RUN_TS, root))
        return stores.appended("orders").read().select(*COLUMNS["orders"])
    return read_files(spark, [f"{root}/orders/{KEY_INCR_LOAD}"]).select(*COLUMNS["orders"])


STEPS = (("write", False), ("log", False), ("move", False), ("close", False), ("write", True), ("move", True), ("close", True))


def key_incr_unclosed_try(spark, sf_dir):
    """Whatever step the first run dies at, three runs hold each row once."""
    orders, found = table(spark, sf_dir, "orders"), None
    for step, lake in STEPS:
        rows = orders_kept(spark, orders, lake, step).select(F.lit(step).alias("step"), F.lit(lake).alias("lake"), "*")
        found = rows if found is None else found.unionAll(rows)
    return found


def _orders_config(spark, value):
    row = {
        "SOURCE_NAMESPACE": "shop", "SOURCE_TABLE_NAME": "orders", "TARGET_TABLE_NAME": "orders", "LAYER_TYPE": "BRONZE",
        "SOURCE_SYSTEM": POSTGRESQL, "EXTRACT_METHOD": KEY_INCR_EXTRACT, "TARGET_STORE_TYPE": "parquet",
        "PROC_GROUP": "A", "IS_ACTIVE": True, "CHECKPOINT_FIELD_DEF": DEFINITION, "CHECKPOINT_TO_VALUE": value,
    }
    return spark.createDataFrame([tuple(row.get(c) for c in PIPELINE_CONFIG.names)], PIPELINE_CONFIG)


def config_set_back(spark, sf_dir):
    """The saved configuration holds the moved value; setting it back reads all rows again."""
    root, loaders, found, saved = fresh_folder(spark, "set-back"), {POSTGRESQL: parquet_loader(sf_dir)}, None, []
    config = _orders_config(spark, "-1")
    for hour in range(3):
        stores = flows.Stores.parquet(spark, Run(RUN_TS + timedelta(hours=hour), root))
        # Hour 1 goes on from the saved value and finds nothing, hour 2 starts again.
        now = _orders_config(spark, "-1") if hour == 2 else saved[-1] if saved else config
        flows.ingest(now, "shop", "A", loaders, stores, lambda c: saved.append(stage(c, "config")))
        path = f"{root}/orders/{KEY_INCR_LOAD}/{stores.run.hour:%Y/%m/%d/%H}"
        rows = read_files(spark, [path]).select(F.lit(hour).alias("hour"), *COLUMNS["orders"])
        found = rows if found is None else found.unionAll(rows)
    return found


NOTES = T.StructType([T.StructField("o_custkey", T.LongType()), T.StructField("o_orderkey", T.LongType())])


def folded_moves(spark, sf_dir):
    """Forty events over all customers with orders: the last one of each, out of few files."""
    log = EventLog(spark, fresh_folder(spark, "events"), NOTES, ("o_custkey",))
    orders = stage(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "orders")
    for k in range(40):
        log.append(orders.where(F.col("o_orderkey") % 40 == k).groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey")))
    assert len(log.read().inputFiles()) <= log.every
    return log.read()


def checks():
    columns = ", ".join(COLUMNS["orders"])
    steps = ", ".join(f"('{step}', {str(lake).lower()})" for step, lake in STEPS)
    return {
        "key_incr_unclosed_try": (
            key_incr_unclosed_try,
            f"SELECT step, lake, {columns} FROM orders, (VALUES {steps}) t(step, lake)",
        ),
        "config_set_back": (
            config_set_back,
            f"SELECT hour, {columns} FROM orders, (VALUES (0), (2)) t(hour)",
        ),
        "folded_moves": (
            folded_moves,
            "SELECT o_custkey, max_by(k, nth) AS o_orderkey, max(nth) + 1 AS position FROM "
            "(SELECT o_custkey, o_orderkey % 40 AS nth, max(o_orderkey) AS k FROM orders GROUP BY ALL) GROUP BY o_custkey",
        ),
    }
