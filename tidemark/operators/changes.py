"""Change detection between two copies of a table, and region filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.predicates import market_regions
from tidemark.functions.rows import ref
from tidemark.model import HASH, MARKET_REGIONS
from tidemark.session import BROADCAST_ROWS, broadcast_if_small, stage


@dataclass(frozen=True)
class DiffLimits:
    """Sizes, in rows, at which ``new_rows`` changes its way of working.

    ``broadcast``: a side of at most so many hashes may be sent to every task.
    ``shuffle``: up to so many rows on either side, rows are shuffled as they are.
    ``hot``: rows with more copies than this stay out of larger shuffles.
    """

    broadcast: int = BROADCAST_ROWS
    shuffle: int = 20_000_000
    hot: int = 1_000_000


def compared_hashes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Each hash of ``current`` once: its ``copies`` there, and whether it is ``known``.

    Only hashes are shuffled, and they are merged before the shuffle, so a row
    that is copied very often costs one entry per task. Both sides meet in one
    aggregation, so there is no join to be skewed.
    """
    sides = current.select(HASH, F.lit(1).alias("copies"), F.lit(False).alias("known")).unionAll(
        previous.select(HASH, F.lit(0).alias("copies"), F.lit(True).alias("known"))
    )
    return (
        sides.groupBy(HASH)
        .agg(F.sum("copies").alias("copies"), F.bool_or("known").alias("known"))
        .where(F.col("copies") > 0)
    )


def new_hashes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Each hash of ``current`` that ``previous`` lacks, once."""
    return compared_hashes(current, previous).where(~F.col("known")).select(HASH)


def new_rows(
    current: DataFrame, previous: DataFrame | None, limits: DiffLimits = DiffLimits()
) -> DataFrame:
    """Rows of ``current`` whose hash is not in ``previous``, copies included.

    * No previous copy: everything is new.
    * A previous copy small enough to broadcast: its hashes are sent to every task
      and ``current`` is read once, unshuffled.
    * Both sides of moderate size: one shuffle join.
    * Else the new hashes are worked out on the narrow hash column alone and
      stored, and the wide rows are filtered by them: unshuffled when few hashes
      are new, as in most runs, by a shuffle join otherwise. Rows with very many
      copies stay out of that shuffle.

    Rows are counted first, and the last case reads ``current`` again: pass the
    written snapshot rather than a live source.
    """
    columns = [HASH] + [c for c in current.columns if c != HASH]
    if previous is None:
        return current.select(*map(ref, columns))
    known = previous.select(HASH)
    known_rows = known.count()
    if known_rows <= limits.broadcast:
        found = current.join(F.broadcast(known.distinct()), HASH, "left_anti")
    else:
        rows = current.count()
        if max(rows, known_rows) <= limits.shuffle:
            found = current.join(known, HASH, "left_anti")
        else:
            found = _rows_of_new_hashes(current, rows, known, limits)
    return found.select(*map(ref, columns))


def _rows_of_new_hashes(
    current: DataFrame, rows: int, known: DataFrame, limits: DiffLimits
) -> DataFrame:
    # With n rows, at most n / t hashes have more than t copies. Raising t with n
    # therefore bounds the number of hot hashes, whatever the data.
    threshold = max(limits.hot, rows // BROADCAST_ROWS)
    hot = F.col("copies") > threshold
    compared = stage(
        compared_hashes(current, known).where(~F.col("known") | hot), "compared-hashes"
    )
    totals = compared.agg(
        F.count_if(~F.col("known")).alias("fresh"), F.count_if(hot).alias("hot")
    ).first()
    fresh = compared.where(~F.col("known"))
    if totals.fresh <= limits.broadcast:
        return current.join(F.broadcast(fresh.select(HASH)), HASH, "left_semi")
    if totals.hot == 0:
        return current.join(fresh.select(HASH), HASH, "left_semi")
    hot_hashes = compared.where(hot).select(HASH)
    often = current.join(F.broadcast(fresh.where(hot).select(HASH)), HASH, "left_semi")
    seldom = current.join(F.broadcast(hot_hashes), HASH, "left_anti").join(
        fresh.where(~hot).select(HASH), HASH, "left_semi"
    )
    return often.unionByName(seldom)


def region_filter(
    df: DataFrame,
    column: str,
    region: str,
    mapping: Mapping[str, Sequence[str]] = MARKET_REGIONS,
) -> DataFrame:
    """Rows whose market region is served from ``region``."""
    return df.where(ref(column).isin(market_regions(region, mapping)))


def region_semi_filter(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    column: str,
    region: str,
    mapping: Mapping[str, Sequence[str]] = MARKET_REGIONS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Child rows whose parent row lies in the region."""
    # Stored, as it is counted and then read: a live parent is read once.
    wanted = stage(
        region_filter(parent, column, region, mapping).select(ref(parent_key).alias(child_key)).distinct(),
        "region-keys",
    )
    return child.join(broadcast_if_small(wanted, broadcast_rows), child_key, "left_semi").select(
        *map(ref, child.columns)
    )


def region_semi_pruned(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    column: str,
    region: str,
    mapping: Mapping[str, Sequence[str]] = MARKET_REGIONS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``region_semi_filter`` of a child stored in partitions by its key.

    The filter of the parent is worked out first, while the query runs, and only the
    child's partitions of wanted keys are read. That needs the keys at every task, so they
    are counted; of too many, a shuffle join reads all partitions.
    """
    wanted = region_filter(parent, column, region, mapping).select(ref(parent_key).alias(child_key)).distinct()
    return child.join(broadcast_if_small(wanted, broadcast_rows), child_key, "left_semi").select(*map(ref, child.columns))
