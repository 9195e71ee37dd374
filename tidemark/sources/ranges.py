"""Reading a source in ranges of equal depth.

Ranges of equal width, as readers cut them from a minimum and a maximum, hold very unequal
numbers of rows where keys are dense in places. Here the split points are quantiles of the
slice that is to be read, so a checkpoint slice of recent keys is cut as evenly as a whole
table. Quantiles come from one mergeable sketch per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.rows import ref


def split_points(df: DataFrame, column: str, ranges: int, where: Column | None = None) -> list:
    """At most ``ranges - 1`` distinct values that cut the slice into ranges of like depth.

    The rank of a point is off by a hundredth of a range at most. A value that fills
    several ranges by itself is one range: a single column can't split it further.
    """
    if ranges < 2:
        return []
    rows = df if where is None else df.where(where)
    shares = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx(ref(column), shares, 100 * ranges).alias("points")).first()[0]
    return sorted(set(found or []))


def range_filters(column: str, points: Sequence) -> list[Column]:
    """One filter per range; each row, also one without a value, fits exactly one."""
    value = ref(column)
    if not points:
        return [F.lit(True)]
    filters = [(value <= F.lit(points[0])) | value.isNull()]
    filters += [(value > F.lit(low)) & (value <= F.lit(high)) for low, high in zip(points, points[1:])]
    return [*filters, value > F.lit(points[-1])]


def _sql(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        text = value.isoformat(sep=" ") if hasattr(value, "hour") else str(value)
        return "'" + text.replace("'", "''") + "'"
    return repr(value)


def range_predicates(column: str, points: Sequence) -> list[str]:
    """``range_filters`` as SQL conditions, for readers that take one query per condition."""
    if not points:
        return ["1 = 1"]
    texts = [_sql(p) for p in points]
    found = [f"({column} <= {texts[0]} OR {column} IS NULL)"]
    found += [f"({column} > {low} AND {column} <= {high})" for low, high in zip(texts, texts[1:])]
    return [*found, f"({column} > {texts[-1]})"]


def in_ranges(df: DataFrame, column: str, points: Sequence) -> DataFrame:
    """``df`` with ``range``, the number of the range a row falls in."""
    number = F.lit(0)
    for k, point in enumerate(points):
        number = F.when(ref(column) > F.lit(point), k + 1).otherwise(number)
    return df.withColumn("range", number)
