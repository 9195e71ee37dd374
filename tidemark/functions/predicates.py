"""Typed filter columns. No SQL text is built, so Catalyst pushes every part down."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.functions.rows import ref
from tidemark.model import MARKET_REGIONS, CheckpointSpec

_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}

_TIME_TYPES = ("datetime", "timestamp")

#: Ends the text of a time that is an instant, in UTC; times without it have no zone.
UTC_MARK = "Z"


def _literal(spec: CheckpointSpec, value: str | None) -> Column:
    if value is None or value == "":
        raise ValueError(f"checkpoint field {spec.field!r} has no stored value")
    kind = spec.type.strip().lower()
    if kind in _TIME_TYPES:
        if value.endswith(UTC_MARK):
            return F.lit(value).cast("timestamp")
        return F.lit(value).cast("timestamp_ntz")
    if kind == "numeric":
        # An integer literal keeps an integral column uncast, which pushdown needs.
        if value.strip().lstrip("+-").isdigit() and abs(int(value)) < 2**63:
            return F.lit(int(value))
        return F.lit(value).cast("double" if "e" in value.lower() else _decimal(value))
    if kind == "string":
        return F.lit(value)
    if kind == "boolean":
        word = value.strip().lower()
        if word not in ("true", "false", "1", "0"):
            raise ValueError(f"not a boolean checkpoint value: {value!r}")
        return F.lit(word in ("true", "1"))
    raise ValueError(f"unknown checkpoint type {spec.type!r} for {spec.field!r}")


def _decimal(value: str) -> str:
    whole, _, frac = value.strip().lstrip("+-").partition(".")
    if not (whole + frac).isdigit():
        raise ValueError(f"not a numeric checkpoint value: {value!r}")
    return f"decimal({max(len(whole) + len(frac), 1)},{len(frac)})"


def compare(spec: CheckpointSpec, value: str | None = None) -> Column:
    """``field <op> literal`` with a whitelisted operator and a typed literal."""
    op = spec.op.strip()
    if op not in _COMPARE:
        raise ValueError(f"operator {spec.op!r} is not allowed for {spec.field!r}")
    return _COMPARE[op](ref(spec.field), _literal(spec, spec.value if value is None else value))


def checkpoint_predicate(specs: Sequence[CheckpointSpec]) -> Column:
    """All configured comparisons must hold."""
    if not specs:
        raise ValueError("a checkpoint read needs at least one checkpoint field")
    return reduce(operator.and_, [compare(s) for s in specs])


def bucketed_checkpoint_predicate(specs: Sequence[CheckpointSpec]) -> Column:
    """Checkpoint read of a source partitioned by year and month buckets.

    The stored value is one timestamp text. Field one is compared with its year,
    field two with its month, every further field with the whole timestamp. When both
    bucket comparisons look forward they are combined by (year, month) order, so
    a checkpoint in December still sees the next January.
    """
    if len(specs) < 2:
        return checkpoint_predicate(specs)
    stamp = specs[0].value
    if not stamp or len(stamp) < 7:
        raise ValueError(f"bucketed checkpoint needs a timestamp value, got {stamp!r}")
    year, month = specs[0], specs[1]
    year_text, month_text = stamp[:4], stamp[5:7]
    if {year.op.strip(), month.op.strip()} <= {">", ">="}:
        later_year = compare(CheckpointSpec(year.field, year.type, ">"), year_text)
        same_year = compare(CheckpointSpec(year.field, year.type, "="), year_text)
        buckets = later_year | (same_year & compare(month, month_text))
    else:
        buckets = compare(year, year_text) & compare(month, month_text)
    return reduce(operator.and_, [compare(s, stamp) for s in specs[2:]], buckets)


def market_regions(
    region: str, mapping: Mapping[str, Sequence[str]] = MARKET_REGIONS
) -> list[str]:
    if region not in mapping:
        raise ValueError(f"no market regions configured for {region!r}")
    return list(mapping[region])
