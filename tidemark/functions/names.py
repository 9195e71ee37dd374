"""Naming rules for target tables and file paths."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from tidemark.model import TARGET_PREFIXES


def target_name(table: Column, source_system: Column) -> Column:
    """Lakehouse target: the table name behind its source system's prefix."""
    prefix = F.lit("")
    for system, text in TARGET_PREFIXES.items():
        prefix = F.when(F.upper(source_system) == system, text).otherwise(prefix)
    return F.concat(prefix, table)


def target_name_of(table: str, source_system: str) -> str:
    return TARGET_PREFIXES.get(source_system.upper(), "") + table


def database_name(bucket: str) -> str:
    """Databases cannot carry dashes."""
    return bucket.replace("-", "_")


def hour_path(root: str, table: str, kind: str, hour: datetime) -> str:
    """``<root>/<table>/<kind>/yyyy/mm/dd/hh``."""
    return f"{root}/{table}/{kind}/{hour:%Y/%m/%d/%H}"


def object_path(root: str, spec) -> str:
    """A folder per object, group and target: two groups may read one source."""
    names = (spec.namespace, spec.source_table, spec.proc_group or "none", spec.target_table)
    return "/".join([root, *names])


def relative_path(path: Column, bucket: str) -> Column:
    """The part of ``path`` behind the first ``<bucket>/``."""
    marker = bucket.rstrip("/") + "/"
    found = F.locate(marker, path)
    return F.when(found > 0, F.substr(path, found + F.lit(len(marker)))).otherwise(path)


def path_part(path: Column, index: int) -> Column:
    """One ``/``-separated part, null where the path is shorter."""
    return F.get(F.split(path, "/"), F.lit(index))


def path_hour(path: Column) -> Column:
    """``yyyy-mm-dd-hh`` of an hour path; null for paths that carry no hour."""
    parts = F.split(path, "/")
    return F.when(
        F.size(parts) > 5,
        F.concat_ws("-", *[F.get(parts, F.lit(i)) for i in (2, 3, 4, 5)]),
    )


def key_below(path: str, bucket: str) -> str:
    """``relative_path`` for a single path text."""
    _, found, rest = path.partition(bucket.rstrip("/") + "/")
    return rest if found else path
