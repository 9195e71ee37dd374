"""Words, row keys and decisions shared by the operators on texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` in Python cuts at exactly these.
GAP = r"[\x20\x09-\x0D]+"


def whole_text(name: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order, unchanged."""
    return F.array_remove(F.split(text, GAP), "")


def row_key(text: str = "text") -> Column:
    """Names a text within rows of one id; ids alone may be null or repeat."""
    return F.xxhash64(whole_text(text))


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows as one struct ``row`` beside ``id`` and ``key``, so that no name can clash."""
    return docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), row_key(text).alias("key"))


def _named(table: DataFrame) -> DataFrame:
    return table.select(F.col("doc_id").alias("own_id"), F.col("key").alias("own_key")).distinct()


def keep_rows(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """Rows of ``docs`` that are not in ``dropped`` (doc_id, key), every column kept."""
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    return packed(docs, doc_id, text).join(_named(dropped), same, "left_anti").select("row.*")


def single_rows(docs: DataFrame, twins: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """One row of each (doc_id, key) in the stored table ``twins``; all other rows as they are."""
    if twins.isEmpty():
        return docs
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    repeated = packed(docs, doc_id, text).join(_named(twins), same).dropDuplicates(["own_id", "own_key"])
    return keep_rows(docs, twins, doc_id, text).unionAll(repeated.select("row.*"))
