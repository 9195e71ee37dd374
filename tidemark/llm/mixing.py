"""Mixing sources to target weights by Pareto order sampling.

Sources share the total size by weight; a source takes at most three times its own size
and what it leaves is shared by the others, again by weight. A source's target then asks
for some whole copies of each document, which are certain, and a remainder of words.
The remainder is spread over size classes (powers of two) in proportion to the words and
the class number, at most all of a class; this gives each document an inclusion
probability, larger for longer documents. Documents are ranked by random odds divided by
inclusion odds, and taken in that order while they fit into the remainder. The gap that
is left is filled by the one further document whose size fits it best.

Ranks are not computed by one sort per source: sizes are summed over bins of the ranking
key, and only documents in the bin where the remainder ends are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import packed, row_key, whole_text, words
from tidemark.session import broadcast_if_small, stage

WEIGHTS, MOST_COPIES = (1, 2, 3), 3
BINS = 4096
SEED = "mix"


def fill(table: DataFrame, group: list[str], weight: str, cap: str, total: Column) -> DataFrame:
    """Adds ``share``: ``total`` of each group by weight, no row above its cap.

    The excess of capped rows goes to the others by weight until none is above.
    """
    whole = Window.partitionBy(*group)
    # Rows reach their caps in the order of cap per weight.
    up = whole.orderBy(F.col(cap) / F.col(weight), weight)
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    onward = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = left / F.sum(weight).over(onward)
    leveled = table.withColumn("__level", F.when(F.col(weight) > 0, level))
    full = F.col("__level").isNull() | (F.col(cap) <= F.col(weight) * F.col("__level"))
    flat = F.max(F.when(~full, F.col("__level"))).over(whole)
    return leveled.withColumn(
        "share", F.when(full, F.col(cap).cast("double")).otherwise(F.col(weight) * flat)
    ).drop("__level")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source, null last."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    table = sources.withColumns({"weight": weight, "cap": F.col("source_size") * MOST_COPIES})
    table = table.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
    filled = fill(table, [], "weight", "cap", F.col("all"))
    return filled.select("source", "source_size", F.col("share").alias("target"))


def _chances(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and size class: whole copies, the remainder, and the inclusion probability."""
    classed = sizes.where("size > 0").groupBy("source", "class").agg(F.sum("size").alias("words"))
    joined = classed.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    whole = F.floor(F.col("target") / F.col("source_size"))
    joined = joined.withColumn("whole", whole)
    joined = joined.withColumns(
        {
            "rest": F.col("target") - F.col("whole") * F.col("source_size"),
            "pull": F.col("words") * F.col("class"),
        }
    )
    filled = fill(joined, ["source"], "pull", "words", F.col("rest"))
    return filled.withColumn("chance", F.col("share") / F.col("words")).select(
        F.col("source").alias("of"), F.col("class").alias("in_class"), "source_size", "target", "whole", "rest", "chance"
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, key), one row per row of ``docs``.

    ``size`` counts words (null text: 0), ``taken`` is ``copies`` times ``size``; no
    document is copied more than three times. Empty documents take nothing. Random
    numbers come from the id and the seed alone, so reruns agree; rows of equal id and
    text tie, and the tie is broken arbitrarily between these equal rows. A null id has a
    random number of its own, a null source is a source. An empty table gives an empty
    result. Other columns, whatever their names, are not read.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(words(whole_text(text))).cast("long").alias("size"),
        row_key(text).alias("key"),
    )
    sizes = stage(rows.withColumn("class", F.length(F.bin("size"))), "mix-sizes")
    targets = stage(source_targets(sizes), "mix-targets")
    chances = broadcast_if_small(stage(_chances(sizes, targets), "mix-chances"), 20_000)
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("long")
    u = (number + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
    rank = F.when(F.col("chance") >= 1, F.lit(0.0)).when(F.col("chance") > 0, odds / (1 + odds))
    same = sizes["source"].eqNullSafe(F.col("of")) & (sizes["class"] == F.col("in_class"))
    ranked = sizes.where("size > 0").join(chances, same).withColumn("rank", rank)
    ranked = stage(
        ranked.withColumn("bin", F.floor(F.col("rank") * BINS)).drop("of", "in_class", "class"), "mix-ranked"
    )
    sums = ranked.where("rank IS NOT NULL").groupBy("source", "bin", "rest").agg(F.sum("size").alias("words"))
    up = Window.partitionBy("source").orderBy("bin")
    sums = sums.withColumn("upto", F.sum("words").over(up))
    edge = sums.where("upto > rest").groupBy("source").agg(
        F.min_by(F.struct("bin", (F.col("rest") - F.col("upto") + F.col("words")).alias("room")), "bin").alias("edge")
    )
    edges = broadcast_if_small(
        stage(edge.select(F.col("source").alias("of"), "edge.bin", "edge.room").withColumnRenamed("bin", "edge_bin"), "mix-edges"),
        20_000,
    )
    placed = ranked.join(edges, ranked["source"].eqNullSafe(edges["of"]), "left").drop("of")
    at_edge = placed.where("bin = edge_bin")
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "key")
    run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    inside = at_edge.withColumn("chosen", run <= F.col("room"))
    clear = placed.where("bin IS NULL OR edge_bin IS NULL OR bin <> edge_bin").withColumn(
        "chosen", F.col("bin").isNotNull() & (F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin")))
    )
    decided = stage(inside.unionByName(clear), "mix-decided")
    taken = decided.groupBy("source", "rest").agg(
        F.coalesce(F.sum(F.when(F.col("chosen"), F.col("size"))), F.lit(0)).alias("chosen_words")
    )
    gaps = broadcast_if_small(
        stage(taken.select(F.col("source").alias("of"), (F.col("rest") - F.col("chosen_words")).alias("gap")), "mix-gaps"),
        20_000,
    )
    open_rows = decided.where("NOT chosen AND rank IS NOT NULL").join(gaps, decided["source"].eqNullSafe(gaps["of"]))
    miss = F.abs(F.col("gap") - F.col("size"))
    fitting = open_rows.where(miss < F.col("gap")).groupBy("source").agg(
        F.min(F.struct(miss.alias("miss"), "rank", "doc_id", "key")).alias("best")
    )
    best = stage(fitting.select(F.col("source").alias("of"), "best.*"), "mix-best").alias("best")
    return _with_copies(sizes, targets, decided, best)


def _with_copies(sizes: DataFrame, targets: DataFrame, decided: DataFrame, best: DataFrame) -> DataFrame:
    """All rows with their copies; the best-fitting document of a source counts as chosen."""
    is_best = (
        F.col("d.source").eqNullSafe(F.col("best.of"))
        & F.col("d.doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("d.key") == F.col("best.key"))
        & (F.col("d.rank") == F.col("best.rank"))
        & ~F.col("d.chosen")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "key"]
    marked = decided.alias("d").join(broadcast_if_small(best, 20_000).alias("best"), is_best, "left")
    # Of equal rows that all fit best, one is taken.
    twin = Window.partitionBy("d.source", "d.doc_id", "d.key").orderBy("d.size")
    fits = marked.where("best.key IS NOT NULL").withColumn("extra", (F.row_number().over(twin) == 1).cast("long"))
    plain = marked.where("best.key IS NULL").withColumn("extra", F.lit(0).cast("long"))
    both = fits.unionAll(plain)
    copies = (F.col("whole") + F.col("d.chosen").cast("long") + F.col("extra")).alias("copies")
    full = both.select(*[F.col(f"d.{c}") for c in columns], copies)
    none = (
        sizes.where("size = 0")
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(*columns, F.lit(0).cast("long").alias("copies"))
    )
    return full.unionAll(none).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them; all columns as they were.

    Rows without words, null text among them, are in no mix. A null source is a source, a
    null id an id; ties in rank go by id. An empty table gives an empty result.
    """
    plan = stage(mix(docs), "mix-plan").groupBy(F.col("doc_id").alias("own_id"), F.col("key").alias("own_key"))
    # Rows of equal id and text share their copies evenly; the first take what is over.
    shares = plan.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    shares = stage(shares.where("copies > 0"), "mix-copies")
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    joined = packed(docs).join(shares, same)
    place = F.lit(1)
    if not shares.where("rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy("own_id", "own_key").orderBy(F.lit(1)))
    joined = joined.withColumn("place", place)
    times = F.floor((F.col("copies") + F.col("rows") - F.col("place")) / F.col("rows")).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(True), times)).alias("again")).select("row.*")
