from collections import Counter

from tests.llm.helpers import AWKWARD, awkward, empty, words
from tidemark.llm import mixing


def plain_targets(sizes):
    """Shares by weight, the excess shared anew until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_names = [s for s in names if s not in full]
        share = {s: rest * weights[s] / sum(weights[o] for o in open_names) for s in open_names}
        over = {s: 3 * sizes[s] for s in open_names if share[s] >= 3 * sizes[s]}
        if not over:
            return share | full
        full |= over


def test_targets_sizes_and_bounds(spark):
    sizes = Counter()
    for _, text, _, source in AWKWARD:
        sizes[source] += len(words(text))
    expected = plain_targets(sizes)
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert abs(r["target"] - expected[r["source"]]) < 1e-6 * max(1, r["target"])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3


def test_near_target_and_repeatable(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, again = (sorted(map(tuple, mixing.mix(d).collect()), key=repr) for d in (docs, docs.repartition(5)))
    assert first == again
    table = spark.createDataFrame(first, mixing.mix(docs).schema)
    for r in table.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.25


def test_rows_follow_the_plan(spark):
    table = awkward(spark)
    mixed = mixing.mixed_rows(table)
    assert mixed.columns == table.columns
    plan = mixing.mix(table).collect()
    assert mixed.count() == sum(r["copies"] for r in plan)


def test_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_rows(empty(spark)).count() == 0
