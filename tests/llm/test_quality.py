from collections import Counter

from tests.llm.helpers import AWKWARD, awkward, empty, words
from tidemark.llm import quality


def plain(text):
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    runs = Counter(zip(found, found[1:], found[2:]))
    covered = {i + d for i, w in enumerate(zip(found, found[1:], found[2:])) if runs[w] > 1 for d in range(3)}
    return (
        len(found), sum(map(len, found)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_counts_against_plain(spark):
    rows = quality.judge_quality(awkward(spark)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = Counter((r["doc_id"], *[r[n] for n in names]) for r in rows)
    assert found == Counter((i, *plain(t)) for i, t, *_ in AWKWARD)


def test_distance(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([([1, 1], [1, 1]), ([1, 0], [0, 1]), ([0, 0], [1, 1])], "a array<long>, b array<long>")
    found = [round(r[0], 6) for r in table.select(quality.js_distance(F.col("a"), F.col("b"))).collect()]
    assert found[:2] == [0.0, 1.0]


def test_keeps_columns(spark):
    table = awkward(spark)
    kept = quality.keep_quality(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} <= {5, 6, 7}


def test_no_python_and_empty(spark):
    assert quality.judge_quality(empty(spark)).count() == 0
    plan = quality.counts(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equal_hashes_are_compared_by_words(spark, monkeypatch):
    """Windows of one hash that differ are no repeats, however many bits it has."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(quality, "_window_hash", lambda a, b, c: F.length(a).cast("long"))
    texts = ["one two six ten red", "a b c d e f a b", "same same same same"]
    table = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.counts(table).collect()}
    assert found == {0: 0, 1: 0, 2: 4}
