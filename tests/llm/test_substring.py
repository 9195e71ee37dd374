import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, awkward, empty, words
from tidemark.llm import substring


def plain(rows, window):
    """Removes words of windows that start earlier too; null ids come last."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for doc_id, text in rows:
        found = words(text)
        for at in range(len(found) - window + 1):
            run, place = tuple(found[at : at + window]), (order(doc_id), at)
            first[run] = min(first.get(run, place), place)
    out = []
    for doc_id, text in rows:
        found = words(text)
        gone = {
            at + d
            for at in range(len(found) - window + 1)
            if first[tuple(found[at : at + window])] < (order(doc_id), at)
            for d in range(window)
        }
        out.append((doc_id, len(found), len(gone), " ".join(w for k, w in enumerate(found) if k not in gone)))
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [" ".join(rng.choices("abcdefgh", k=30)) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [" ".join(rng.choices("abcdefghijklmnop", k=rng.randrange(0, 40)))]
        parts += rng.sample(shared, rng.randrange(0, 3)) + ["x y " * rng.randrange(0, 25)]
        rows.append((k, "\n ".join(parts)))
    return rows


@pytest.mark.parametrize("chunk", [1_500_000, 50])
def test_against_plain(spark, monkeypatch, chunk):
    monkeypatch.setattr(substring, "CHUNK_WORDS", chunk)
    rows = passages(3)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ours = substring.remove_repeats(table, window=8, gram=4).collect()
    assert sorted(map(tuple, ours)) == sorted(plain(rows, 8))


def test_awkward_rows(spark):
    ours = Counter(map(tuple, substring.remove_repeats(awkward(spark)).collect()))
    assert ours == Counter(plain([(i, t) for i, t, *_ in AWKWARD], 20))


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring, "MAX_BITS", 16)
    rows = passages(4, 30)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring.remove_repeats(table, window=8, gram=4).collect())) == sorted(plain(rows, 8))


def test_rolling_hash():
    values = np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64)
    values[30:38] = values[3:11]
    runs = substring._runs(values, 8, substring._ODD[0])
    assert len(runs) == 43 and runs[30] == runs[3] and len(set(runs.tolist())) == 42


def test_empty(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0
