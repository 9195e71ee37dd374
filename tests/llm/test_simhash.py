import itertools

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import simhash


def plain_print(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    runs = [b" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(values, bits):
    values = np.array(values, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    labels = np.arange(len(values))
    while True:
        new = np.array([labels[near[k]].min() for k in range(len(values))])
        if (new == labels).all():
            return labels
        labels = new


def test_fingerprints_and_groups(spark):
    rows = simhash.near_groups(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    prints = [plain_print(t) for _, t, *_ in AWKWARD]
    labels = reachable(prints, 4)
    expected = {}
    for (doc_id, *_), p, label in zip(AWKWARD, prints, labels):
        ids = [i for (i, *_), other in zip(AWKWARD, labels) if other == label and i is not None]
        expected[p] = min(ids, default=None)
    for r in rows:
        p = r["print"] % (1 << 64)
        assert p in expected and r["component_id"] == expected[p]


@pytest.mark.parametrize("chunk", [20_000, 15])
def test_links_lose_nothing(spark, chunk):
    rng = np.random.default_rng(5)
    values = []
    for base in rng.integers(0, 1 << 63, 60, dtype=np.uint64):
        for _ in range(6):
            v = base
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                v ^= np.uint64(1) << np.uint64(bit)
            values.append(v)
    values = np.unique(np.array(values, np.uint64))
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long")
    found = {r["node"]: r["least"] for r in simhash.classes(simhash.near_links(table, chunk=chunk)).collect()}
    labels = reachable(values, 4)
    signed = values.view(np.int64)
    for label in set(labels.tolist()):
        members = signed[labels == label]
        assert {found.get(int(m), int(m)) for m in members} == {int(members.min())}


def test_code_is_perfect():
    home, further = simhash._patterns()
    weights = np.bitwise_count(home.astype(np.uint64))
    assert weights.max() == 3 and (simhash._syndromes(home) == np.arange(2048)).all()
    assert (further >= 0).sum() == len(list(itertools.combinations(range(23), 4)))


def test_drop_and_empty(spark):
    table = awkward(spark)
    rest = simhash.drop_near(table)
    assert rest.columns == table.columns
    assert sorted(r["doc_id"] for r in rest.collect()) == [1, 2, 5, 7, 8, 9]
    assert simhash.near_groups(empty(spark)).count() == 0
