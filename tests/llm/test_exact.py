import hashlib
from collections import defaultdict

import pytest

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm.exact import drop_exact, exact_groups


@pytest.mark.parametrize("capacity", [1, 2, 4096])
def test_groups_against_plain(spark, capacity):
    groups = defaultdict(list)
    for doc_id, text, *_ in AWKWARD:
        groups[text or ""].append(doc_id)
    rows = exact_groups(awkward(spark), capacity=capacity).collect()
    assert len(rows) == len(AWKWARD)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    for sha in by_sha:
        kept = [r for r in rows if r["text_sha256"] == sha and r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]


def test_directory_splits_on_its_own(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('t', id % 150) AS text")
    rows = exact_groups(docs, capacity=3).collect()
    assert all(r["keep_id"] == max(i for i in range(400) if i % 150 == r["doc_id"] % 150) for r in rows)


def test_drop_keeps_columns_and_one_row_each(spark):
    table = awkward(spark)
    rest = drop_exact(table)
    assert rest.columns == table.columns
    texts = [r["text"] or "" for r in rest.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in AWKWARD})


def test_empty(spark):
    assert exact_groups(empty(spark)).count() == 0
    assert drop_exact(empty(spark)).count() == 0
