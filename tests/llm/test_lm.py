import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import lm


def test_counts_and_base_against_plain(spark):
    held = F.col("doc_id") == 1
    rows = lm.score_texts(awkward(spark), held).collect()
    assert len(rows) == len(AWKWARD)
    train = Counter()
    for doc_id, text, *_ in AWKWARD:
        if doc_id != 1:
            train.update(lm.tokens((text or "").encode()))
    n, v = sum(train.values()), len(train)
    plain = Counter()
    for doc_id, text, *_ in AWKWARD:
        found = lm.tokens((text or "").encode())
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in found)
        plain[doc_id, len(found), sum(train[w] > 0 for w in found), n, round(base, 6)] += 1
    ours = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert ours == plain
    assert all(r["held_out"] == (r["doc_id"] == 1) and r["score"] < 0 for r in rows)


def test_words_beyond_the_heavy_ones_are_joined(spark, monkeypatch):
    whole = lm.score_texts(awkward(spark), F.lit(False)).collect()
    monkeypatch.setattr(lm, "HEAVY", 3)
    few = lm.score_texts(awkward(spark), F.lit(False)).collect()
    key = lambda r: (repr(r["doc_id"]), r["n_tokens"])
    for a, b in zip(sorted(whole, key=key), sorted(few, key=key)):
        assert (a["n_known"], a["n_tokens"]) == (b["n_known"], b["n_tokens"])
        assert abs(a["base_score"] - b["base_score"]) < 1e-6


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(b"a b c a b d e",), (b"x a b c",)], "body binary")
    model, counts = lm.fit(texts)
    out = np.arange(model.size, dtype=np.int32)
    for one, two in ((0, 1), (lm.START, lm.START), (3, 500)):
        same = np.full(model.size, one), np.full(model.size, two)
        assert abs((10.0 ** model.log10(out, *same).astype(float)).sum() - 1) < 1e-4


def test_held_out_texts_score_above_the_base(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = lm.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    sums = scored.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_empty(spark):
    assert lm.score_texts(empty(spark), F.lit(False)).count() == 0
