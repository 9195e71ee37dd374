import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import packing

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def one_after_the_other(lengths, room):
    """Best-two-fit, a sequence at a time over all pieces that are left."""
    left, sequences = sorted(lengths), []
    while left:
        sequence, gap = [], room
        while fits := [n for n in left if n <= gap]:
            sequence.append(max(fits))
            left.remove(max(fits))
            gap -= sequence[-1]
        shortest, best = min(sequence), None
        if gap and len(sequence) > 1:
            have = Counter(left)
            for a in have:
                for b in have:
                    if b <= a and shortest < a + b <= gap + shortest and (a != b or have[a] > 1):
                        best = max(best or (0, 0, 0), (a + b, a, b))
        if best:
            sequence.remove(shortest)
            sequence += best[1:]
            left = sorted((Counter(left) - Counter(best[1:]) + Counter([shortest])).elements())
        sequences.append(tuple(sorted(sequence)))
    return sequences


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    room, mean = rng.choice((10, 16, 40, 64)), rng.choice((3, 8, 20))
    lengths = [min(room, 1 + int(rng.expovariate(1 / mean))) for _ in range(rng.randrange(1, 200))]
    got = Counter()
    for times, pattern in packing.plan_sequences(Counter(lengths), room):
        got[tuple(sorted(Counter(pattern).elements()))] += times
    assert got == Counter(one_after_the_other(lengths, room))


def test_second_step_pays():
    """6, 3 leave 1 of 10 open; 2 and 2 instead of the 3 leave none."""
    assert packing.plan_sequences({6: 1, 3: 1, 2: 2}, 10) == [(1, {6: 1, 2: 2}), (1, {3: 1})]


def test_plan_does_not_grow_with_the_table():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 50) for n in range(1, 1025)}
    many = packing.plan_sequences({n: k * 10**6 for n, k in counts.items()})
    assert len(many) < 20_000
    used = Counter()
    for times, pattern in many:
        assert sum(n * k for n, k in pattern.items()) <= 1024
        used.update({n: times * k for n, k in pattern.items()})
    assert used == {n: k * 10**6 for n, k in counts.items()}


def checked(rows, texts, room):
    """Rows are whole: right ids, all tokens once, sequences without gaps."""
    tokenizer, sequences, pieces = library(), defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["rid"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"], r["doc_id"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    got = Counter()
    for parts in pieces.values():
        got[parts[0][4], tuple(p[:4] for p in sorted(parts))] += 1
    want = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) if len(ids) <= room else len(ids) % room or room
        bounds = [0, *range(first, len(ids) + 1, room)]
        parts = [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for a, b in zip(bounds, bounds[1:])]
        want[doc_id, tuple((k, *p) for k, p in enumerate(parts))] += 1
    assert got == want
    return len(sequences)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    rows = packing.pack(docs, RANKS, PATTERN).collect()
    n = checked(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 1024)
    assert n == len(one_after_the_other([r["length"] for r in rows], 1024))
    assert n <= 1.01 * sum(r["length"] for r in rows) / 1024 + 1


def test_awkward_and_empty(spark):
    rows = packing.pack(awkward(spark), RANKS, PATTERN, room=50).collect()
    checked(rows, [(r[0], r[1]) for r in AWKWARD], 50)
    assert packing.pack(empty(spark), RANKS, PATTERN).count() == 0


def test_long_text_and_equal_lengths(spark):
    """A text of megabytes, and a third of all rows with one length."""
    texts = [(1, "word " * 400_000)] + [(k, "same") for k in range(500)] + [(k, "a b c " * (k % 90)) for k in range(1000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    rows = packing.pack(docs, RANKS, PATTERN).collect()
    total = sum(r["length"] for r in rows)
    assert checked(rows, texts, 1024) == -(-total // 1024)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_the_librarys(text):
    coder = packing.encoding(open(RANKS, "rb").read(), PATTERN)
    assert coder.encode_ordinary(text) == library_once().encode(text, add_special_tokens=False).ids


_KEPT = []


def library_once():
    if not _KEPT:
        _KEPT.append(library())
    return _KEPT[0]
