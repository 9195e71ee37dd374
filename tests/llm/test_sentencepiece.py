import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm.sentencepiece import Encoder, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
OURS = Encoder(MODEL.serialized_model_proto())


def agree(text):
    ids = MODEL.encode(text)
    assert OURS.encode(text) == (len(ids), ",".join(map(str, ids)), MODEL.decode(ids))


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(text):
    agree(text)


@pytest.mark.parametrize("text", ["", " ", "▁", "a" * 3000, "ab" * 2000, " " * 400, "中" * 300, "<s>a</s>", "\x00\n\r\n x"])
def test_odd_texts(text):
    agree(text)


def test_mixtures():
    rng = random.Random(2)
    pool = list("aab  bétheing\n\t▁😀中ñ<s>") + [MODEL.id_to_piece(rng.randrange(300, 32000)) for _ in range(200)]
    for _ in range(1500):
        agree("".join(rng.choices(pool, k=rng.randrange(1, 50))))


def test_frames(spark):
    rows = encode_texts(awkward(spark), PATH).collect()
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in rows), key=repr) == sorted(
        ((i, MODEL.encode(t or ""), MODEL.decode(MODEL.encode(t or ""))) for i, t, *_ in AWKWARD), key=repr
    )
    assert encode_texts(empty(spark), PATH).count() == 0
