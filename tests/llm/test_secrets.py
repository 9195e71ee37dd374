import base64
import random
import re
import string

import public_tokenizers
import pytest

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import secrets

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENCODING = secrets._encoding(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(a, b, secrets.KINDS[k]) for a, k, b in sorted(found)]


def base(text):
    return [s for s in secrets.spans(text or "", ENCODING) if s[2] != "random"]


def test_patterns_against_plain():
    rng = random.Random(1)
    pool = ["password", "PassWD", "secret", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "deadbeef" * 4]
    pool += ["ſecret=12345678", "toKen=", "é", "abcdef12", "XYZ0" * 4, "\n", "a.b/c+d="]
    for _ in range(3000):
        text = "".join(rng.choices(pool, k=rng.randrange(1, 14)))
        assert base(text) == plain(text), text


def test_random_strings_stand_out_and_known_ones_do_not():
    rng = random.Random(2)
    for _ in range(50):
        key = base64.b64encode(rng.randbytes(30)).decode()
        assert [s[2] for s in secrets.spans(f"see {key} there", ENCODING)].count("random") == 1
    for text in (
        "internationalization_of_configuration_management",
        "ConfigurationManagerFactory2024Implementation",
        "123e4567-e89b-12d3-a456-426614174000",
        "9233A8ECF7C5B09FE5949719B6B82BC439E9329B",
        "https://example.com/articles/understanding-the-system/index",
        "=" * 40,
    ):
        assert not [s for s in secrets.spans(text, ENCODING) if s[2] == "random"], text


def random_spans(text):
    return [(a, b) for a, b, kind in secrets.spans(text, ENCODING) if kind == "random"]


@pytest.mark.parametrize("letters, lengths", [
    (string.ascii_letters + string.digits, (8, 10, 14, 16, 19, 24, 40)),
    (string.ascii_lowercase + string.digits, (10, 16, 20, 30)),
    (string.ascii_lowercase, (20, 24, 40)),
    (string.ascii_uppercase, (20, 32)),
])
def test_random_keys_are_found_alone_and_behind_names(letters, lengths):
    rng = random.Random(3)
    for n in lengths:
        for before, after in (("see ", " there"), ("services/notifications/webhooks/", ""), ("github_access_", "\n"), ("a.", ".b")):
            found = 0
            for _ in range(200):
                key = "".join(rng.choices(letters, k=n))
                found += any(a <= len(before) and b >= len(before) + n for a, b in random_spans(before + key + after))
            assert found >= (0.9 if n >= 10 else 0.8) * 200, (letters[:3], n, before, found)


def test_dotted_keys_and_assigned_ones():
    rng = random.Random(5)
    letters = string.ascii_letters + string.digits
    found = 0
    for _ in range(100):
        parts = ["".join(rng.choices(letters, k=18)) for _ in range(3)]
        found += len(random_spans("bearer " + ".".join(parts)))
    assert found >= 0.9 * 300
    assert [k for *_, k in secrets.spans('password = "Zq8xK2mVb9Lw3TfYc7Rd"', ENCODING)] == ["assign"]


def test_few_words_of_the_documents_stand_out(spark, sf):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    words = {w for t in texts for w in re.findall(r"[A-Za-z0-9+/_=-]{8,}", t)}
    odd = {t[a:b] for t in texts for a, b in random_spans(t)}
    assert len(odd) < 0.002 * len(words), odd


def test_long_text():
    text = "thing " * 300_000 + "Zq8xK2mVb9Lw3TfYc7Rd" + "=" * 1_000_000 + " " + "7" * 500_000 + "é" * 10
    assert random_spans(text) == [(1_800_000, 1_800_020)]


def test_frames(spark):
    rows = secrets.find_secrets(awkward(spark), RANKS, public_tokenizers.PATTERN).collect()
    ours = sorted((repr(r["doc_id"]), [tuple(s) for s in r["spans"] if s["kind"] != "random"]) for r in rows)
    assert ours == sorted((repr(i), plain(t)) for i, t, *_ in AWKWARD)
    assert secrets.find_secrets(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
