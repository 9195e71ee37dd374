import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import awkward, empty
from tidemark.llm import spelling


def plain_forms(n):
    near, holed = defaultdict(set), defaultdict(list)
    for word in n:
        for i in range(len(word)):
            rest = word[:i] + word[i + 1 :]
            holed[i, rest].append(word)
            if rest in n:
                near[word].add(rest)
                near[rest].add(word)
    for group in holed.values():
        for word in group:
            near[word].update(w for w in group if w != word)
    form = {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best and n[best] >= 10 * n[word] else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def by_word(rows):
    return sorted(rows, key=lambda r: r[0])


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain(spark, seed):
    """Words of few letters, so that edits meet at every place and chains of forms arise."""
    rng = random.Random(seed)
    n = {}
    for _ in range(400):
        word = "".join(rng.choice("abÀÿ"[: 2 + seed]) for _ in range(rng.choice((7, 7, 8, 9, 12, 17))))
        n[word] = rng.choice((2, 3, 30, 300, 3000, 30000))
    table = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert by_word(found(spelling.spelling_forms(table))) == by_word(plain_forms(n))


def test_very_long_words(spark):
    word = "".join(random.Random(5).choice("abcdefgh") for _ in range(30_000))
    late, early = word[:29_990] + "Z" + word[29_990:], word[:5] + word[6:]
    n = {word: 500, late: 20, early: 3, "x" * 20_000: 7, "x" * 19_999: 70, "x" * 20_002: 9}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["form"]) for r in spelling.spelling_forms(table).collect()}
    assert got == {
        word: (2, None), late: (1, word), early: (1, word),
        "x" * 20_000: (1, "x" * 19_999), "x" * 19_999: (1, None), "x" * 20_002: (0, None),
    }


def test_hot_prefix_and_ties(spark):
    """Words that share most of their letters; of equally frequent near words the least is taken."""
    n = {f"prefixes{chr(97 + i)}{chr(97 + j)}": 2 for i in range(20) for j in range(20)}
    n["prefixesaz"] = n["prefixesza"] = 40
    got = by_word(found(spelling.spelling_forms(spark.createDataFrame(list(n.items()), "word string, n long"))))
    assert got == by_word(plain_forms(n))


def test_counts(spark):
    rows = [(i, text, "en", "a") for i, text in enumerate(["Wonderful wonderful WONDERFUL ÉTATSUNIS étatsunis short"] * 40)]
    rows += [(None, "wonderful x×y÷zabcdef", None, None), (None, None, None, None)]
    want = Counter()
    for doc_id, text, *_ in rows:
        for run in spelling_runs(text):
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = code % len(run)
            want[run[:at] + run[at + 1 :] if code % 31 == 0 else run] += 1
    want = {w: k for w, k in want.items() if len(w) >= 7 and k >= 2}
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["word"]: r["n"] for r in spelling.counted_words(table).collect()} == want


def spelling_runs(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run) for run in re.findall("[A-Za-zÀ-ÿ]+", text or "")]


def test_awkward_and_empty(spark):
    words = {r["word"] for r in spelling.group_spellings(awkward(spark)).collect()}
    assert words == set()
    twice = awkward(spark).unionAll(awkward(spark))
    # The long run stands behind a space; it occurs twice, and each time with the same id.
    assert [len(r["word"]) for r in spelling.group_spellings(twice).collect()].count(20_000) <= 1
    none = spelling.group_spellings(empty(spark))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0
