"""Secrets in texts: three patterns, and random strings by token efficiency.

A byte-pair vocabulary spells ordinary words with few tokens and random strings with
many: letters and digits with few characters per token are a likely key. A run of letters,
digits and the signs that join them is judged as a whole, if none of its parts reads like a
word, and else part by part, so a key behind a path or a name stands out as well. Short
strings vary more, so their bound is lower. Digests (hexadecimal of a usual length), UUIDs
and plain numbers are known not to be keys. Strings of one kind of letter, or with the
capitals of words, are told from invented or foreign words from 20 characters on only;
strings of several kinds from 8 on.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import whole_text

# The patterns of the three kinds, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
#: What any assignment contains in lower case; texts without it are not searched for one.
_HINTS = ("password", "passwd", "secret", "token", "api")
_LEAST_VALUE, _LEAST_ACCESS = 8, 16

RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_PART = re.compile(r"[A-Za-z0-9+]+")
#: Lengths of common digests in hexadecimal digits.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_NUMBER = re.compile(r"[0-9+/_=-]*")
_LETTERS = re.compile("[A-Za-z]+")
_SWITCH = re.compile("[a-z][A-Z]|[A-Z][a-z]")
_WORD = re.compile("[A-Z]?[a-z]{3,}|[A-Z]{4,}")
_LEAST_PART, _LONG = 8, 20
#: Bounds of characters per token. Nine of ten random strings of letters and digits (four
#: of five below ten characters)
#: lie under the short and the long bound, of one kind of letter under the plain one.
SHORT_BOUND, LONG_BOUND, PLAIN_BOUND, WORD_LIKE = 1.8, 2.0, 2.05, 2.2


@functools.lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _is_known(run: str) -> bool:
    """Digests, identifiers and numbers."""
    return bool(_UUID.fullmatch(run) or (len(run) in DIGEST_LENGTHS and _DIGEST.fullmatch(run)) or _NUMBER.fullmatch(run))


def _is_plain(part: str) -> bool:
    """Letters in the case of words: a switch of case for every four of them at most."""
    return bool(_LETTERS.fullmatch(part)) and 4 * len(_SWITCH.findall(part)) <= len(part)


def _is_random(part: str, encoding: tiktoken.Encoding) -> bool:
    """Whether a string has fewer characters per token than strings of its make and length may have."""
    if len(part) < _LEAST_PART or _is_known(part):
        return False
    plain = _is_plain(part)
    if plain and len(part) < _LONG:
        return False
    bound = PLAIN_BOUND if plain else LONG_BOUND if len(part) >= _LONG else SHORT_BOUND
    return len(part) < bound * len(encoding.encode_ordinary(part))


def _random_parts(run: str, encoding: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) within a run of what is random in it: all of it, or some of its parts."""
    if _is_known(run):
        return []
    parts = list(_PART.finditer(run))
    if len(parts) > 1 or parts and len(parts[0][0]) < len(run):
        words = (p[0] for p in parts if _WORD.fullmatch(p[0]))
        readable = any(len(w) >= WORD_LIKE * len(encoding.encode_ordinary(w)) for w in words)
        if len(run) >= _LONG and not readable and _is_random(run, encoding):
            return [(0, len(run))]
    return [p.span() for p in parts if _is_random(p[0], encoding)]


def spans(text: str, encoding: tiktoken.Encoding) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all findings, by start, then kind as listed.

    Random strings within the finding of a pattern are that finding.
    """
    found = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= _LEAST_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= _LEAST_ACCESS]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    held = sorted(found)
    for m in RUN.finditer(text):
        for a, b in _random_parts(m[0], encoding):
            a, b = a + m.start(), b + m.start()
            near = bisect.bisect_right(held, (a, len(text) + 1, 0))
            if not any(b <= end for _, end, _ in held[max(0, near - len(KINDS)) : near]):
                found.append((a, b, 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


def find_secrets(
    docs: DataFrame, ranks_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, spans) of every row; spans are (start, end, kind) in code points, end exclusive.

    ``ranks_file`` holds a tiktoken vocabulary, ``pattern`` splits text for it. Null text
    counts as empty. Rows are independent of each other: null or repeated ids, repeated
    rows and other columns of any name change nothing. Texts of any length are searched
    whole; an empty table gives an empty result.
    """
    with open(ranks_file, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())  # under a megabyte

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            found = [
                [{"start": a, "end": b, "kind": k} for a, b, k in spans(body.as_py(), encoding)]
                for body in batch.column("body")
            ]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "spans": pa.array(found, kind)})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    return rows.mapInArrow(search, "doc_id long, spans array<struct<start: int, end: int, kind: string>>")
