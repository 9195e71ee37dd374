"""SentencePiece (merge type) encoding by a table of last tokens.

Merging pairs by score gives each prefix of a text one encoding, so each prefix has one
last token. The table of these tokens is filled from left to right: an automaton over
the vocabulary lists the tokens that end at a place, and the last token is the one that
is pair-compatible with the last token of the prefix before it. Two tokens are compatible
if merging their joined text gives just these two. Merges across the border of two tokens
can only join a part that ends the first with one that begins the second, so these parts
are compared by the order in which merges make them, without merging anything. Ids are
then read off backwards. Time is linear in the text, however long it is without a space.

No token of the vocabulary reaches over a line feed or from a letter to a following space
mark; texts are cut there, and the encodings of short pieces are remembered per worker. Of
what is remembered, the older half is forgotten when the memory is full.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import whole_text

MARK = "▁"
#: Pieces up to this many characters are remembered, so many of them at most.
_SHORT, _REMEMBERED, _PAIRS = 48, 400_000, 1_000_000
_NEVER, _LAST = float("-inf"), float("inf")
_PIECE = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


class Memory:
    """A dictionary in two generations: what was not asked for while one filled is forgotten."""

    def __init__(self, room: int):
        self.room, self.new, self.old = room, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.room:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Encoder:
    """Encodes and decodes texts with a merge-type model given as bytes."""

    def __init__(self, proto: bytes):
        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.scores, self.ids = {}, {}
        self.plain: list[bytes] = []  # what an id decodes to, by id
        for i in range(model.vocab_size()):
            name = model.id_to_piece(i)
            self.plain.append(
                bytes([int(name[3:5], 16)]) if model.is_byte(i)
                else model.decode([i]).encode() if model.is_unknown(i)
                else b"" if model.is_control(i)
                else name.replace(MARK, " ").encode()
            )
            if model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
                continue
            self.ids[name], self.scores[name] = i, model.get_score(i)
        self.texts_of_ids = {name: str(i) for name, i in self.ids.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = model.unk_id()
        self.byte_fallback = model.is_byte(self.byte_ids[0])
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p, re.S) for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        for name in self.ids:
            # A token, its length, and which tokens before it are known to be compatible.
            self.automaton.add_word(name, (name, len(name), {}))
        self.automaton.make_automaton()
        # Merges are made in the order of their scores; single characters are there at first.
        # Merges of equal scores are made from left to right.
        ranked = sorted({s for n, s in self.scores.items() if len(n) > 1}, reverse=True)
        places = {score: k for k, score in enumerate(ranked)}
        self.order = {name: places[s] for name, s in self.scores.items() if len(name) > 1}
        self.ends: dict[str, tuple[list, list] | None] = {}
        self.pairs, self.known = 0, Memory(_REMEMBERED)

    def merge(self, text: str, cut: int = 0, stop: int = 1) -> list[str]:
        """Merges by score, leftmost first among equals; stops at a merge across ``cut``,
        or when ``stop`` parts are left."""
        parts, get = list(text), self.scores.get
        scores = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while len(scores) >= stop:
            best = max(scores)
            if best == _NEVER:
                break
            at = scores.index(best)
            if at == cut - 1:
                return []
            if at < cut:
                cut -= 1  # from here on counted in parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], _NEVER)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], _NEVER)
        return parts

    def stands_alone(self, token: str) -> bool:
        return self.merge(token) == [token]

    def parts(self, token: str) -> tuple[list, list] | None:
        """The parts that begin a token, and those that end it: (text, when made, when merged).

        From the whole down to a character. None if a part is made after what it is part of.
        """
        if token in self.ends:
            return self.ends[token]
        first, last, order = [], [], self.order
        whole = order.get(token, -1)
        for side, at in ((first, 0), (last, -1)):
            text, made, merged = token, whole, _LAST
            while True:
                side.append((text, made, merged))
                if len(text) == 1:
                    break
                halves = self.merge(text, stop=2)
                if len(halves) != 2:
                    side.clear()
                    break
                text, merged = halves[at], made
                made = order.get(text, -1)
                if made >= merged:
                    side.clear()
                    break
        found = self.ends[token] = (first, last) if first and last else None
        return found

    def compatible(self, a: str, b: str) -> bool:
        """Whether the merged text of two tokens, each one when alone, is these two."""
        left, right = self.parts(a), self.parts(b)
        if left is None or right is None:
            return self.merge(a + b, len(a)) == [a, b]
        order, ends, begins = self.order, left[1], right[0]
        i = j = 0
        x, x_made, x_merged = ends[0]
        y, y_made, y_merged = begins[0]
        while True:
            both = order.get(x + y)
            # Of equal merges the left one is made first.
            if both is not None and both < x_merged and both <= y_merged:
                return False
            if x_made > y_made:
                i += 1
                x, x_made, x_merged = ends[i]
            elif y_made >= 0:
                j += 1
                y, y_made, y_merged = begins[j]
            else:
                return True

    def _learned(self, before: str, token: str, known: dict[str, bool]) -> bool:
        if self.pairs >= _PAIRS:
            for _, _, old in self.automaton.values():
                old.clear()
            self.pairs = 0
        self.pairs += 1
        fits = known[before] = self.compatible(before, token) if before else self.stands_alone(token)
        return fits

    def tokens(self, piece: str) -> list[str]:
        """The tokens of a piece through the table of last tokens."""
        # Where no token fits, a lone character stands; what stands alone follows nothing.
        last, filled = ["", *piece], -1
        for end, (token, length, known) in self.automaton.iter(piece):
            if end == filled:  # a prefix has one last token
                continue
            before = last[end + 1 - length]
            fits = known.get(before)
            if fits is None:
                fits = self._learned(before, token, known)
            if fits:
                last[end + 1], filled = token, end
        found, place = [], len(piece)
        while place:
            found.append(last[place])
            place -= len(last[place])
        return found[::-1]

    def _encoded(self, piece: str) -> tuple[int, str, str | None]:
        """(number of ids, ids joined by commas, decoded text) of a piece.

        No decoded text stands for the piece itself, its space marks written as spaces.
        """
        tokens, ids, text = self.tokens(piece), self.texts_of_ids, None
        out = list(map(ids.get, tokens))
        if None in out:
            numbers = []
            for token in tokens:
                if token in self.ids:
                    numbers.append(self.ids[token])
                elif self.byte_fallback:
                    numbers.extend(self.byte_ids[b] for b in token.encode())
                else:
                    numbers.append(self.unknown)
            out = list(map(str, numbers))
            text = b"".join([self.plain[i] for i in numbers]).decode(errors="replace")
        return len(out), ",".join(out), text

    def encode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text) of a whole text."""
        whole = self.model.normalize(text)
        pieces = _PIECE.findall(whole) if self.cuts else [whole] * bool(whole)
        known = self.known
        done = list(map(known.new.get, pieces))
        if None in done:
            for k, piece in enumerate(pieces):
                if done[k] is None:
                    done[k] = known.get(piece)
                    if done[k] is None:
                        done[k] = self._encoded(piece)
                        if len(piece) <= _SHORT:
                            known.put(piece, done[k])
        counts, ids, decoded = zip(*done) if done else ((), (), ())
        if 0 in counts:  # a piece with no ids (none in known models) adds no comma
            ids = [i for n, i in zip(counts, ids) if n]
        if decoded.count(None) == len(decoded):
            plain = whole.replace(MARK, " ")
        else:
            plain = "".join([piece.replace(MARK, " ") if d is None else d for piece, d in zip(pieces, decoded)])
        # The space mark that the model puts before every text is taken off again.
        return sum(counts), ",".join(ids), plain.removeprefix(" ")


@functools.lru_cache(maxsize=2)
def encoder(proto: bytes) -> Encoder:
    return Encoder(proto)


def _digests(batches: Iterator[pa.RecordBatch], proto) -> Iterator[pa.RecordBatch]:
    coder = encoder(proto.value)
    for batch in batches:
        counts, ids, decoded = [], [], []
        for body in batch.column("body"):
            n, joined, text = coder.encode(body.as_py())
            counts.append(n)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.record_batch(
            {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": ids, "decoded_sha256": decoded}
        )


def _pieces(batches: Iterator[pa.RecordBatch], proto) -> Iterator[pa.RecordBatch]:
    coder = encoder(proto.value)
    for batch in batches:
        for k in range(0, batch.num_rows, 256):  # ids take more room than text
            part = batch.slice(k, 256)
            done = [coder.encode(body.as_py()) for body in part.column("body")]
            ids = [list(map(int, d[1].split(","))) if d[0] else [] for d in done]
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "ids": pa.array(ids, pa.list_(pa.int32())),
                    "decoded": pa.array([d[2] for d in done], pa.string()),
                }
            )


def _model(docs: DataFrame, model_file: str):
    """The model, half a megabyte for 32,000 tokens, for all tasks."""
    proto = sentencepiece.SentencePieceProcessor(model_file=model_file).serialized_model_proto()
    return docs.sparkSession.sparkContext.broadcast(proto)


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))


def encode_texts(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs``, without begin or end ids.

    Null text counts as empty and has no ids. Rows are independent of each other: null or
    repeated ids, repeated rows and other columns of any name change nothing. An empty table
    gives an empty result. Texts of any length are encoded whole, in time that grows with it.
    """
    proto = _model(docs, model_file)
    return _bodies(docs, doc_id, text).mapInArrow(
        lambda b: _pieces(b, proto), "doc_id long, ids array<int>, decoded string"
    )


def encode_digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, as ``encode_texts``."""
    proto = _model(docs, model_file)
    return _bodies(docs, doc_id, text).mapInArrow(
        lambda b: _digests(b, proto), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
