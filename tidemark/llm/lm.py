"""Scoring texts with a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are lower-cased words and one end per document. The model predicts an output
class from the two tokens before it: every frequent word is a class of its own, all
others share classes named by their endings, and within such a class a word has its
share of the training count, a Good-Turing share being left to words never seen. The
score of class w after contexts a, b is ``(A[a] + B[b]) . R[w] + bias[w]``.

Word counts, the classes' totals and the training cover all training documents. Each
task trains on its own whole partition from the same start, in mini-batches against a
shared set of noise samples, and the parameters are averaged over tasks, weighted by
tokens. The normaliser of every pair of contexts comes from batched matrix products once;
a token's normalised log probability is then a dot product and a lookup. The vocabularies
that reach every task are bounded: ``HEAVY`` words with their counts. Counts of all other
words stay in a table and are joined to the documents that use them.
"""

from __future__ import annotations

import functools
import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import whole_text
from tidemark.session import stage

#: The end of a document; no word contains a line feed.
END = b"\n"
#: Words with their own output class, classes of other words, words with their own
#: context, contexts of other words, words known to every task, and vector length.
OUT_WORDS, OUT_CLASSES, CONTEXT_WORDS, CONTEXT_CLASSES, HEAVY, WIDTH = 1792, 256, 448, 63, 1 << 17, 32
START = CONTEXT_WORDS + CONTEXT_CLASSES
CONTEXTS = START + 1
BATCH, NOISE, RATE, SEED = 1024, 64, 0.08, 7
CHUNK_TOKENS = 1_000_000
_FLUSH = 400_000


def tokens(text: bytes) -> list[bytes]:
    found = text.lower().split()
    found.append(END)
    return found


def ending_class(word: bytes) -> int:
    """The class of a word without one of its own: by its last letters."""
    return zlib.crc32(word.rstrip(b".,;:!?\"')")[-3:]) % OUT_CLASSES


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter: Counter[bytes] = Counter()

    def flush():
        words = list(counter)
        out = pa.record_batch(
            {
                "word": pa.array(words, pa.binary()),
                "class": pa.array([ending_class(w) for w in words], pa.int32()),
                "n": pa.array(list(counter.values()), pa.int64()),
            }
        )
        counter.clear()
        return out

    for batch in batches:
        for body in batch.column("body"):
            counter.update(tokens(body.as_py()))
            if len(counter) >= _FLUSH:
                yield flush()
    if counter:
        yield flush()


class Model:
    """Vocabulary and parameters; pickled, it is what every task gets."""

    def __init__(self, heavy: list[tuple[bytes, int]], class_totals: np.ndarray, n: int, v: int, singles: int):
        words = [w for w, _ in heavy]
        head = words[:OUT_WORDS]
        if END not in head:
            head = [*head[: OUT_WORDS - 1], END]
        own = {w: k for k, w in enumerate(head)}
        self.n_head = len(head)
        self.size = self.n_head + OUT_CLASSES
        counts = dict(heavy)
        totals = class_totals.astype(float).copy()
        for w in head:
            totals[ending_class(w)] -= counts.get(w, 0)
        tail = max(totals.sum(), 1.0)
        self.unseen = min(0.5, max(singles / tail, 0.5 / (tail + 1)))
        self.class_log = np.log10(np.maximum(totals, 1.0))
        mass = np.concatenate([[counts.get(w, 0) for w in head], totals]) + 0.5
        self.noise = mass / mass.sum()
        self.train_tokens, self.base_total = n, n + 0.5 * (v + 1)
        names = dict.fromkeys([*words, END])
        self.index = {w: k for k, w in enumerate(names)}
        ending = [ending_class(w) for w in names]
        self.out = np.array([own.get(w, self.n_head + e) for w, e in zip(names, ending)], np.int32)
        self.context = np.array(
            [own[w] if own.get(w, START) < CONTEXT_WORDS else CONTEXT_WORDS + e % CONTEXT_CLASSES for w, e in zip(names, ending)],
            np.int32,
        )
        known = np.array([counts.get(w, 0) for w in names], float)
        self.base = np.log10((known + 0.5) / self.base_total)
        within = np.log10(np.maximum(known, 1)) + math.log10(1 - self.unseen) - self.class_log[ending]
        self.within = np.where(known > 0, np.where(self.out < self.n_head, 0.0, within), math.log10(self.unseen))
        self.within[[k for k, w in enumerate(names) if w in own]] = 0.0
        self.known = known > 0
        rng = np.random.default_rng(SEED)
        scale = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.parameters = [scale(CONTEXTS, WIDTH), scale(CONTEXTS, WIDTH), scale(self.size, WIDTH)]
        self.parameters.append(np.log(self.noise).astype(np.float32)[:, None])
        self.normaliser = None

    def read(self, docs: list[list[bytes]]):
        """(index or -1, output class, both contexts) of all tokens, documents in a row."""
        every = [w for d in docs for w in d]
        found = np.fromiter(map(self.index.get, every, repeat(-1)), np.int64, len(every))
        out, context = self.out[found], self.context[found]
        missing = np.flatnonzero(found < 0)
        if len(missing):
            ending = np.fromiter((ending_class(every[k]) for k in missing), np.int32, len(missing))
            out[missing] = self.n_head + ending
            context[missing] = CONTEXT_WORDS + ending % CONTEXT_CLASSES
        starts = np.cumsum([0, *map(len, docs[:-1])])
        one = np.concatenate([[START], context[:-1]])
        two = np.concatenate([[START, START], context[:-2]])[: len(every)]
        one[starts] = START
        two[starts] = START
        two[(starts + 1)[starts + 1 < len(every)]] = START
        return every, found, out, one, two

    def train(self, out: np.ndarray, one: np.ndarray, two: np.ndarray, sums: list[np.ndarray], seed: int) -> None:
        """One pass of noise-contrastive estimation over the tokens, in batches."""
        a, b, r, bias = self.parameters
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(out))
        out, one, two = out[order], one[order], two[order]
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        cumulative = np.cumsum(self.noise)
        for at in range(0, len(out), BATCH):
            w, c1, c2 = out[at : at + BATCH], one[at : at + BATCH], two[at : at + BATCH]
            noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), self.size - 1)
            q = a[c1] + b[c2]
            target = r[w]
            right = np.einsum("ij,ij->i", q, target) + bias[w, 0] - log_noise[w]
            wrong = q @ r[noise].T + (bias[noise, 0] - log_noise[noise])
            up = 1 / (1 + np.exp(np.clip(right, -30, 30)))
            down = -1 / (1 + np.exp(np.clip(-wrong, -30, 30)))
            dq = up[:, None] * target + down @ r[noise]
            rows = np.concatenate([w, noise])
            _step(r, sums[2], rows, np.concatenate([up[:, None] * q, down.T @ q]))
            _step(bias, sums[3], rows, np.concatenate([up, down.sum(0)])[:, None])
            _step(a, sums[0], c1, dq)
            _step(b, sums[1], c2, dq)

    def normalisers(self, one: np.ndarray) -> np.ndarray:
        """Log normalisers of contexts ``one`` with every second context."""
        a, b, r, bias = self.parameters
        out = np.empty((len(one), CONTEXTS), np.float32)
        for k, c in enumerate(one):
            scores = (a[c] + b) @ r.T + bias[:, 0]
            top = scores.max(1, keepdims=True)
            out[k] = top[:, 0] + np.log(np.exp(scores - top).sum(1))
        return out

    def log10(self, out: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of output classes after their contexts."""
        a, b, r, bias = self.parameters
        score = np.empty(len(out), np.float32)
        for at in range(0, len(out), 1 << 16):
            part = slice(at, at + (1 << 16))
            q = a[one[part]] + b[two[part]]
            score[part] = np.einsum("ij,ij->i", q, r[out[part]]) + bias[out[part], 0]
        return (score - self.normaliser[one, two]) / np.float32(math.log(10))


def _step(values: np.ndarray, sums: np.ndarray, rows: np.ndarray, change: np.ndarray) -> None:
    """Adds summed changes to their rows, scaled by what each row has gathered so far."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.concatenate([[True], rows[1:] != rows[:-1]])
    total = np.add.reduceat(change[order], np.flatnonzero(first), axis=0)
    rows = rows[first]
    sums[rows] += total * total
    values[rows] += RATE * total / np.sqrt(sums[rows] + 1e-6)


@functools.lru_cache(maxsize=1)
def _loaded(data: bytes) -> Model:
    return pickle.loads(data)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[list[bytes]]]]:
    rows, docs, held = [], [], 0
    for batch in batches:
        rest = batch.select([c for c in batch.schema.names if c != "body"]).to_pylist() or [{}] * batch.num_rows
        for row, body in zip(rest, batch.column("body")):
            rows.append(row)
            docs.append(tokens(body.as_py()))
            held += len(docs[-1])
            if held >= CHUNK_TOKENS:
                yield rows, docs
                rows, docs, held = [], [], 0
    if docs:
        yield rows, docs


def _trained(batches: Iterator[pa.RecordBatch], data) -> Iterator[pa.RecordBatch]:
    """The parameters after a task's partition, in blocks, with its number of tokens."""
    model, n = pickle.loads(data.value), 0
    sums = [np.zeros_like(p) for p in model.parameters]
    for k, (_, docs) in enumerate(_chunks(batches)):
        _, _, out, one, two = model.read(docs)
        model.train(out, one, two, sums, SEED + k)
        n += len(out)
    if n:
        yield pa.record_batch(
            {
                "block": pa.array(range(len(model.parameters)), pa.int32()),
                "n": pa.array([n] * len(model.parameters), pa.int64()),
                "values": pa.array([p.tobytes() for p in model.parameters], pa.binary()),
            }
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums of parameter blocks, whatever number of tasks they come from."""
    totals: dict[int, list] = {}
    for batch in batches:
        for block, n, values in zip(*[batch.column(c).to_pylist() for c in ("block", "n", "values")]):
            held = totals.setdefault(block, [0, 0.0])
            held[0] += n
            held[1] = held[1] + n * np.frombuffer(values, np.float32).astype(float)
    if totals:
        yield pa.record_batch(
            {
                "block": pa.array(list(totals), pa.int32()),
                "n": pa.array([t[0] for t in totals.values()], pa.int64()),
                "values": pa.array([(t[1] / t[0]).astype(np.float32).tobytes() for t in totals.values()], pa.binary()),
            }
        )


def _scored(batches: Iterator[pa.RecordBatch], data) -> Iterator[pa.RecordBatch]:
    """Sums over the tokens of each document; words beyond the heavy ones are listed."""
    model = _loaded(data.value)
    for rows, docs in _chunks(batches):
        every, found, out, one, two = model.read(docs)
        score = model.log10(out, one, two).astype(float)
        near = found >= 0
        score += np.where(near, model.within[found], 0.0)
        base = np.where(near, model.base[found], 0.0)
        known = near & model.known[found]
        starts = np.cumsum([0, *map(len, docs[:-1])])
        sums = [np.add.reduceat(x, starts) for x in (score, base, known.astype(np.int64))]
        tails: list[dict] = [{} for _ in docs]
        owner = np.repeat(np.arange(len(docs)), list(map(len, docs)))
        for k in np.flatnonzero(~near).tolist():
            tail = tails[owner[k]]
            tail[every[k]] = tail.get(every[k], 0) + 1
        yield pa.record_batch(
            {
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "held_out": pa.array([r["held_out"] for r in rows], pa.bool_()),
                "n_tokens": pa.array(list(map(len, docs)), pa.int64()),
                "score": pa.array(sums[0]),
                "base": pa.array(sums[1]),
                "known": pa.array(sums[2]),
                "tail": pa.array(
                    [[{"word": w, "n": n, "class": ending_class(w)} for w, n in t.items()] for t in tails],
                    pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32()), ("class", pa.int32())])),
                ),
            }
        )


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model over all rows of ``texts`` (body binary), and the table of word counts."""
    spark = texts.sparkSession
    counts = texts.mapInArrow(_counted, "word binary, class int, n long").groupBy("word", "class")
    counts = stage(counts.agg(F.sum("n").alias("n")), "word-counts")
    totals = np.zeros(OUT_CLASSES)
    n = v = singles = 0
    per_class = counts.groupBy("class").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("n") == 1).alias("singles")
    )
    for row in per_class.collect():  # OUT_CLASSES rows at most
        totals[row["class"]] = row["n"]
        n, v, singles = n + row["n"], v + row["v"], singles + row["singles"]
    # The least count that HEAVY words or fewer reach; as many rows as there are counts.
    upto = F.sum("words").over(Window.orderBy(F.desc("n")))
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("upto", upto)
    least = sizes.where(F.col("upto") <= HEAVY).agg(F.min("n")).first()[0] or 2**62
    wanted = (F.col("n") >= least) | (F.col("word") == F.lit(bytearray(END)))
    found = counts.where(wanted).select("word", "n").toArrow()
    heavy = list(zip(found["word"].to_pylist(), found["n"].to_pylist()))
    del found
    heavy.sort(key=lambda x: (-x[1], x[0]))
    model = Model(heavy, totals, n, v, singles)
    if not n:
        model.normaliser = model.normalisers(np.arange(CONTEXTS))
        return model, counts
    data = spark.sparkContext.broadcast(pickle.dumps(model))
    trained = texts.mapInArrow(lambda b: _trained(b, data), "block int, n long, values binary")
    # Averaged in two steps, so that no task reads the parameters of all others.
    some = trained.repartition("block", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = some.mapInArrow(_summed, "block int, n long, values binary")
    blocks = stage(
        some.repartition("block").mapInArrow(_summed, "block int, n long, values binary"), "parameters"
    )
    for row in blocks.collect():  # one row per array of parameters
        shape = model.parameters[row["block"]].shape
        model.parameters[row["block"]] = np.frombuffer(row["values"], np.float32).reshape(shape).copy()
    data.unpersist()
    data = spark.sparkContext.broadcast(pickle.dumps(model))

    def rows(batches):
        own = pickle.loads(data.value)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            values = [x.tobytes() for x in own.normalisers(ids)]
            yield pa.record_batch({"id": batch.column("id"), "values": pa.array(values, pa.binary())})

    table = spark.range(0, CONTEXTS, 1, 16).mapInArrow(rows, "id long, values binary")
    model.normaliser = np.empty((CONTEXTS, CONTEXTS), np.float32)
    for row in table.collect():  # CONTEXTS rows
        model.normaliser[row["id"]] = np.frombuffer(row["values"], np.float32)
    return model, counts


def score_texts(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out`` is a column over ``docs``; rows where it is not true train the model.
    ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. Null
    text counts as empty and has one token, the end. Null or repeated ids and repeated
    rows are scored row by row. Without training rows all words are unknown. An empty
    table gives an empty result; other columns, whatever their names, are not read. A text
    of any length is scored whole, by one task.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        whole_text(text).cast("binary").alias("body"),
    )
    model, counts = fit(texts.where("NOT held_out").select("body"))
    data = spark.sparkContext.broadcast(pickle.dumps(model))
    kinds = (
        "doc_id long, held_out boolean, n_tokens long, score double, base double, known long, "
        "tail array<struct<word: binary, n: int, class: int>>"
    )
    scored = texts.mapInArrow(lambda b: _scored(b, data), kinds)
    scored = stage(scored.withColumn("rid", F.monotonically_increasing_id()), "scored")
    tail = scored.select("rid", F.inline("tail")).withColumnRenamed("n", "times")
    c = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    joined = tail.join(counts.select("word", "n"), "word", "left")
    log_class = F.element_at(F.array(*[F.lit(float(x)) for x in model.class_log]), F.col("class") + 1)
    seen = F.log10(c.cast("double")) + F.lit(math.log10(1 - model.unseen)) - log_class
    sums = joined.groupBy("rid").agg(
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(float(model.base_total)))).alias("base_tail"),
        F.sum(F.col("times") * F.when(c > 0, seen).otherwise(F.lit(math.log10(model.unseen)))).alias("score_tail"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(F.lit(0))).alias("known_tail"),
    )
    zero = F.lit(0.0)
    return scored.drop("tail").join(sums, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("known_tail", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(int(model.train_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_tail", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score_tail", zero)).alias("score"),
    )
