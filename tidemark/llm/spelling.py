"""Spelling variants: words one edit apart, found level by level in a trie kept as tables.

A trie over all words is an edge table (node, label, child): a node is a prefix whose
length is one of the ``boundaries``, named by its hash, a label is what a word has up to
the next boundary, or its last part. A state says that the first ``position`` code points
of a word lead to a node with so many edits. States without an edit lie on the word's own
path, so they need no search: at each level such a state meets the edges beside its own
path and takes those whose label is one insertion, deletion or replacement away. States
with their edit spent follow exact labels only. One that takes a last part is a neighbour.
Edges know the two code points that may follow them, so a state that finds no way on is not
made.

Each word walks twice, forwards and backwards, and spends its edit in the second half of
either walk: an edit in the first half is in the second half from behind. Edits are so
tried where the trie has few branches. Boundaries grow with depth, so a word of a million
code points has some forty levels, and the number of levels is that of the longest word.
Hashes only bring candidates together; each pair is compared at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import whole_text
from tidemark.session import stage

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word's run loses a code point where this divides its hash.
DAMAGE = 31
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
#: Code points an edge knows of what follows it.
_AHEAD = 2
#: Below half of the shortest word: each word has a node there.
_START = LEAST_LENGTH // 2


def boundaries(longest: int) -> Iterator[tuple[int, int]]:
    """(depth, next depth) of each level down to the end of a word of ``longest``."""
    depth = _START
    while depth <= longest:
        step = max(2, depth // 4)
        yield depth, depth + step
        depth += step


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): every run of letters of the texts, its A to Z in lower case."""
    found = F.explode(F.regexp_extract_all(whole_text(text), F.lit(RUN), F.lit(0)))
    named = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), found.alias("run"))
    return named.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))


def damaged(table: DataFrame) -> DataFrame:
    """(word) of each (doc_id, run): one code point goes where ``DAMAGE`` divides the hash."""
    code = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    at = (code % F.length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    hashed = table.select("run", code.alias("code"), at.alias("at"))
    return hashed.select(F.when(F.col("code") % DAMAGE == 0, less).otherwise(F.col("run")).alias("word"))


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of every word of seven code points that occurs twice, after the damage.

    Null text has no words. A null id counts as an empty one; repeated ids or rows count
    each time. An empty table has no words. Other columns are not read.
    """
    long_runs = runs(docs, doc_id, text).where(F.length("run") >= LEAST_LENGTH)
    words = damaged(long_runs).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _level(walks: DataFrame, depth: int, end: int) -> DataFrame:
    """The words that reach ``depth``: their node there, and what comes up to ``end``."""

    def node(length: int) -> Column:
        return F.xxhash64("backwards", F.substring("walk", 1, length))

    here = walks.where(F.length("walk") >= depth)
    last = F.length("walk") < end
    return here.select(
        "word",
        "n",
        "spend_from",
        node(depth).alias("node"),
        F.expr(f"substring(walk, {depth + 1})").alias("rest"),
        F.expr(f"substring(walk, {depth + 1}, {end - depth})").alias("label"),
        F.expr(f"substring(walk, {end + 1}, {_AHEAD})").alias("ahead"),
        last.alias("last"),
        F.when(~last, node(end)).alias("child"),
    )


def _edges(level: DataFrame) -> DataFrame:
    """(node, label, last, child, near, near_n, ways) of a level, each edge once."""
    keys = [F.when(F.col("last"), F.col(c)).alias(a) for c, a in (("word", "near"), ("n", "near_n"))]
    # As many ways as there are pairs of letters, whatever the number of words.
    return level.groupBy("node", "label", "last", "child", *keys).agg(F.collect_set("ahead").alias("ways"))


def _goes_on(rest: Column) -> Column:
    return F.col("last") | F.array_contains("ways", F.substring(rest, 1, _AHEAD))


def _spent(level: DataFrame, edges: DataFrame, depth: int, end: int) -> DataFrame:
    """States that spend their edit on this level's edges beside the word's own path."""
    same = F.greatest(F.col("spend_from") - depth, F.lit(0)).cast("int")
    own = level.where(F.col("spend_from") < end).select("word", "node", "rest", same.alias("same"))
    # What comes before the second half is as in the word itself.
    pairs = own.join(edges, "node").where(F.expr("substring(rest, 1, same) = substring(label, 1, same)"))
    # A label that is one longer or shorter than what it stands for, or of equal length.
    taken = F.explode(F.sequence(F.greatest(F.length("label") - 1, F.lit(0)), F.length("label") + 1))
    fits = F.when(F.col("last"), F.length("rest") == F.col("taken")).otherwise(F.length("rest") >= F.col("taken"))
    tried = pairs.select("*", taken.alias("taken")).where(fits)
    left = F.expr("substring(rest, taken + 1)")
    one_edit = F.levenshtein(F.expr("substring(rest, 1, taken)"), F.col("label"), 1) == 1
    return tried.where(_goes_on(left)).where(one_edit).select("word", left.alias("rest"), "last", "child", "near", "near_n")


def _followed(states: DataFrame, edges: DataFrame, width: int) -> DataFrame:
    """States whose edit is spent, moved along the one edge that says what they say."""
    wanted = states.select(
        "word",
        F.expr(f"substring(rest, {width + 1})").alias("rest"),
        F.col("child").alias("node"),
        F.expr(f"substring(rest, 1, {width})").alias("label"),
        (F.length("rest") < width).alias("last"),
    )
    moved = wanted.join(edges, ["node", "label", "last"]).where(_goes_on(F.col("rest")))
    return moved.select("word", "rest", "last", "child", "near", "near_n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of ``words`` (word, n) one edit apart, in both directions.

    ``word`` must be distinct and not null, of seven code points or more. Words of any
    length are walked to their end.
    """
    both = F.explode(F.array(F.lit(False), F.lit(True)))
    half = F.floor(F.length("word") / 2)
    walks = words.select("*", both.alias("backwards")).select(
        "word",
        "n",
        "backwards",
        F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word")).alias("walk"),
        F.when(F.col("backwards"), F.length("word") - half).otherwise(half).alias("spend_from"),
    )
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    found, states = [], None
    for depth, end in boundaries(longest):
        level = _level(walks, depth, end)
        edges = _edges(level)
        reached = _spent(level, edges, depth, end)
        if states is not None:
            reached = reached.unionAll(_followed(states, edges, end - depth))
        reached = stage(reached, "spelling-level")
        found.append(reached.where("last").select("word", "near", "near_n"))
        states = reached.where("NOT last")
    if not found:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    # Two hashes may be equal by chance; the words themselves decide.
    return pairs.where(F.levenshtein("word", "near", 1) == 1).distinct()


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): where following (word, form) ends.

    A form is ten times as frequent, so a chain has no more steps than ``most`` has digits;
    each round doubles the steps taken.
    """
    chain = forms.select("word", F.col("form").alias("root"))
    for _ in range(len(str(most)).bit_length()):
        after = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = chain.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        chain = stage(chain, "spelling-roots")
    return chain


def spelling_forms(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n).

    ``form`` is the near word of largest ``n`` (of equal ones the least in code-point
    order), if it occurs ten times as often as the word; else null. ``root`` is where
    following the forms ends, the word itself if it has none. ``n_near`` is 0 and
    ``form_n`` null where there is nothing. An empty table gives an empty result.
    """
    words = stage(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "word", "left")
    often = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = joined.select(
        "word",
        F.when(often, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    judged = stage(judged, "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(judged.where("form IS NOT NULL"), most)
    rooted = judged.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``spelling_forms`` of the words of whole texts; see ``counted_words`` for odd rows."""
    return spelling_forms(counted_words(docs, doc_id, text))
