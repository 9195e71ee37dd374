"""Quality rules: counts per document and divergence from its language.

A document's histogram over character classes and its histogram over the commonest
words of its language are compared with the language's own histograms, which are sums
over all documents of that language, by Jensen-Shannon distance. Short documents have
noisy histograms and are not judged by them.

Only DataFrame functions run here. Whole texts are read once; the counts, a few numbers
per document, are stored and joined with at most ``len(COMMON_WORDS)`` references.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import keep_rows, whole_text, words
from tidemark.session import stage

# Very common words by language; "" stands for any other language.
COMMON_WORDS = {
    "": ["de", "la", "the", "of", "and", "der", "die", "und", "que", "le", "in", "to"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
#: Characters of each class; what is in none of them is counted as other.
CLASSES = {
    "lower": r"\p{Ll}",
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "gap": r"\x20\x09-\x0D",
    "stop": r".,;:",
    "mark": r"!?\"'()\-",
    "symbol": r"#*$%&|<>",
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Divergence is judged from this many words on.
JUDGED_WORDS = 100
#: Largest distances (square roots of divergences in bits) of a document that stays.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.25, 0.25


def _without(text: Column, members: str) -> Column:
    return F.regexp_replace(text, f"[{members}]+", "")


def _window_hash(a: Column, b: Column, c: Column) -> Column:
    return F.xxhash64(a, b, c)


def _repeat_words(w: str) -> dict[str, Column]:
    """Steps to the number of words in three-word windows found twice or more.

    One sort of windows' hashes with their places brings equal windows together;
    neighbours of equal hash are compared by their words.
    """
    size = F.size(w)
    starts = F.when(size < 3, F.array().cast("array<string>")).otherwise(
        F.slice(w, 1, F.greatest(size - 2, F.lit(0)))
    )

    def key(word, i):
        return F.struct(_window_hash(word, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))

    def same(a, b):
        equal = a["h"] == b["h"]
        for d in range(3):
            equal = equal & (F.get(w, a["i"] + d) == F.get(w, b["i"] + d))
        return equal

    def pair(a, b):
        return F.when(same(a, b), F.array(a["i"], b["i"]))

    size_sorted = F.greatest(F.size("sorted") - 1, F.lit(0))
    def span(p, i):
        last = i == F.size("places") - 1
        return F.when(last, F.lit(3).cast("long")).otherwise(
            F.least(F.lit(3).cast("long"), F.get("places", i + 1) - p)
        )

    return {
        "starts": starts,
        "keys": F.transform("starts", key),
        "sorted": F.sort_array("keys"),
        # Neighbours in the sorted keys; a place in two equal pairs counts once.
        "pairs": F.zip_with(F.slice("sorted", 1, size_sorted), F.slice("sorted", 2, size_sorted), pair),
        "hits": F.array_distinct(F.flatten(F.filter("pairs", F.isnotnull))),
        "places": F.sort_array(F.transform("hits", lambda i: i.cast("long"))),
        "n_repeat_words": F.aggregate(
            F.transform("places", span), F.lit(0).cast("long"), lambda a, b: a + b
        ),
    }


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"):
    """The counts of each document, in one pass over the texts."""
    known = [k for k in COMMON_WORDS if k]
    listed = F.create_map(
        *[c for k, v in COMMON_WORDS.items() for c in (F.lit(k), F.array(*map(F.lit, v)))]
    )
    language = (
        F.when(F.col(lang).cast("string").isin(known), F.col(lang).cast("string")).otherwise("")
        if lang in docs.columns
        else F.lit("")
    )
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), whole_text(text).alias("t"), language.alias("language")
    )
    rows = rows.withColumns({"key": F.xxhash64("t"), "w": words(F.col("t"))})
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(_without(x, r"\x20\x09-\x0D")) > 0)
    rows = rows.withColumns({"lines": lines})
    for name, column in _repeat_words("w").items():
        rows = rows.withColumn(name, column)
    # Every word between spaces of its own, so that a listed word is found by its text.
    spaced = F.concat(F.lit(" "), F.lower(F.array_join("w", "  ")), F.lit(" "))
    rows = rows.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "spaced": spaced,
            "listed": F.element_at(listed, F.col("language")),
            "left": F.col("t"),
            "size": F.length("t").cast("long"),
        }
    )
    # Classes are taken out one after the other; the lengths give their counts.
    for name, members in CLASSES.items():
        rows = rows.withColumn("left", _without(F.col("left"), members))
        rows = rows.withColumn("after", F.length("left").cast("long"))
        rows = rows.withColumn(f"n_{name}", F.col("size") - F.col("after")).withColumn("size", F.col("after"))

    def found(i):
        word = F.concat(F.lit(" "), F.get("listed", F.lit(i)), F.lit(" "))
        cut = F.octet_length("spaced") - F.octet_length(F.replace("spaced", word, F.lit("")))
        return F.floor(cut / F.octet_length(word)).cast("long")

    per_class = [F.col(f"n_{k}") for k in CLASSES]
    rows = rows.withColumn("per_word", F.array(*map(found, range(len(COMMON_WORDS[""])))))
    used = F.aggregate("per_word", F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(
        "doc_id",
        "key",
        "language",
        "n_words",
        (F.length("t") - F.col("n_gap")).alias("word_chars"),
        F.col("n_symbol").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        F.array(*per_class, F.col("size")).alias("classes"),
        F.concat("per_word", F.array(F.col("n_words") - used)).alias("commons"),
    )


def references(counted: DataFrame) -> DataFrame:
    """Histograms of each language over all its documents; of all documents for ""."""
    n_classes, n_words = len(CLASSES) + 1, len(COMMON_WORDS[""]) + 1
    sums = [F.sum(F.get("classes", i)).alias(f"c{i}") for i in range(n_classes)]
    sums += [F.sum(F.get("commons", i)).alias(f"w{i}") for i in range(n_words)]
    return counted.groupBy("language").agg(*sums).select(
        "language",
        F.array(*[f"c{i}" for i in range(n_classes)]).alias("ref_classes"),
        F.array(*[f"w{i}" for i in range(n_words)]).alias("ref_commons"),
    )


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms: 0 (equal) to 1 (nothing in common)."""
    zero = F.lit(0.0)

    def shares(h):
        total = F.aggregate(h, zero, lambda s, x: s + x)
        return F.transform(h, lambda x: F.when(total > 0, x / total).otherwise(zero))

    def part(p, q):
        def of(x):
            return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(zero)

        return (of(p) + of(q)) / 2

    return F.sqrt(
        F.greatest(zero, F.aggregate(F.zip_with(shares(a), shares(b), part), zero, lambda s, x: s + x))
    )


def judge_quality(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Counts, distances and the verdict of each row of ``docs``.

    Null text counts as empty and fails for its length; a null or unlisted language, or
    a table without that column, is compared with the pooled words. Repeated rows get
    equal verdicts. Other columns, whatever their names, are not read. ``key`` is
    ``row_key`` of the text. An empty table gives an empty result. Texts of any length are
    counted whole.
    """
    counted = stage(counts(docs, doc_id, text, lang), "quality-counts")
    # One row per entry of COMMON_WORDS: this side can never grow.
    judged = counted.join(F.broadcast(references(counted)), "language")
    long_enough = F.col("n_words") >= JUDGED_WORDS
    judged = judged.withColumns(
        {
            "class_distance": js_distance(F.col("classes"), F.col("ref_classes")),
            "word_distance": js_distance(F.col("commons"), F.col("ref_commons")),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )
    far = (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~(long_enough & far)).alias("kept"),
        "class_distance", "word_distance", "language", "key",
    )


def keep_quality(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that pass; all columns as they were.

    Null text fails for its length. Repeated rows all stay or all go; null ids are kept
    apart by their texts. An empty table gives an empty result.
    """
    return keep_rows(docs, judge_quality(docs).where("NOT kept"))
