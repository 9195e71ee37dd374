"""The registered queries of the operators on texts, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm import (
    dialogues,
    exact,
    licences,
    lm,
    mixing,
    packing,
    quality,
    secrets,
    sentencepiece,
    simhash,
    spelling,
    substring,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op7_extendible_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(_documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _op8_sql() -> str:
    gap = "[\\x20\\x09-\\x0D]+"
    lists = {k: "[" + ", ".join(f"'{w}'" for w in v) + "]" for k, v in quality.COMMON_WORDS.items()}
    listed = " ".join(f"WHEN lang = '{k}' THEN {v}" for k, v in lists.items() if k)
    known = ", ".join(f"'{k}'" for k in lists if k)
    classes = []
    for members in quality.CLASSES.values():
        pattern = members.replace("'", "''").replace('\\"', '"')
        classes.append(f"length(t) - length(regexp_replace(t, '[{pattern}]+', '', 'g'))")
    n_classes, n_words = len(classes) + 1, len(quality.COMMON_WORDS[""]) + 1

    def distance(own: str, ref: str, n: int) -> str:
        total = f"nullif(list_sum({own}), 0)"
        terms = []
        for i in range(1, n + 1):
            p = f"coalesce({own}[{i}] / {total}, 0.0)"
            q = f"coalesce({ref}[{i}] / nullif(list_sum({ref}), 0), 0.0)"
            for x in (p, q):
                terms.append(f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({p} + {q})) ELSE 0 END")
        return f"sqrt(greatest(0.0, ({' + '.join(terms)}) / 2))"

    def sums(column: str, n: int) -> str:
        return "[" + ", ".join(f"sum({column}[{i}])" for i in range(1, n + 1)) + "]"

    return f"""
    WITH base AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
               CASE WHEN lang IN ({known}) THEN lang ELSE '' END AS language,
               list_filter(regexp_split_to_array(coalesce(text, ''), '{gap}'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_replace(x, '{gap}', '', 'g') <> '') AS lines,
               CASE {listed} ELSE {lists['']} END AS listed
        FROM documents),
    parts AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM base),
    windows AS (
        SELECT rid, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
        FROM parts WINDOW o AS (PARTITION BY rid ORDER BY i)),
    repeated AS (
        SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n
                            FROM windows WHERE c IS NOT NULL) WHERE n > 1),
    covered AS (SELECT rid, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) v(d) GROUP BY rid),
    counted AS (
        SELECT base.*, len(w) AS n_words, length(regexp_replace(t, '{gap}', '', 'g')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(covered.n, 0) AS n_repeat_words,
               list_transform(listed, lambda x: len(list_filter(w, lambda y: lower(y) = x))) AS per_word,
               [{', '.join(classes)}] AS per_class
        FROM base LEFT JOIN covered USING (rid)),
    shaped AS (
        SELECT *, list_concat(per_word, [n_words - list_sum(per_word)]) AS commons,
               list_concat(per_class, [length(t) - list_sum(per_class)]) AS classes
        FROM counted),
    refs AS (
        SELECT language, {sums('classes', n_classes)} AS rc, {sums('commons', n_words)} AS rw
        FROM shaped GROUP BY language),
    judged AS (
        SELECT shaped.*, {distance('classes', 'rc', n_classes)} AS dc, {distance('commons', 'rw', n_words)} AS dw,
               n_words < {quality.MIN_WORDS}
               OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
        FROM shaped JOIN refs USING (language))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT (n_words >= {quality.JUDGED_WORDS}
               AND (dc > {quality.MAX_CLASS_DISTANCE} OR dw > {quality.MAX_WORD_DISTANCE})) AS kept
    FROM judged"""


def op5_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_documents(spark, sf_dir))
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return groups.select("doc_id", text.alias("fingerprint"), "component_id")


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = f"""
    WITH sizes AS (
        SELECT doc_id, source, coalesce(text, '') AS t,
               len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS size
        FROM documents),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM sizes GROUP BY source),
    s1 AS (
        SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce((sum(3 * source_size) OVER (
                      ORDER BY 3 * source_size / weight, weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE, 0))
                  / (sum(weight) OVER (ORDER BY 3 * source_size / weight, weight
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM sources),
    targets AS (
        SELECT source, source_size,
               CASE WHEN 3 * source_size <= weight * level THEN (3 * source_size)::DOUBLE
                    ELSE weight * max(CASE WHEN 3 * source_size > weight * level THEN level END) OVER () END AS target
        FROM s1),
    classes AS (
        SELECT s.source, length(bin(size)) AS class, sum(size)::BIGINT AS words, any_value(source_size) AS source_size,
               any_value(target) AS target, floor(any_value(target) / any_value(source_size)) AS whole
        FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size > 0 GROUP BY s.source, length(bin(size))),
    c1 AS (SELECT *, target - whole * source_size AS rest, words * class AS pull FROM classes),
    c2 AS (
        SELECT *, (rest - coalesce((sum(words) OVER (PARTITION BY source ORDER BY words / pull, pull
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE, 0))
                  / (sum(pull) OVER (PARTITION BY source ORDER BY words / pull, pull
                                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM c1),
    c3 AS (
        SELECT *, CASE WHEN words <= pull * level THEN words::DOUBLE
                       ELSE pull * max(CASE WHEN words > pull * level THEN level END) OVER (PARTITION BY source) END
                  / words AS chance
        FROM c2),
    numbered AS (
        SELECT s.*, class, whole, rest, chance,
               (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
                   / 4503599627370496.0::DOUBLE AS u
        FROM sizes s JOIN c3 ON s.source IS NOT DISTINCT FROM c3.source AND length(bin(size)) = class WHERE size > 0),
    oddly AS (SELECT *, (u / (1 - u)) / (chance / (1 - chance)) AS odds FROM numbered),
    ranked AS (
        SELECT *, CASE WHEN chance >= 1 THEN 0.0::DOUBLE WHEN chance > 0 THEN odds / (1 + odds) END AS rank FROM oddly),
    run AS (
        SELECT *, rank IS NOT NULL AND (sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE <= rest AS chosen
        FROM ranked),
    gaps AS (
        SELECT *, rest - coalesce((sum(CASE WHEN chosen THEN size END) OVER (PARTITION BY source))::DOUBLE, 0) AS gap FROM run),
    fit AS (
        SELECT *, row_number() OVER (PARTITION BY source, NOT chosen AND rank IS NOT NULL AND abs(gap - size) < gap
                                     ORDER BY abs(gap - size), rank, doc_id NULLS FIRST) = 1
                  AND NOT chosen AND rank IS NOT NULL AND abs(gap - size) < gap AS extra
        FROM gaps),
    copies AS (SELECT doc_id, source, size, whole + chosen::BIGINT + extra::BIGINT AS n FROM fit
               UNION ALL SELECT doc_id, source, size, 0 FROM sizes WHERE size = 0)
    SELECT doc_id, size::BIGINT AS size, source_size, target, (n * size)::BIGINT AS taken
    FROM copies c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source"""


def op1_logbilinear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32 of the id leaves 1 by 5 are held out; a null id is an empty text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return lm.score_texts(_documents(spark, sf_dir), F.crc32(name.cast("binary")) % 5 == 1)


def op2_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = """
    WITH base AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    parts AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM base),
    windows AS (SELECT doc_id, i, w[i:i + 19] AS run FROM base, unnest(range(1, len(w) - 18)) u(i) WHERE len(w) >= 20),
    later AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM windows)
        WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, i + d AS i FROM later, range(0, 20) r(d)),
    kept AS (
        SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept_text, count(*) AS n_kept
        FROM parts p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
    SELECT b.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept_text, '')) AS kept_sha256
    FROM base b LEFT JOIN kept k ON b.doc_id = k.doc_id"""


def op3_sentencepiece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.encode_digests(_documents(spark, sf_dir), model)


def op6_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = secrets.find_secrets(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *map(number, secrets.KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op9_licence_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree, as the table has no paths: source/thousand of ids/language/id.

    One of sixteen, by crc32 of its id, is named as the licence file of the directory above its
    language's; files without a licence of their own inherit what it says, if it says any.
    """
    docs = _documents(spark, sf_dir)
    part = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("none")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    is_licence = F.crc32(name.cast("binary")) % 16 == 0
    own = F.concat_ws("/", part, F.coalesce("lang", F.lit("none")), name)
    path = F.when(is_licence, F.concat(part, F.lit("/LICENSE-"), name)).otherwise(own)
    return licences.scan_licences(docs.withColumn("path", path))


RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op10_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents serve as labels of the pages with their ids: no others are given."""
    from tidemark.session import few_rows

    rules = few_rows(spark, RULES, T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")]))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy(F.col("doc_id").alias("page_id"))
    labels = labels.agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    judged = urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules, labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


#: The table of crc32, one row with a list of 256 numbers.
CRC_TABLE = """crc_table AS (
        SELECT list(c ORDER BY k) AS crcs FROM (
            SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, b:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) t(k)))"""


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text, where ``crcs`` of CRC_TABLE is in reach."""
    digits = f"list_transform(range(1, strlen({text}) * 2, 2), lambda i: ('0x' || substr(hex({text}), i, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {digits}), {step}), 4294967295)"


def op11_trie_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(_documents(spark, sf_dir))


OP11_SQL = f"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
               translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents),
    hashed AS (
        SELECT run, c, {_crc32("doc_id || ':' || run")} AS code
        FROM (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL), crc_table),
    words AS (
        SELECT CASE WHEN code % {spelling.DAMAGE} = 0
                    THEN substr(run, 1, code % length(run)) || substr(run, code % length(run) + 2) ELSE run END AS word,
               sum(c)::BIGINT AS n
        FROM hashed GROUP BY 1
        HAVING length(word) >= {spelling.LEAST_LENGTH} AND n >= {spelling.LEAST_COUNT}),
    less AS (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    pairs AS (
        SELECT a.word, b.word AS near FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
    ranked AS (
        SELECT p.word, near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
               row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, near) AS place
        FROM pairs p JOIN words b ON p.near = b.word),
    judged AS (
        SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.FORM_FACTOR} * n THEN near END AS form,
               CASE WHEN near_n >= {spelling.FORM_FACTOR} * n THEN near_n END AS form_n
        FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1),
    roots AS (
        SELECT word, word AS root, form AS next FROM judged
        UNION ALL SELECT r.word, j.word, j.form FROM roots r JOIN judged j ON r.next = j.word)
    SELECT j.word, form, root, n, n_near, form_n
    FROM judged j JOIN roots r ON j.word = r.word AND r.next IS NULL"""


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = packing.pack(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return dialogues.repair(dialogues.damage(conversations), conversations)


def _op13_sql() -> str:
    gap = "\\x20\\x09-\\x0D"
    costs = {"D": dialogues.DELETE, "I": dialogues.INSERT, "K": 0, "R": dialogues.REROLE}

    def after(state: str, letter: str, line: str | None = None, when: str | None = None) -> str:
        """A state's cost, edits and lines after one more edit."""
        extra = f" + CASE WHEN fault = {dialogues.TRUNCATED} THEN {dialogues.CUT_SHORT} ELSE 0 END" if letter in "KR" else ""
        lines = f"{state}.r" if line is None else f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || {line}"
        made = f"{{'c': {state}.c + {costs[letter]}{extra}, 'a': {state}.a || '{letter}', 'r': {lines}}}"
        return made if when is None else f"CASE WHEN {when} THEN {made} ELSE {far} END"

    far = "{'c': 1000000000000, 'a': 'Z', 'r': ''}"

    def least(*states: str) -> str:
        return f"list_sort([{', '.join(states)}])[1]"

    def keep(state: str, initial: str) -> str:
        return after(state, "K", "role || ':' || text", f"fault <> {dialogues.UNFIT} AND left(role, 1) = '{initial}'")

    def rerole(state: str, role: str) -> str:
        return after(state, "R", f"'{role}:' || text", f"fault <> {dialogues.UNFIT}")

    closed_2 = least("x2", *(after(s, "I", "'user:'") for s in ("x0", "x1", "x3")))
    return f"""
    WITH RECURSIVE {CRC_TABLE},
    coded AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS code
        FROM conversations, crc_table),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM coded WHERE code <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
    faulted AS (
        SELECT *, NOT regexp_matches(text, '[^{gap}]') AS blank,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS late,
               NOT regexp_matches(text, '[.!?][{gap}]*\\z') AS cut_short,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
        FROM numbered),
    turns AS (
        SELECT *, CASE WHEN blank OR late THEN {dialogues.UNFIT} WHEN cut_short THEN {dialogues.TRUNCATED}
                       ELSE {dialogues.FINE} END AS fault
        FROM faulted),
    told AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (late AND NOT blank) AS duplicate,
               count(*) FILTER (fault = {dialogues.TRUNCATED}) AS truncated,
               count(*) FILTER (earlier || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id),
    walk(conv_id, i, n, s0, s1, s2, s3) AS (
        SELECT conv_id, 0::BIGINT, n, {{'c': 0::BIGINT, 'a': '', 'r': ''}}, {far}::STRUCT(c BIGINT, a VARCHAR, r VARCHAR),
               {{'c': 5::BIGINT, 'a': 'I', 'r': 'user:'}}, {{'c': 10::BIGINT, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}}
        FROM told
        UNION ALL
        SELECT conv_id, i, n, x0, x1, y2, {least("x3", after("y2", "I", "'assistant:'"))} FROM (
            SELECT *, {closed_2} AS y2 FROM (
                SELECT w.conv_id, t.i, n, {after("s0", "D")} AS x0, {least(after("s1", "D"), keep("s0", "s"))} AS x1,
                       {least(after("s2", "D"), *(keep(s, "u") for s in ("s0", "s1", "s3")), *(rerole(s, "user") for s in ("s0", "s1", "s3")))} AS x2,
                       {least(after("s3", "D"), keep("s2", "a"), rerole("s2", "assistant"))} AS x3
                FROM walk w JOIN turns t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1))),
    ended AS (SELECT conv_id, {least("s0", "s3")} AS s FROM walk WHERE i = n)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s.c, 0)::BIGINT AS cost,
           coalesce(s.a, '') AS audit, sha256(coalesce(s.r, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN told t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
    LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def checks() -> dict[str, tuple[Query, str | None]]:
    """Name to query and SQL; None where SQL can't express it."""
    return {
        "pipeline": (pipeline, None),
        "op1_logbilinear_score": (op1_logbilinear_score, None),
        "op2_countmin_substrings": (op2_countmin_substrings, OP2_SQL),
        "op3_sentencepiece_table": (op3_sentencepiece_table, None),
        "op4_pareto_mix": (op4_pareto_mix, OP4_SQL),
        "op5_simhash_anchors": (op5_simhash_anchors, None),
        "op6_token_efficiency": (op6_token_efficiency, None),
        "op7_extendible_dedup": (op7_extendible_dedup, OP7_SQL),
        "op8_quality_divergence": (op8_quality_divergence, _op8_sql()),
        "op9_licence_tfidf": (op9_licence_tfidf, None),
        "op10_template_tree": (op10_template_tree, None),
        "op11_trie_spelling": (op11_trie_spelling, OP11_SQL),
        "op12_best_two_fit": (op12_best_two_fit, None),
        "op13_checkpointed_repair": (op13_checkpointed_repair, _op13_sql()),
    }
