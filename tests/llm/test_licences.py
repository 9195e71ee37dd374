import math
import pathlib
import re
import textwrap
import zlib
from collections import Counter

from tests.llm.helpers import awkward, empty
from tidemark.llm import licences, queries
from tidemark.llm.licences import scan_licences

TEXTS = pathlib.Path(licences.__file__).parent / "licence_texts"

FILES = [
    (1, "a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    (2, "a/b/c/x.py", "print(1)"),
    (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
    (4, "a/b/c/y.py", "# Released under the MIT License.\nprint(2)\n" + "word " * 50),
    (5, "z/x.py", "nothing here speaks of terms"),
    (6, "ab/x.py", "a folder whose name begins alike"),
    (7, "a/x.py", "no header"),
    (8, None, "no path"),
    (9, "a/b/odd.md", "the licence plate of a car was read by the man in the street and written down"),
]


def test_headers_files_and_directories(spark):
    table = spark.createDataFrame(FILES, "doc_id int, path string, text string")
    found = {r["doc_id"]: (r["licence"], r["licensed_by"]) for r in scan_licences(table).collect()}
    assert found == {
        1: ("MIT", "file"),
        2: ("Apache-2.0", "a/b"),
        3: ("Apache-2.0", "file"),
        4: ("MIT", "file"),
        5: (None, None),
        6: (None, None),
        7: ("MIT", "a"),
        8: (None, None),
        9: ("Apache-2.0", "a/b"),
    }


def test_awkward_empty_and_no_python(spark):
    table = awkward(spark).selectExpr("*", "concat(source, '/', doc_id) AS place")
    scanned = scan_licences(table, path="place")
    assert scanned.count() == table.count()
    plan = scanned._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert scan_licences(empty(spark), path="source").count() == 0


def test_whole_licence_files_and_identifiers(spark):
    """Unshortened files, with a holder's line, in a table of texts that speak of licences as well."""
    rows = []
    for name, licence in licences.TEXTS.items():
        body = (TEXTS / f"{name}.txt").read_text("utf-8")
        rows.append((f"{name}/LICENSE", "Copyright (c) 2020 Some Body\n\n" + body, licence, "file"))
        rows.append((f"{name}/src/x.py", "print(1)", licence, name))
    for said, licence in [
        ("MIT", "MIT"), ("BSD-3-Clause", "BSD"), ("GPL-3.0-or-later", "GPL"), ("MPL-2.0", "MPL-2.0"),
        ("Apache-2.0", "Apache-2.0"), ("Zlib", "Zlib"), ("MIT OR Apache-2.0", "MIT OR Apache-2.0"),
    ]:
        rows.append((f"ids/{said}.c", f"/* SPDX-License-Identifier: {said} */\nint main;", licence, "file"))
    rows += [(f"odd/{k}.md", f"the licence plate {k} of a car was read by the man", None, None) for k in range(30)]
    table = spark.createDataFrame([(k, p, t) for k, (p, t, *_) in enumerate(rows)], "doc_id int, path string, text string")
    found = {r["path"]: (r["licence"], r["licensed_by"]) for r in licences.scan_licences(table).collect()}
    assert found == {p: (licence, by) for p, _, licence, by in rows}


def passages(text, path):
    """Whole licence files, lines, comment blocks and paragraphs, said in plain Python."""
    found, block = [], []
    mark = re.compile(r"[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+)[ \t]*")
    lines = text.split("\n")
    for line in [*lines, None]:
        hit = mark.match(line) if line is not None else None
        if hit:
            block.append(line[hit.end() :])
            continue
        if block:
            found.append(" ".join(block))
            block = []
    found += lines + re.split(r"\n[ \t]*\n", text)
    found = {" ".join(terms(f)): terms(f) for f in found if re.search(licences.CUES, f) and not re.search(licences.SPDX, f)}
    whole = [terms(text)] if re.search(licences.FILE_NAMES, (path or "").rpartition("/")[2]) else []
    return [*found.values(), *whole]


def terms(text):
    return re.findall("[a-z0-9]+", text.lower())


def plain(files):
    """The family of each file's own licence by TF-IDF vectors in dictionaries."""
    templates = [(family, terms(body)) for family, _, _, body in licences._templates()]
    parts = {k: passages(text or "", path) for k, path, text in files}
    every = [p for ps in parts.values() for p in ps]
    df = Counter(w for p in [*every, *(t for _, t in templates)] for w in set(p))
    n = len(every) + len(templates)

    def vector(words):
        raw = {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(words).items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / length for w, x in raw.items()}

    known, own = [(family, vector(t)) for family, t in templates], {}
    for k, _, text in files:
        said = re.search(licences.SPDX, text or "")
        best = (-licences.LEAST_COSINE, None)
        for p in parts[k]:
            v = vector(p) if p else {}
            for family, t in known:
                best = min(best, (-round(sum(x * t.get(w, 0) for w, x in v.items()), 6), family), key=lambda b: (b[0], b[1] or "~"))
        own[k] = said[1] if said else best[1]
    return own


GNU = [
    ("/*\n * {}\n */\nint main;", "c"),
    ("# {}\n\nimport os\n", "py"),
    ("code();\n// {}\nmore();", "js"),
]


def header_files():
    rows = []
    for k, (family, one, work, name, version) in enumerate(licences.HEADERS):
        text = licences.HEADER.format(work=work, name=name, version=version)
        wrapped = textwrap.wrap(text, 60)
        for shape, ending in GNU:
            joint = {"c": "\n * ", "py": "\n# ", "js": "\n// "}[ending]
            rows.append((f"h{k}/x.{ending}", shape.format(joint.join(wrapped)), family, one))
    return rows


def test_headers_of_all_gnu_licences_keep_name_and_version(spark):
    rows = header_files()
    table = spark.createDataFrame([(k, p, t) for k, (p, t, *_) in enumerate(rows)], "doc_id int, path string, text string")
    found = {r["path"]: (r["licence"], r["licence_id"]) for r in scan_licences(table).collect()}
    assert found == {p: (family, one) for p, _, family, one in rows}


def test_short_licences_and_refusals(spark):
    texts = {one: text for _, one, text in licences.TEMPLATES}
    affero = dict((name, body) for _, _, name, body in licences._templates())["AGPL-3"]
    rows = [
        ("isc/LICENSE", "ISC License\n\nCopyright (c) 2020 Some Body\n\n" + texts["ISC"], "ISC"),
        ("un/UNLICENSE", texts["Unlicense"], "Unlicense"),
        ("a/COPYING", affero, "AGPL"),
        ("no/README", "All rights reserved.\nNo license is granted.\nCopyright 2020 Some Body.", None),
        ("no/x.py", "# SPDX-License-Identifier: AGPL-3.0-only\nx", "AGPL"),
        ("no/y.py", "y", None),
    ]
    table = spark.createDataFrame([(k, p, t) for k, (p, t, _) in enumerate(rows)], "doc_id int, path string, text string")
    found = {r["path"]: r["licence"] for r in scan_licences(table).collect()}
    assert found == {p: licence for p, _, licence in rows}


def test_equals_plain(spark, sf):
    files = [(k, p, t) for k, (p, t, *_) in enumerate(header_files())]
    files += [(100 + k, p, t) for k, p, t in FILES]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    files += [(1000 + r["doc_id"], f"d/{r['doc_id']}.txt", r["text"]) for r in docs]
    files += [(9000 + k, f"l{k}/LICENSE", body) for k, (_, _, _, body) in enumerate(licences._templates())]
    table = spark.createDataFrame(files, "doc_id int, path string, text string")
    found = {r["doc_id"]: r["own_licence"] for r in scan_licences(table).collect()}
    want = plain(files)
    assert {k: (found[k], want[k]) for k in want if found[k] != want[k]} == {}


def test_long_text(spark):
    text = "the licence of a long text is told in the last line\n" * 40_000 + "Released under the MIT License."
    table = spark.createDataFrame([(1, "a/x.txt", text)], "doc_id int, path string, text string")
    assert scan_licences(table).first()["licence"] == "MIT"


def test_query_inherits_within_its_tree(spark, tmp_path):
    """Licence files of the query's tree reach the files below their directory, and no others."""
    notice = "Released under the MIT License."
    rows = [(k, f"text {k}\n{notice}" if k % 3 == 0 else f"text {k} without terms", "ed"[k % 2], "ab"[k // 7 % 2], 1) for k in range(0, 4000, 13)]
    rows += [(None, "no id", None, None, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    place = {k: (source, k // 1000) for k, _, _, source, _ in rows[:-1]}
    named = {k for k in place if zlib.crc32(str(k).encode()) % 16 == 0}
    holders = {place[k] for k in named if k % 3 == 0}
    found = {r["doc_id"]: (r["licence"], r["licensed_by"]) for r in queries.op9_licence_tfidf(spark, str(tmp_path)).collect()}
    want = {k: ("MIT", "file") if k % 3 == 0 else ("MIT", "/".join(map(str, p))) if p in holders else (None, None) for k, p in place.items()}
    assert found == want | {None: (None, None)}
    assert {by for _, by in found.values()} - {"file", None} and (None, None) in [found[k] for k in place]
