"""Licences of files: TF-IDF cosine of passages to templates, then directories.

The passages of a text are its lines, its comment blocks with the marks taken off, and its
paragraphs, those that speak of a licence; a file named as a licence file is one passage
more as a whole. Passages and templates are sparse vectors of term frequency times inverse
document frequency, the latter counted over all passages and templates. A file has the
licence of its most similar passage, if that is similar enough; an SPDX identifier says it
outright. A file without one inherits from the nearest directory above it that holds a file
named as a licence file. A licence is given by its family and, where the text tells it, by
its identifier with version. Only DataFrame functions run here.
"""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import whole_text
from tidemark.session import broadcast_if_small, few_rows, stage

# Notices and openings of public licences, by family and identifier.
TEMPLATES = (
    ("Apache-2.0", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache-2.0", "You may not use this file except in compliance with the License."),
    ("BSD", "BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD", "0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES."),
    ("CC-BY", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution License, CC BY 4.0."),
    ("CC-BY-NC", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial License."),
    ("GPL", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "GPL", "This program is free software: you can redistribute it under the terms of the GNU General Public License."),
    ("ISC", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "MIT", "Released under the MIT License."),
    ("MIT", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "Zlib", "This software is provided as-is, without any express or implied warranty. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
)
#: The file header of the GNU licences, which differs in names and version alone.
HEADER = (
    "This {work} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
    "as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version. "
    "This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
HEADERS = (
    ("GPL", "GPL-2.0", "program", "General Public License", "2"),
    ("GPL", "GPL-3.0", "program", "General Public License", "3"),
    ("LGPL", "LGPL-2.1", "library", "Lesser General Public License", "2.1"),
    ("LGPL", "LGPL-3.0", "library", "Lesser General Public License", "3"),
    ("AGPL", "AGPL-3.0", "program", "Affero General Public License", "3"),
)
#: The whole text of the Affero licence is that of the GPL but for its name and this clause.
AFFERO = (
    ("General Public License", "Affero General Public License"),
    ("GENERAL PUBLIC LICENSE", "AFFERO GENERAL PUBLIC LICENSE"),
    ("13. Use with the GNU Affero Affero General Public License.", "13. Remote Network Interaction; Use with the GNU General Public License."),
)
#: Whole texts of public licences, by file: family and identifier.
IDS = {
    "Apache-2.0": ("Apache-2.0", "Apache-2.0"), "BSD-3-Clause": ("BSD", "BSD-3-Clause"), "CC0-1.0": ("CC0-1.0", "CC0-1.0"),
    "GPL-2": ("GPL", "GPL-2.0"), "GPL-3": ("GPL", "GPL-3.0"), "LGPL-2.1": ("LGPL", "LGPL-2.1"), "LGPL-3": ("LGPL", "LGPL-3.0"),
    "MIT": ("MIT", "MIT"), "MPL-2.0": ("MPL-2.0", "MPL-2.0"),
}
TEXTS = {name: family for name, (family, _) in IDS.items()}
_ID = r"[A-Za-z0-9.+-]*[A-Za-z0-9+]"
#: An identifier line; identifiers of one family have the family's name.
SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*(\(?{_ID}(?:[ \t)(]+(?:OR|AND|WITH)[ \t(]+{_ID})*\)?)"
FAMILIES = (("AGPL", r"^AGPL-[0-9.]+(\+|-only|-or-later)?$"), ("GPL", r"^GPL-[0-9.]+(\+|-only|-or-later)?$"), ("LGPL", r"^LGPL-[0-9.]+(\+|-only|-or-later)?$"), ("BSD", r"^BSD-[0-9]-Clause$"), ("CC-BY-NC", r"^CC-BY-NC-[0-9.]+$"), ("CC-BY", r"^CC-BY-[0-9.]+$"))
#: Marks at the start of a line of a comment, and what such lines are joined by.
_MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+)[ \t]*"
_COMMENT, _CODE = "\u0002", "\u0003"
CUES = r"(?i)licen[cs]e|copyright|spdx|redistribut|permission is hereby|creative commons|public domain"
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"
LEAST_COSINE = 0.5


def _terms(text):
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda x: x != "")


def _templates() -> list[tuple[str, str, str, str]]:
    """(family, identifier, name, text) of all templates."""
    folder = pathlib.Path(__file__).parent / "licence_texts"
    whole = [(*ids, name, (folder / f"{name}.txt").read_text("utf-8")) for name, ids in IDS.items()]
    affero = (folder / "GPL-3.txt").read_text("utf-8")
    for old, new in AFFERO:
        affero = affero.replace(old, new)
    headers = [HEADER.format(work=work, name=name, version=version) for _, _, work, name, version in HEADERS]
    return [
        *[(family, one, text, text) for family, one, text in TEMPLATES],
        *[(family, one, f"{one} header", text) for (family, one, *_), text in zip(HEADERS, headers)],
        *whole,
        ("AGPL", "AGPL-3.0", "AGPL-3", affero),
    ]


def _identifier(body):
    """What a text's first identifier line says, or null."""
    said = F.regexp_extract(body, SPDX, 1)
    return F.when(said != "", said)


def _family(said):
    return F.coalesce(*[F.when(F.rlike(said, F.lit(pattern)), F.lit(name)) for name, pattern in FAMILIES], said)


def _passages(body):
    """Lines, comment blocks and paragraphs that speak of a licence, each one once."""
    marked = F.regexp_replace(body, _MARKS, _COMMENT)
    # A line of code ends a block, so does what comes before a line of code.
    ended = F.regexp_replace(marked, f"(?m)^([^{_COMMENT}\n][^\n]*)$", f"$1{_CODE}")
    blocks = F.split(ended, f"{_CODE}\n|\n(?!{_COMMENT})")
    blocks = F.transform(blocks, lambda x: F.trim(F.translate(x, f"{_COMMENT}{_CODE}\n", "  ")))
    every = F.concat(F.split(body, "\n"), blocks, F.split(body, "\n[ \t]*\n"))
    return F.array_distinct(F.filter(every, lambda x: F.rlike(x, F.lit(CUES)) & ~F.rlike(x, F.lit(SPDX))))


def scan_licences(files: DataFrame, file_id: str = "doc_id", path: str = "path", text: str = "text") -> DataFrame:
    """(doc_id, path, own_licence, own_id, own_score, licence, licence_id, licensed_by), one row per row of ``files``.

    ``licensed_by`` is "file" for a licence of the file's own, the directory it is inherited
    from, or null without a licence. Null text counts as empty, a null path lies in no
    directory. Ties between templates go to the first name; between licence files of one
    directory to the higher cosine, then the first name. Repeated rows are files of their
    own. Texts of any length are read whole. An empty table gives an empty result; other
    columns, whatever their names, are not read.
    """
    spark = files.sparkSession
    body = whole_text(text)
    has_cue = F.rlike(body, F.lit(CUES))
    name = F.element_at(F.split(F.coalesce(F.col(path).cast("string"), F.lit("")), "/"), -1)
    named = F.rlike(name, F.lit(FILE_NAMES))
    nothing = F.array().cast("array<string>")
    rows = files.select(
        F.col(file_id).alias("doc_id"), F.col(path).cast("string").alias("path"), named.alias("is_file"),
        F.concat(F.when(named, F.array(body)).otherwise(nothing), F.when(has_cue, _passages(body)).otherwise(nothing)).alias("passages"),
        F.when(has_cue, _identifier(body)).alias("said"), F.monotonically_increasing_id().alias("rid"),
    )
    rows = stage(rows.select("rid", "doc_id", "path", "is_file", "passages", "said"), "licence-rows")
    columns = [T.StructField(n, T.StringType()) for n in ("licence", "id", "t", "body")]
    templates = _templates()
    texts = few_rows(spark, templates, T.StructType(columns))
    passages = rows.select("rid", F.posexplode("passages").alias("part", "t"))
    terms = passages.select("rid", "part", F.explode(_terms(F.col("t"))).alias("term"))
    terms = stage(terms.groupBy("rid", "part", "term").agg(F.count(F.lit(1)).alias("tf")), "licence-terms")
    known = texts.select("licence", "id", "t", F.explode(_terms(F.col("body"))).alias("term"))
    known = known.groupBy("licence", "id", "t", "term").agg(F.count(F.lit(1)).alias("tf"))
    spread = terms.select("term").unionAll(known.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = terms.select("rid", "part").distinct().count() + len(templates)
    idf = spread.select("term", (F.log((F.lit(1.0) + n) / (1 + F.col("df"))) + 1).alias("idf"))
    # Templates are fixed: a few thousand terms.
    weights = known.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    lengths = weights.groupBy("licence", "id", "t").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    weights = stage(weights.join(lengths, ["licence", "id", "t"]).select("licence", "id", "t", "term", (F.col("w") / F.col("length")).alias("tw")), "licence-templates")
    weighed = terms.join(idf, "term").select("rid", "part", "term", (F.col("tf") * F.col("idf")).alias("w"))
    weighed = stage(weighed, "licence-weights")
    norms = weighed.groupBy("rid", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(weights), "term").groupBy("rid", "part", "licence", "id", "t").agg(
        F.sum(F.col("w") * F.col("tw")).alias("dot")
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6).alias("cosine")
    best = dots.join(norms, ["rid", "part"]).select("rid", "licence", "id", cosine).where(F.col("cosine") >= LEAST_COSINE)
    own = best.groupBy("rid").agg(F.min(F.struct((-F.col("cosine")).alias("far"), "licence", "id")).alias("own"))
    found = rows.drop("passages").join(own, "rid", "left")
    found = found.select(
        "doc_id", "path", "is_file", F.coalesce(_family(F.col("said")), "own.licence").alias("own_licence"),
        F.coalesce("said", "own.id").alias("own_id"), F.when(F.col("said").isNotNull(), 1.0).otherwise(-F.col("own.far")).alias("own_score"),
    )
    return _inherit(stage(found, "licence-own"))


def _inherit(found: DataFrame) -> DataFrame:
    """Adds ``licence`` and ``licensed_by`` from the nearest directory with a licence file."""
    folder = F.regexp_extract("path", "^(.*)/", 1)
    holders = found.where("is_file AND own_licence IS NOT NULL AND path IS NOT NULL")
    holders = holders.groupBy(folder.alias("dir")).agg(
        F.min(F.struct((-F.col("own_score")).alias("far"), "own_licence", "own_id")).alias("says")
    )
    needing = found.where("own_licence IS NULL AND path IS NOT NULL").select(folder.alias("of")).distinct()
    parts = F.split("of", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("deep"), F.array_join(F.slice(parts, 1, i), "/").alias("dir"))
    )
    ways = needing.select("of", F.explode(F.array_distinct(above)).alias("way")).select("of", "way.*")
    near = ways.join(holders, "dir").groupBy("of").agg(
        F.max_by(F.struct(F.col("says.own_licence").alias("licence"), F.col("says.own_id").alias("id"), "dir"), "deep").alias("near")
    )
    near = broadcast_if_small(stage(near, "licence-folders"), 20_000)
    joined = found.withColumn("folder", F.when(F.col("own_licence").isNull(), folder)).join(
        near, F.col("folder") == F.col("of"), "left"
    )
    own = F.col("own_licence").isNotNull()
    return joined.select(
        "doc_id", "path", "own_licence", "own_id", "own_score",
        F.coalesce("own_licence", "near.licence").alias("licence"),
        F.when(own, F.col("own_id")).otherwise(F.col("near.id")).alias("licence_id"),
        F.when(own, F.lit("file")).otherwise(F.col("near.dir")).alias("licensed_by"),
    )
