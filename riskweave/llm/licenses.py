"""Licences of files: statements matched to templates, licence files inherited along directories.

Only DataFrame functions are used. Statements are the lines that hold a licence word, their sentences, SPDX
identifiers, and two or three joined lines and the sentences across them; a statement is compared with the templates by the cosine of sparse TF-IDF vectors over the templates' words, where a
word outside the templates adds to the length of the statement's vector alone. Files without a
statement inherit the licence file of the nearest directory above them, resolved once per directory.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import staged

#: Licences and the statements by which files name them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain under the Unlicense."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("ISC", "ISC License"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "Licensed under the Eclipse Public License 2.0."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
]
_NAMED = list(dict.fromkeys(licence for licence, _ in TEMPLATES))
TEMPLATES += [(licence, f"SPDX-License-Identifier: {licence}") for licence in _NAMED]
TEMPLATES += [(licence, f"SPDX-License-Identifier: {licence}-{end}") for licence in _NAMED if "GPL" in licence for end in ("only", "or-later")]
#: A line with one of these is a statement to compare.
STATEMENT = r"(?i)licen[sc]e|unlicense|permission is hereby granted|permission to use|redistribution and use|endorse or promote|copy of the MPL|authors be held liable|mozilla public|spdx"
WORD = r"[a-z0-9]+"
#: Ends of sentences, beginnings of the part of a sentence that names the licence, and SPDX identifiers.
SENTENCE_END = r"(?<=[.!?;:])\s+|\s+[-\u2013\u2014]+\s+"
NAMING = r"(?is)\b(?:licensed|released|distributed) under\b.*"
SPDX = r"(?i)SPDX-License-Identifier:\s*[\w.+-]+"
#: Most words of a statement that is no line of its own: over twice the longest template.
STATEMENT_WORDS = 60
#: Least cosine of a match.
THRESHOLD = 0.75
#: A file of at most so many words that consists of a statement is a licence file of its directory.
NOTICE_WORDS = 40
#: Names of licence files.
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense|notice)(\.[a-z]+)?$"


def _template_words() -> list[tuple[int, str, str, int]]:
    """(template, licence, word, times)"""
    out = []
    for k, (licence, text) in enumerate(TEMPLATES):
        words = re.findall(WORD, text.lower())
        out += [(k, licence, w, words.count(w)) for w in sorted(set(words))]
    return out


def template_weights() -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """Unit-length template vectors, the weight of each word, and that of a word in no template."""
    rows, n = _template_words(), len(TEMPLATES)
    held: dict[str, int] = {}
    for _, _, w, _ in rows:
        held[w] = held.get(w, 0) + 1
    idf = {w: math.log((n + 1) / (k + 1)) + 1 for w, k in held.items()}
    length: dict[int, float] = {}
    for k, _, w, times in rows:
        length[k] = length.get(k, 0.0) + (times * idf[w]) ** 2
    return [(k, lic, w, t * idf[w] / math.sqrt(length[k])) for k, lic, w, t in rows], idf, math.log(n + 1) + 1


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _parts(start: Column) -> Column:
    """Statements that begin in the first of up to three lines: sentences, SPDX identifiers, joined lines."""
    lines = F.split(start, "\n")
    second = F.concat_ws("\n", F.get(lines, F.lit(0)), F.get(lines, F.lit(1)))

    def sentences(text: Column) -> Column:
        cut = F.split(text, SENTENCE_END)
        return F.concat(cut, F.transform(cut, lambda x: F.regexp_extract(x, NAMING, 0)))

    # what does not cross lines is found at its own line
    joined = F.array(second, start)
    across = F.concat(joined, F.flatten(F.transform(joined, sentences)))
    first = F.get(lines, F.lit(0))
    spdx = F.regexp_extract_all(first, F.lit(SPDX), F.lit(0))
    parts = F.concat(sentences(first), spdx, F.filter(across, lambda x: F.contains(x, F.lit("\n"))))
    return F.array_distinct(F.filter(parts, lambda x: x.rlike(STATEMENT) & (F.size(_words(x)) <= STATEMENT_WORDS)))


def statements(files: DataFrame) -> DataFrame:
    """Lines with a licence word, their parts and joins, and whole short files that have one:
    (path, line, text, whole_file).

    ``files`` has (path, text). Whole texts are searched; blank lines do not separate a statement.
    """
    lines = F.split(F.col("text"), r"\r\n|\r|\n")
    held = files.where(F.col("text").rlike(STATEMENT))
    by_line = held.select("path", F.posexplode(lines).alias("line", "statement")).where(F.col("statement").rlike(STATEMENT))
    filled = held.select("path", F.filter(lines, lambda x: x.rlike(r"[A-Za-z0-9]")).alias("lines"))
    starts = F.transform("lines", lambda x, i: F.concat_ws("\n", x, F.get("lines", i + 1), F.get("lines", i + 2)))
    parts = filled.select("path", F.posexplode(starts).alias("line", "start")).where(F.col("start").rlike(STATEMENT)).select(
        "path", "line", F.explode(_parts(F.col("start"))).alias("statement"))
    whole = held.where(F.size(_words(F.col("text"))) <= NOTICE_WORDS)
    return by_line.unionAll(parts).select("path", "line", "statement", F.lit(False).alias("whole_file")).unionAll(
        whole.select("path", F.lit(-1).alias("line"), F.col("text").alias("statement"), F.lit(True).alias("whole_file")))


def matched(lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Best template per distinct statement: (statement, license, cosine) with cosine of at least ``threshold``.

    Equal statements are compared once, however many files hold them. Ties go to the first template.
    """
    spark = lines.sparkSession
    vectors, idf, other = template_weights()
    templates = F.broadcast(spark.createDataFrame(vectors, "template int, license string, t_word string, unit double"))
    weights = F.broadcast(spark.createDataFrame(list(idf.items()), "w_word string, idf double"))
    distinct = lines.select("statement").distinct()
    counts = (
        distinct.select("statement", F.explode(_words(F.col("statement"))).alias("word"))
        .groupBy("statement", "word").agg(F.count("*").alias("times"))
    )
    weighed = counts.join(weights, F.col("word") == F.col("w_word"), "left").select(
        "statement", "word", (F.col("times") * F.coalesce("idf", F.lit(other))).alias("weight"))
    length = weighed.groupBy(F.col("statement").alias("l_statement")).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    dots = weighed.join(templates, F.col("word") == F.col("t_word")).groupBy("statement", "template", "license").agg(
        F.sum(F.col("weight") * F.col("unit")).alias("dot"))
    scored = dots.join(length, F.col("statement") == F.col("l_statement")).select(
        "statement", "template", "license", F.round(F.col("dot") / F.col("length"), 6).alias("cosine"))
    best = scored.where(F.col("cosine") >= threshold).groupBy("statement").agg(
        F.max(F.struct("cosine", (-F.col("template")).alias("minus"), "license")).alias("best"))
    return best.select(F.col("statement").alias("m_statement"), "best.license", "best.cosine")


def directory(path: Column) -> Column:
    """Path without its last part; the top directory is the empty string."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def inherited(directories: DataFrame, licence_files: DataFrame) -> DataFrame:
    """Licence of the nearest directory at or above each directory: (dir, dir_license, dir_cosine).

    ``licence_files`` has (path, license, cosine); of several in a directory the best match counts, then
    the first path. A directory is joined to each of its ancestors, as many rows as it is deep.
    """
    own = licence_files.withColumn("l_dir", directory(F.col("path"))).groupBy("l_dir").agg(
        F.min(F.struct((-F.col("cosine")).alias("minus"), "path", "license")).alias("best"))
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    above = directories.select("dir", F.explode(F.sequence(F.lit(0), depth)).alias("level")).select(
        "dir", "level", F.array_join(F.slice(F.split("dir", "/"), 1, F.col("level")), "/").alias("ancestor"))
    return above.join(own, F.col("ancestor") == F.col("l_dir")).groupBy("dir").agg(
        F.max(F.struct("level", "best")).alias("nearest")).select(
        F.col("dir").alias("i_dir"), F.col("nearest.best.license").alias("dir_license"),
        (-F.col("nearest.best.minus")).alias("dir_cosine"))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Licence per file: (path, license, cosine, found), found is header, file, inherited or none.

    ``files`` has (path, text). A file's own best statement counts first (highest cosine, then the first
    line); a file named as a licence or consisting of a statement covers its directory and those below.
    Null texts have no statement; a null path lies in the top directory; repeated rows of a path are
    scanned as one file. Of equally good licence files of a directory the first path covers it. A line is compared
    whole however long it is, its parts as far as they have at most ``STATEMENT_WORDS`` words.
    """
    named = files.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    lines = staged(statements(named), "licence-lines")
    hits = staged(
        lines.join(matched(lines, threshold), F.col("statement") == F.col("m_statement"))
        .withColumn("whole_file", F.col("whole_file") | F.col("path").rlike(LICENCE_FILE))
        .groupBy("path").agg(
            F.min(F.struct((-F.col("cosine")).alias("minus"), "line", "license")).alias("best"), F.max("whole_file").alias("is_file"))
        .select("path", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("cosine"), "is_file"),
        "licence-hits")
    paths = named.select("path").distinct()
    dirs = paths.select(directory(F.col("path")).alias("dir")).distinct()
    up = inherited(dirs, hits.where("is_file").select("path", "license", "cosine"))
    found = paths.join(hits.withColumnRenamed("path", "h_path"), F.col("path") == F.col("h_path"), "left").join(
        up, directory(F.col("path")) == F.col("i_dir"), "left")
    return found.select(
        "path", F.coalesce("license", "dir_license").alias("license"), F.coalesce("cosine", "dir_cosine").alias("cosine"),
        F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header")
        .when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("found"))


def documents_as_files(documents: DataFrame) -> DataFrame:
    """Documents laid out as files: source/language/id, with unknown parts named none.

    Documents without id are told apart by their text.
    """
    part = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), "/", "_"), F.lit("none")) for c in ("source", "lang")]
    unnamed = F.concat(F.lit("none-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    part.append(F.coalesce(F.col("doc_id").cast("string"), unnamed))
    return documents.select(F.col("doc_id"), F.concat_ws("/", *part).alias("path"), F.col("text"))


def scan_documents(documents: DataFrame) -> DataFrame:
    """Licence of every document, repeated rows included: (doc_id, path, license, cosine, found)."""
    files = documents_as_files(documents)
    found = scan(files).withColumnRenamed("path", "f_path")
    return files.select("doc_id", "path").join(found, F.col("path") == F.col("f_path")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "path", "license", "cosine", "found")
