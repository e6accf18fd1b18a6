"""License scans: sparse TF-IDF cosine to templates, then inheritance.

A segment (a line's sentence) of a document that holds a cue word ("license",
"copyright", ...) is a candidate header.  Equal segments of the whole corpus
are one row, counted; each is a sparse TF-IDF vector over its words, with
document frequencies counted over all candidate segments and the templates.
Its licence is the template sentence with the largest cosine, if that reaches
``threshold``.

What spans lines is compared too: the whole text of a document with a cue,
its comment blocks, its paragraphs and their sentences (``passages``) against
the licences' full texts and file headers (``license_texts``), those of more
than one line also against the template sentences.  Here document frequencies
are counted over these fixed texts alone, so a score does not depend on how
many documents carry the same licence.  A document's own licence is that of
its whole text where that is like a full text, else of its best segment or
passage.

A licence file (named like LICENSE or COPYING, made of licence segments for at
least half of its words, or with a whole text that reaches ``threshold``)
licenses its directory.  A document without a
licence of its own inherits from the nearest ancestor directory that has one,
by a join of the distinct directories' ancestor paths with the licensed
directories.

All steps are DataFrame operations: regular expressions, explode, partial
aggregations and joins.  Texts are read once and not shuffled; only texts
with a cue are split, written and counted by words.  The templates are small
fixed tables (their size does not depend on the data), the only broadcasts
that are asked for.

Defined cases: null and empty texts have no segments; null paths lie in no
directory (no inheritance, but a licence of their own counts); repeated ids
and rows are judged row by row; equal cosines go to the licence first in
order of its name; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import cut, table, written

# SPDX names and sentences of the licences' usual notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal license."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright, all rights reserved."),
)
CUE = r"(?i)licen[sc]e|copyright|redistribut|permission is hereby|public domain|\bCC[ -]?(?:BY|0)\b|SPDX"
SENTENCE = r"\n|(?<=[.!?;])[\x20\t]+(?=[A-Z])"
WORDS = r"[a-z0-9]+(?:[.][0-9]+)*"
FILE_NAME = r"(?i)(?:^|/)(?:licen[sc]e|copying|notice)(?:[.-][^/]*)?$"
#: Marks around a block comment, and a run of lines that all begin as comments.
BLOCK_MARK = r"/\*|\*/|<!--|-->|\"{3}|'{3}"
COMMENT_RUN = r"(?md)(?:^[\x20\t]*(?:/[/*]|\*|#|--|;|%)[^\n]*+(?:\n|\z))++"
#: Between paragraphs: a line without a letter or digit.
BLANK = r"\n[^\p{L}\p{N}\n]*(?=\n)"
WRAPPED = r"(?<=[.!?;])\s+(?=[A-Z])"


def word_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word, tf) of the lower-cased words of ``text``."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORDS), F.lit(0)))
    return df.select(key, word.alias("word")).groupBy(key, "word").agg(F.count("*").alias("tf"))


def segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """(rid, id, path, words, notes, text): one row a document; ``notes`` are
    its segments with a cue, lower-cased and with white space runs as one
    space; the text is kept where it has a cue."""
    text = F.col(text_col)
    parts = F.filter(F.split(text, SENTENCE), lambda s: F.rlike(s, F.lit(CUE)))
    notes = F.transform(parts, lambda s: F.trim(F.regexp_replace(F.lower(s), r"\s+", " ")))
    has = F.coalesce(F.rlike(text, F.lit(CUE)), F.lit(False))
    words = F.when(has, F.size(F.split(F.trim(text), r"\s+")))
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(path_col).alias("path"), words.alias("words"),
                       F.when(has, notes).otherwise(F.array().cast("array<string>")).alias("notes"), F.when(has, text).alias("text"))


def passages(text: Column) -> Column:
    """The distinct parts of a text that may be a header: the text itself
    (always the first), its comment blocks, the paragraphs of all these and
    their sentences; without a cue they are left out."""
    wholes = F.concat(F.array(text), F.split(text, BLOCK_MARK), F.regexp_extract_all(text, F.lit(COMMENT_RUN), F.lit(0)))
    parts = F.flatten(F.transform(F.filter(F.array_distinct(wholes), lambda s: F.rlike(s, F.lit(CUE))), lambda s: F.concat(F.array(s), F.split(s, BLANK))))
    some = F.array_distinct(F.filter(parts, lambda s: F.rlike(s, F.lit(CUE))))
    sentences = F.filter(F.flatten(F.transform(some, lambda s: F.split(s, WRAPPED))), lambda s: F.contains(F.trim(s), F.lit("\n")) & F.rlike(s, F.lit(CUE)))
    return F.array_distinct(F.concat(some, sentences))


def full_texts() -> list[tuple[str, str, bool]]:
    """(license, text, whether it is a header) of the fixed full texts and file headers."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [(re.sub(r"(?:\.header.*)?\.txt$", "", f.name), f.read_text(encoding="utf-8"), ".header" in f.name) for f in files]


def passage_licenses(rows: DataFrame, threshold: float, templates=TEMPLATES) -> DataFrame:
    """``rows``: (rid, text).  (rid, license, score, whole, full) of the
    passages whose best cosine reaches ``threshold``; ``whole``: the passage is
    the whole text, ``full``: it is that and like a licence's full text."""
    full = full_texts()
    known = [*((name, text) for name, text, _ in full), *templates]
    n, few, header = len(known), len(full), [h for _, _, h in full]
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t).alias("sentence")) for i, (_, t) in enumerate(known)])).alias("t")
    counts = cut(word_counts(rows.sparkSession.range(1).select(listed).select("t.*"), "template", "sentence"))
    of_word = counts.groupBy("word").agg(F.count("*").alias("df"), F.map_from_entries(F.collect_list(F.struct("template", "tf"))).alias("tfs"))
    rare = F.log(F.lit(1.0 + n)) + 1.0  # of a word of no template
    idf = F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + 1.0
    weight = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.col("tfs")[i], F.lit(0)) * F.col("idf"))
    vocabulary = cut(of_word.withColumn("idf", idf).select("word", "idf", weight.alias("v")))
    norms = vocabulary.agg(*[F.sqrt(F.sum(F.col("v")[i] * F.col("v")[i])).alias(f"norm{i}") for i in range(n)]).collect()[0]  # one row of the fixed templates

    each = rows.where("text IS NOT NULL").select("rid", F.posexplode(passages(F.col("text"))).alias("n", "passage"))
    word = F.explode(F.regexp_extract_all(F.lower("passage"), F.lit(WORDS), F.lit(0)))
    lines = F.contains(F.trim("passage"), F.lit("\n"))
    tf = each.select("rid", "n", lines.alias("wrapped"), word.alias("word")).groupBy("rid", "n", "wrapped", "word").agg(F.count("*").alias("tf"))
    w = F.col("tf") * F.coalesce("idf", rare)
    met = tf.join(F.broadcast(vocabulary), "word", "left").select("rid", "n", "wrapped", w.alias("w"), "v")
    dots = met.groupBy("rid", "n", "wrapped").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *[F.coalesce(F.sum(F.col("w") * F.col("v")[i]), F.lit(0.0)).alias(f"dot{i}") for i in range(n)])
    scores = [F.struct((-F.round(F.col(f"dot{i}") / (F.col("norm") * F.lit(norms[i])), 6)).alias("less"), F.lit(name).alias("license"), F.lit(i < few and not header[i]).alias("full")) for i, (name, _) in enumerate(known)]
    # a passage of one line meets the template sentences as a segment
    best = F.when(F.col("wrapped"), F.array_min(F.array(*scores))).otherwise(F.array_min(F.array(*scores[:few])))
    found = dots.select("rid", "n", best.alias("b")).where(-F.col("b.less") >= threshold)
    return found.select("rid", F.col("b.license").alias("license"), (-F.col("b.less")).alias("score"), (F.col("n") == 0).alias("whole"), (F.col("b.full") & (F.col("n") == 0)).alias("full"))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    rows = ", ".join("({}, '{}', '{}')".format(i, n.replace("'", "''"), t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, license, sentence)")


def classify(notes: DataFrame, threshold: float, templates=TEMPLATES) -> DataFrame:
    """``notes``: distinct (note, docs).  (note, license, score) of those
    whose best cosine reaches ``threshold``; scores have six decimals."""
    spark = notes.sparkSession
    known = template_table(spark, templates)
    note_words = cut(word_counts(notes, "note", "note"))
    known_words = word_counts(known, "template", "sentence")
    df = (note_words.join(notes, "note").select("word", F.col("docs").alias("n"))
          .unionByName(known_words.select("word", F.lit(1).cast("long").alias("n"))).groupBy("word").agg(F.sum("n").alias("df")))
    total = notes.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"))
    size = total.collect()[0]["n"] + len(templates)
    idf = df.select("word", (F.log((F.lit(1.0) + F.lit(size)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    note_vector = note_words.join(idf, "word").select("note", "word", (F.col("tf") * F.col("idf")).alias("w"))
    known_vector = known_words.join(idf, "word").select("template", "word", (F.col("tf") * F.col("idf")).alias("v"))
    note_norm = note_vector.groupBy("note").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("note_norm"))
    known_norm = known_vector.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("known_norm"))
    dots = (note_vector.join(F.broadcast(known_vector), "word").groupBy("note", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot")))
    cosine = F.round(F.col("dot") / (F.col("note_norm") * F.col("known_norm")), 6)
    scored = (dots.join(note_norm, "note").join(F.broadcast(known_norm.join(known.select("template", "license"), "template")), "template")
              .select("note", "license", cosine.alias("score")).where(F.col("score") >= threshold))
    best = F.min(F.struct((-F.col("score")).alias("less"), "license"))
    return scored.groupBy("note").agg(best.alias("b")).select("note", F.col("b.license").alias("license"), (-F.col("b.less")).alias("score"))


def directory_licenses(files: DataFrame, dirs: DataFrame) -> DataFrame:
    """(dir, inherited_from, license) for the directories ``dirs`` (dir) that
    have a licensed ancestor or are licensed themselves, the nearest one
    first.  ``files``: (dir, license, score) of licence files."""
    best = F.min(F.struct((-F.col("score")).alias("less"), "license"))
    licensed = files.groupBy("dir").agg(best.alias("b")).select(F.col("dir").alias("above"), F.col("b.license").alias("license"))
    parts = F.split("dir", "/")
    above = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above"))))
    chain = dirs.select("dir", above.alias("a")).select("dir", "a.depth", "a.above")
    nearest = F.max(F.struct("depth", "above", "license"))
    return chain.join(licensed, "above").groupBy("dir").agg(nearest.alias("n")).select("dir", F.col("n.above").alias("inherited_from"), "n.license")


def scan_licenses(docs: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path", templates=TEMPLATES) -> DataFrame:
    """(id, path, own_license, own_score, license, inherited_from) of every
    row."""
    rows = cut(segments(docs, id_col, text_col, path_col))
    each = rows.where(F.size("notes") > 0).select("rid", F.explode("notes").alias("note"))
    notes = cut(each.groupBy("note").agg(F.count("*").alias("docs")))
    classes = cut(classify(notes, threshold, templates))
    noted = each.join(classes, "note").select("rid", "license", "score", F.size(F.split("note", " ")).alias("note_words"), F.lit(False).alias("whole"), F.lit(False).alias("full"))
    spanning = passage_licenses(rows, threshold, templates).select("rid", "license", "score", F.lit(0).alias("note_words"), "whole", "full")
    # licences share sentences: what the whole text is like goes before them
    first = F.min(F.struct((~F.col("full")).alias("part"), (-F.col("score")).alias("less"), "license"))
    own = (noted.unionByName(spanning).groupBy("rid")
           .agg(first.alias("b"), F.sum("note_words").alias("note_words"), F.max("whole").alias("whole"))
           .select("rid", F.col("b.license").alias("own_license"), (-F.col("b.less")).alias("own_score"), "note_words", "whole"))
    folder = F.regexp_extract(F.col("path"), "^(.*)/[^/]*$", 1)  # "" for a file at the top, null without a path
    met = cut(rows.select("rid", "id", "path", "words", folder.alias("dir")).join(own, "rid", "left"))
    files = met.where("own_license IS NOT NULL AND dir IS NOT NULL").where(F.rlike("path", F.lit(FILE_NAME)) | F.col("whole") | (2 * F.col("note_words") >= F.col("words")))
    found = directory_licenses(files.select("dir", F.col("own_license").alias("license"), F.col("own_score").alias("score")),
                               met.where("dir IS NOT NULL").select("dir").distinct())
    # written: where both sides are plain reads, Spark can split one large directory
    out = met.join(written(found), "dir", "left")
    inherits = F.col("own_license").isNull()
    return out.select("id", "path", "own_license", "own_score", F.coalesce("own_license", "license").alias("license"), F.when(inherits, F.col("inherited_from")).alias("inherited_from"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie at source/language/doc_id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    return scan_licenses(docs).withColumnRenamed("id", "doc_id")


def op10_sql(threshold: float = 0.7) -> str:
    quoted = lambda t: t.replace("'", "''")
    known = ", ".join(f"({i}, '{quoted(n)}', '{quoted(t)}')" for i, (n, t) in enumerate(TEMPLATES))
    words = f"unnest(regexp_extract_all(lower({{0}}), '{WORDS}'))".format
    return f"""
WITH rows_ AS (
    SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, text,
           CASE WHEN regexp_matches(text, '{CUE}') THEN len(regexp_split_to_array(trim(text), '\\s+')) END AS words
    FROM documents),
each AS (
    SELECT doc_id, trim(regexp_replace(lower(part), '\\s+', ' ', 'g')) AS note
    FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?;])[ \\t]+([A-Z])', '\\1' || chr(10) || '\\2', 'g'), chr(10))) AS part FROM rows_)
    WHERE regexp_matches(part, '{CUE}')),
notes AS (SELECT note, count(*) AS docs FROM each GROUP BY note),
known AS (SELECT * FROM (VALUES {known}) t(template, license, sentence)),
note_words AS (SELECT note, word, count(*) AS tf FROM (SELECT note, {words('note')} AS word FROM notes) GROUP BY ALL),
known_words AS (SELECT template, word, count(*) AS tf FROM (SELECT template, {words('sentence')} AS word FROM known) GROUP BY ALL),
df AS (SELECT word, sum(n) AS df FROM (
    SELECT word, docs AS n FROM note_words JOIN notes USING (note) UNION ALL SELECT word, 1 FROM known_words) GROUP BY word),
idf AS (SELECT word, ln((1.0::DOUBLE + (SELECT coalesce(sum(docs), 0) FROM notes) + {len(TEMPLATES)}) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM df),
nv AS (SELECT note, word, tf * idf AS w FROM note_words JOIN idf USING (word)),
kv AS (SELECT template, word, tf * idf AS v FROM known_words JOIN idf USING (word)),
scored AS (
    SELECT note, license, round(sum(w * v) / (any_value(nn) * any_value(kn)), 6) AS score
    FROM nv JOIN kv USING (word) JOIN known USING (template)
    JOIN (SELECT note, sqrt(sum(w * w)) AS nn FROM nv GROUP BY note) USING (note)
    JOIN (SELECT template, sqrt(sum(v * v)) AS kn FROM kv GROUP BY template) USING (template)
    GROUP BY note, template, license HAVING score >= {threshold}),
classes AS (SELECT note, license, score FROM scored QUALIFY row_number() OVER (PARTITION BY note ORDER BY score DESC, license) = 1),
own AS (
    SELECT doc_id, min({{'less': -score, 'license': license}}) AS b, sum(len(string_split(note, ' '))) AS note_words
    FROM each JOIN classes USING (note) GROUP BY doc_id),
met AS (
    SELECT r.doc_id, r.path, r.words, regexp_extract(r.path, '^(.*)/[^/]*$', 1) AS dir, b.license AS own_license, -b.less AS own_score, note_words
    FROM rows_ r LEFT JOIN own USING (doc_id)),
licensed AS (
    SELECT dir AS above, min({{'less': -own_score, 'license': own_license}}).license AS license FROM met
    WHERE own_license IS NOT NULL AND (regexp_matches(path, '{FILE_NAME}') OR 2 * note_words >= words) GROUP BY dir),
chain AS (
    SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS above
    FROM (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM met))),
nearest AS (SELECT dir, above, license FROM chain JOIN licensed USING (above) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1)
SELECT m.doc_id, m.path, m.own_license, m.own_score, coalesce(m.own_license, n.license) AS license,
       CASE WHEN m.own_license IS NULL THEN n.above END AS inherited_from
FROM met m LEFT JOIN nearest n USING (dir)
"""


OP10_SQL = op10_sql()
