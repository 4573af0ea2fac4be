"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest licensed directory above.

DataFrame functions only. Units of a file are its lines, its header (the comment block that it begins with) and, if it is
named like a licence file, all of it. Lines are compared with notices; headers and licence files with notices and with
whole licences (``licence_texts``). A unit is compared with the templates it shares a telling term with. Each template's
telling terms are its rarest; the others hold less of its squared length than the threshold asks for, so by the
Cauchy-Schwarz inequality a unit without any telling term can't reach the threshold. Term statistics come from all files.
"""

from __future__ import annotations

import functools
import math
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.storage import Stash

THRESHOLD = 0.6
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
#: Possessive, so that a long text costs no depth of recursion.
TERM = r"[a-z0-9]++(?:\.++[a-z0-9]++)*+"
#: How a comment line, and a comment that goes on until its end mark, begin; and that mark.
COMMENT, BLOCK_COMMENT, BLOCK_END = r"^[ \t]*(#|//|/\*|\*|--|;|%|<!--)", r"^[ \t]*(/\*|<!--)", r"\*/|-->"
#: Units that are no line.
HEADER, WHOLE = -1, -2
#: Says only that no licence is named, so it counts where no other matches.
WEAK = "LicenseRef-Proprietary"

# Notices as licences ask for them, one or more for each licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, Public Domain Dedication."),
    ("LicenseRef-Proprietary", "All rights reserved."),
]


@functools.cache
def whole_texts() -> tuple[tuple[str, str], ...]:
    """Licence and full text of the files in licence_texts; what follows a ~ in a name tells versions of a text apart."""
    found = sorted((f for f in resources.files("millrace.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return tuple((f.name.removesuffix(".txt").split("~")[0], f.read_text(encoding="utf-8")) for f in found)


def any_of(words: list[str]) -> Column:
    """A fixed array of words without spaces."""
    return F.split(F.lit(" ".join(words)), " ")


def terms_of(text: Column) -> Column:
    """Lower-case runs of letters, digits and inner dots; by one expression, as a function of each word is interpreted."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")


def directory(path: Column) -> Column:
    """Path up to its last slash, without it; empty at the top, null for no path."""
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)).when(path.isNotNull(), F.lit(""))


def header_of(lines: Column) -> Column:
    """The lines of the comment block that a file begins with, as one text; empty if there is none."""
    other = F.array_position(F.transform(lines, lambda x: ~x.rlike(COMMENT)), True)
    ended = F.array_position(F.transform(lines, lambda x: x.rlike(BLOCK_END)), True)
    n = F.size(lines).cast("long")
    led = F.when(other > 0, other - 1).otherwise(n)
    block = F.when(F.get(lines, 0).rlike(BLOCK_COMMENT), F.when(ended > 0, ended).otherwise(n)).otherwise(F.lit(0).cast("long"))
    return F.array_join(F.slice(lines, F.lit(1), F.greatest(led, block).cast("int")), " ")


def template_table(spark: SparkSession, templates: list[tuple[str, str]], whole: list[tuple[str, str]]) -> DataFrame:
    """(template, licence, whole, term, tf); whole says that lines are not compared with it."""
    data = [(i, licence, i >= len(templates), text) for i, (licence, text) in enumerate([*templates, *whole])]
    rows = spark.createDataFrame(data, "template int, licence string, whole boolean, text string")
    return rows.select("template", "licence", "whole", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("template", "licence", "whole", "term").agg(F.count("*").alias("tf"))


def weights(files: DataFrame, templates: DataFrame) -> tuple[DataFrame, float, list[str], list[str]]:
    """(template, licence, whole, term, idf, w, norm), the idf of a term no template has, and the telling terms of notices
    and of all templates.

    A term's idf is ln((1 + n) / (1 + df)) + 1 over all n files; only the templates' terms are counted.
    """
    rows = templates.collect()  # a fixed list of texts
    vocabulary = F.broadcast(templates.select("term").distinct())
    seen = files.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))
    df = {r["term"]: r["n"] for r in seen.collect()}  # at most the templates' terms
    n = files.count()
    idf = {r["term"]: math.log((1 + n) / (1 + df.get(r["term"], 0))) + 1 for r in rows}
    weighed = [(r["template"], r["licence"], r["whole"], r["term"], idf[r["term"]], r["tf"] * idf[r["term"]]) for r in rows]
    by_template: dict[int, list[tuple]] = {}
    for row in weighed:
        by_template.setdefault(row[0], []).append(row)
    norm = {t: sum(r[5] * r[5] for r in own) for t, own in by_template.items()}
    telling: tuple[set[str], set[str]] = (set(), set())
    for t, own in by_template.items():
        rest = norm[t]
        for _, _, whole, term, _, w in sorted(own, key=lambda r: (-r[4], r[3])):
            if rest < (THRESHOLD * THRESHOLD - 0.01) * norm[t]:
                break
            telling[1].add(term)
            if not whole:
                telling[0].add(term)
            rest -= w * w
    table = files.sparkSession.createDataFrame([(*r, math.sqrt(norm[r[0]])) for r in weighed], "template int, licence string, whole boolean, term string, idf double, w double, norm double")
    return table, math.log(1 + n) + 1, sorted(telling[0]), sorted(telling[1])


def own_matches(files: DataFrame, templates: list[tuple[str, str]], stash: Stash) -> DataFrame:
    """(id, path, licence, score, unit) of the best match of each file that has one; files has id, path and text."""
    table, unseen, telling, telling_whole = weights(files, template_table(files.sparkSession, templates, list(whole_texts())))
    table = F.broadcast(table)  # a row for each term of the templates
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    commented = F.coalesce(F.col("text").rlike(COMMENT), F.lit(False))
    # a file without a comment at its beginning that has no telling term of a notice is not taken apart
    hopeful = files.where(named | commented | F.arrays_overlap(terms_of(F.col("text")), any_of(telling)))
    lines = F.col("lines")
    unit = lambda number, text: F.struct(F.lit(number).cast("int").alias("unit"), text.alias("text"))
    pieces = F.concat(
        F.transform(lines, lambda x, i: F.struct(i.cast("int").alias("unit"), x.alias("text"))),
        F.when(commented, F.array(unit(HEADER, header_of(lines)))).otherwise(F.array().cast("array<struct<unit:int,text:string>>")),
        F.when(named, F.array(unit(WHOLE, F.array_join(lines, " ")))).otherwise(F.array().cast("array<struct<unit:int,text:string>>")),
    )
    units = hopeful.select("id", "path", "text", lines_of(F.col("text")).alias("lines")).select("id", "path", F.explode(pieces).alias("u")).select("id", "path", "u.unit", terms_of(F.col("u.text")).alias("terms"))
    units = stash.keep(units.where(F.when(F.col("unit") >= 0, F.arrays_overlap("terms", any_of(telling))).otherwise(F.arrays_overlap("terms", any_of(telling_whole)))), "units")
    counted = units.select("id", "path", "unit", F.explode("terms").alias("term")).groupBy("id", "path", "unit", "term").agg(F.count("*").alias("tf"))
    idf = table.select("term", "idf").distinct()
    weighed = counted.join(F.broadcast(idf), "term", "left").withColumn("u", F.col("tf") * F.coalesce("idf", F.lit(unseen))).drop("idf")
    lengths = weighed.groupBy("id", "path", "unit").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("length"))
    dots = weighed.join(table, "term").where("unit < 0 OR NOT whole").groupBy("id", "path", "unit", "template", "licence", "norm").agg(F.sum(F.col("u") * F.col("w")).alias("dot"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("id", "path", "unit")]
    scored = dots.alias("a").join(lengths.alias("b"), same[0] & same[1] & same[2]).select("a.id", "a.path", "a.unit", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6).alias("score"))
    best = F.max_by(F.struct("licence", "score", "unit"), F.struct(F.col("licence") != WEAK, "score", -F.col("unit"), F.col("licence")))
    return scored.where(F.col("score") >= THRESHOLD).groupBy("id", "path").agg(best.alias("b")).select("id", "path", "b.licence", "b.score", "b.unit")


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """files (id, path, text) with licence, score, unit, found_in and depth.

    found_in says where the licence comes from: ``file`` if a line, the header or, of a licence file, the whole text matches
    a template with a cosine of at least 0.6; else ``directory`` if the file's directory or the nearest one above has a
    licence file that matches, with depth the number of levels up; else all are null. unit is the line's number, -1 for the
    header and -2 for a whole file. ``All rights reserved`` counts only if nothing else matches. Of equal scores the whole
    file wins, then the header, then the earlier line, then the last licence by name; of several licence files in a directory
    the best score, then the last licence by name. Null texts match nothing; a file without a path has no directory and
    inherits nothing. Rows that repeat id and path are one file, judged by all their texts. Other columns are ignored.
    """
    stash = Stash(files.sparkSession, "licences")
    files = files.select("id", "path", "text")
    own = stash.keep(own_matches(files, templates, stash), "own")
    stash.drop_others(own)
    granted = own.where(F.col("path").rlike(LICENCE_FILE)).groupBy(directory(F.col("path")).alias("dir")).agg(F.max(F.struct(F.col("licence") != WEAK, "score", "licence")).alias("g")).select("dir", F.col("g.licence").alias("d_licence"), F.col("g.score").alias("d_score"))
    # one row for each directory and each of its ancestors, however many files it holds
    dirs = files.where("path IS NOT NULL").select(directory(F.col("path")).alias("at")).distinct()
    parts = F.when(F.col("at") == "", F.array().cast("array<string>")).otherwise(F.split("at", "/"))
    above = dirs.select("at", parts.alias("p")).select("at", F.explode(F.sequence(F.lit(0), F.size("p"))).alias("depth"), "p").select("at", "depth", F.array_join(F.slice("p", F.lit(1), F.size("p") - F.col("depth")), "/").alias("dir"))
    nearest = above.join(granted, "dir").groupBy("at").agg(F.min(F.struct("depth", "d_licence", "d_score")).alias("n")).select("at", "n.*")
    keys = files.groupBy("id", "path").agg(F.lit(1).alias("one")).drop("one")
    joined = keys.alias("f").join(own.alias("o"), F.col("f.id").eqNullSafe(F.col("o.id")) & F.col("f.path").eqNullSafe(F.col("o.path")), "left").join(nearest, directory(F.col("f.path")) == F.col("at"), "left")
    mine = F.col("o.licence").isNotNull()
    return joined.select(
        "f.id", "f.path", F.coalesce("o.licence", "d_licence").alias("licence"), F.coalesce("o.score", "d_score").alias("score"), "o.unit",
        F.when(mine, F.lit("file")).when(F.col("d_licence").isNotNull(), F.lit("directory")).alias("found_in"), F.when(~mine, F.col("depth")).alias("depth"),
    )
