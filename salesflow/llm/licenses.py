"""Licence scan: TF-IDF cosine of lines, windows and whole files to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.session import stage

# Fixed values: (licence, kind, wording, words a text must hold to be compared, the one that is rarest in prose first).
# Kinds: a ``notice`` or ``header`` stands in a file of something else, a ``body`` makes its text a licence file.
TEMPLATES = [
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0.", "apache 2"),
    ("BSD-3-Clause", "notice", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "bsd governed"),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0.", "cc by 4"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0.", "cc by nc 4"),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2.", "gnu general public 2"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3.", "gnu general public 3"),
    ("LicenseRef-reserved", "notice", "All rights reserved.", "reserved all rights"),
    ("MIT", "notice", "Released under the MIT License.", "license mit"),
    ("MIT", "notice", "Licensed under the MIT License.", "license mit"),
    (
        "Apache-2.0",
        "header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
        "apache 2",
    ),
    (
        "GPL-2.0",
        "header",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
        "gnu general public 2",
    ),
    (
        "GPL-3.0",
        "header",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
        "gnu general public 3",
    ),
    (
        "LGPL-2.1",
        "header",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
        License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
        "lesser general public 2 1",
    ),
    (
        "MPL-2.0",
        "header",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "mozilla 2",
    ),
    ("Apache-2.0", "body", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "apache january 2004"),
    (
        "BSD-2-Clause",
        "body",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution.""",
        "redistributions binary disclaimer",
    ),
    (
        "BSD-3-Clause",
        "body",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission.""",
        "redistributions neither endorse",
    ),
    ("GPL-2.0", "body", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "1991 june gnu general public 2"),
    ("GPL-3.0", "body", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gnu general public 3 june 2007"),
    (
        "ISC",
        "body",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
        "granted permission fee",
    ),
    ("LGPL-2.1", "body", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "lesser general public february 1999"),
    (
        "MIT",
        "body",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software.""",
        "sublicense permission furnished",
    ),
    ("MPL-2.0", "body", "Mozilla Public License Version 2.0", "mozilla version 2"),
    (
        "Unlicense",
        "body",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
        "unencumbered public domain",
    ),
]
TEMPLATES += [
    (name, "notice", f"SPDX-License-Identifier: {name}", f"spdx {name.replace('-', ' ').replace('.', ' ').lower()}")
    for name in sorted({t[0] for t in TEMPLATES if not t[0].startswith("LicenseRef")})
]
#: Cosine from which a window of lines is a notice, and a whole text a licence file.
HEADER, FILE = 0.75, 0.5
#: Adjacent lines compared as one; each window starts half its length after the last one.
WINDOWS = (1, 2, 4, 8, 16)
#: Share of texts below which terms weigh alike: a weight depends on shares, not on how many texts there are.
RARE = 0.01

_TERM = r"[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def frequent_terms(df: DataFrame, text: str, rare: float = RARE) -> DataFrame:
    """(term, weight) of every term that at least ``rare`` of all texts hold: 1 + ln(texts / texts with the term).

    Counted over all texts and all terms, combined before the one shuffle. A
    text brings each term once, so the result has at most 1 / ``rare`` times
    as many rows as an average text has distinct terms. All other terms weigh
    ``rarest``.
    """
    total = df.count()
    held = df.select(F.explode(F.array_distinct(terms(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
    often = held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rare * total)
    return often.select("term", (F.log(F.lit(float(total)) / F.col("n")) + 1).alias("weight"))


def rarest(rare: float = RARE) -> float:
    return 1 - math.log(rare)


def _windows(lines: Column, hits: Column) -> Column:
    """The windows of an array of lines that hold one of the lines at ``hits``, as an array of texts."""

    def wide(width: int) -> Column:
        step = max(width // 2, 1)
        last = F.greatest(F.size(lines) - width // 2, F.lit(1))

        def around(at: Column) -> Column:
            start = F.floor((at - 1) / step).cast("int") * step + 1
            return F.array(start, start - step) if width > 1 else F.array(start)

        starts = F.array_distinct(F.flatten(F.transform(hits, around)))
        starts = F.filter(starts, lambda at: (at >= 1) & (at <= last))
        return F.transform(starts, lambda at: F.concat_ws(" ", *[F.get(lines, at + (j - 1)) for j in range(width)]))

    return F.concat(*map(wide, WINDOWS))


def _holds(text: Column, words: list[str] | None) -> Column:
    """Whether a text may be compared at all: it holds one of ``words`` (all texts may if there are none)."""
    if words is None:
        return F.lit(True)
    return F.lower(text).rlike(rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(map(re.escape, words))})(?:$|[^\p{{L}}\p{{N}}])")


def _comparable(held: Column, asked: list[list[str]]) -> Column:
    """Whether an array of terms holds all words of one of ``asked``."""
    if not all(asked):
        return F.lit(True)
    sets = [F.lit(list(words)) for words in sorted({tuple(sorted(set(w))) for w in asked})]
    known = F.array_intersect(held, F.lit(sorted(set().union(*asked))))
    return F.exists(F.array(known), lambda own: F.exists(F.array(*sets), lambda s: F.size(F.array_except(s, own)) == 0))


def scores(segments: DataFrame, frequent: DataFrame, templates: list[tuple[str, str, str, str]], rare: float, least: float) -> DataFrame:
    """(bag, template, score) of ``segments`` (bag, terms) whose cosine to a template is at least ``least``.

    Sparse: one row per distinct term of a segment, joined to its weight and to
    the templates that hold it. Only segments that hold all words a template
    asks for are compared with it. Scores are rounded to six places.
    """
    spark = segments.sparkSession
    counts = [Counter(_words(body)) for _, _, body, _ in templates]
    needed = [set(_words(words)) for *_, words in templates]
    vocabulary = sorted(set().union(*counts, *needed))
    other = rarest(rare)
    known = {r["term"]: r["weight"] for r in frequent.where(F.col("term").isin(vocabulary)).collect()}
    weight = {t: known.get(t, other) for t in vocabulary}
    entries = []
    for index, own in enumerate(counts):
        norm = math.sqrt(sum((n * weight[t]) ** 2 for t, n in own.items())) or 1.0
        for t in sorted(set(own) | needed[index]):
            entries.append((t, index, own[t] * weight[t] / norm, int(t in needed[index])))
    vectors = spark.createDataFrame(entries, "term string, template int, share double, need int")
    wanted = spark.createDataFrame([(i, len(n)) for i, n in enumerate(needed)], "template int, needs int")
    counted = segments.select("bag", F.explode("terms").alias("term")).groupBy("bag", "term").agg(F.count(F.lit(1)).alias("n"))
    weighed = stage(
        counted.join(frequent, "term", "left").select("bag", "term", (F.col("n") * F.coalesce("weight", F.lit(other))).alias("value")),
        "licence-terms",
    )
    norms = weighed.groupBy("bag").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = weighed.join(vectors, "term").groupBy("bag", "template").agg(
        F.sum(F.col("value") * F.col("share")).alias("dot"), F.sum("need").alias("held")
    )
    met = dots.join(wanted, "template").where(F.col("held") == F.col("needs")).join(norms, "bag")
    return met.select("bag", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= least)


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(files: DataFrame, directories: DataFrame) -> DataFrame:
    """(dir, license, license_dir): for each of ``directories`` the licence of the nearest of it and its ancestors.

    ``files`` (dir, license, score) are licence files. Of several in one
    directory the best score holds, then the first name. Each directory is
    joined by the paths of its ancestors, as many as the path has parts.
    """
    order = F.min(F.struct((-F.col("score")).alias("score"), "license"))
    held = stage(files.groupBy("dir").agg(order.alias("best")).select(F.col("dir").alias("license_dir"), "best.license"), "licence-dirs")
    parts = F.split("dir", "/")
    depth = F.size(parts)
    ancestors = directories.select("dir", F.explode(F.sequence(F.lit(0), depth)).alias("depth"), parts.alias("parts")).select(
        "dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("license_dir")
    )
    nearest = F.max(F.struct("depth", "license_dir", "license")).alias("nearest")
    return ancestors.join(held, "license_dir").groupBy("dir").agg(nearest).select("dir", "nearest.license", "nearest.license_dir")


def scan(
    df: DataFrame,
    path: str = "path",
    text: str = "text",
    key: str = "doc_id",
    templates: list[tuple[str, str, str, str]] | None = None,
    header: float = HEADER,
    file: float = FILE,
    rare: float = RARE,
) -> DataFrame:
    """key, path, own_license, own_score, evidence, license, license_dir for every row.

    ``templates`` are (licence, kind, wording, needed words). Compared with
    them are the whole text and all windows of ``WINDOWS`` adjacent lines, so
    that wrapped notices are found. The evidence is ``file`` if the whole text
    reaches ``file`` with any template, or a window reaches ``header`` with a
    ``body``; ``header`` if a window reaches ``header`` with another template.
    File goes before header, then the larger score, then the first name. A
    text of evidence ``file`` is a licence file of its directory. Rows without
    an own licence take that of the nearest directory above them
    (``inherited``) or have none.

    Term weights come from all texts (``frequent_terms``). Texts leave the scan
    only if they hold the first needed word of a template, and of them only
    what holds all needed words of one; equal windows are scored once. Very long texts are
    scanned whole. A template without needed words is compared with all texts.

    A missing or empty text has no own licence; a missing path is in the root
    directory, as is a bare name; repeated rows each get a row; an empty table
    gives none; other columns are ignored, whatever their names.
    """
    templates = templates or TEMPLATES
    asked = [_words(words) for *_, words in templates]
    words = sorted({w[0] for w in asked}) if all(asked) else None
    rows = df.select(F.col(key).alias("doc_id"), F.col(path).cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    frequent = stage(frequent_terms(rows, "text", rare), "licence-weights")
    lines = F.split("text", "\n")
    hits = F.filter(F.transform(lines, lambda line, i: F.when(_holds(line, words), i + 1)), lambda at: at.isNotNull())
    found = stage(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "path",
            _parent(F.coalesce("path", F.lit(""))).alias("dir"),
            F.when(_holds(F.col("text"), words), F.struct(lines.alias("lines"), hits.alias("hits"))).alias("held"),
        ),
        "licence-rows",
    )
    candidates = found.where(F.col("held").isNotNull()).select("row", "held.lines", "held.hits")
    whole = F.struct(F.lit(True).alias("whole"), F.array_join("lines", "\n").alias("body"))
    parts = F.transform(_windows(F.col("lines"), F.col("hits")), lambda w: F.struct(F.lit(False).alias("whole"), w.alias("body")))
    segments = candidates.select("row", F.explode(F.concat(F.array(whole), parts)).alias("segment")).select(
        "row", "segment.whole", terms(F.col("segment.body")).alias("terms")
    )
    segments = segments.where(_comparable(F.col("terms"), asked))
    segments = stage(segments.select("row", "whole", F.sha2(F.array_join("terms", " "), 256).alias("bag"), "terms"), "licence-segments")
    near = scores(segments.select("bag", "terms").dropDuplicates(["bag"]), frequent, templates, rare, min(header, file))
    names = F.lit([t[0] for t in templates])
    bodies = F.lit([i for i, t in enumerate(templates) if t[1] == "body"]).cast("array<int>")
    is_file = F.when(F.col("whole"), F.col("score") >= file).otherwise((F.col("score") >= header) & F.array_contains(bodies, F.col("template")))
    hits = (
        segments.select("row", "whole", "bag")
        .join(near, "bag")
        .withColumn("file", is_file)
        .where(F.col("file") | (~F.col("whole") & (F.col("score") >= header)))
        .groupBy("row")
        .agg(F.min(F.struct((~F.col("file")).alias("last"), (-F.col("score")).alias("less"), F.element_at(names, F.col("template") + 1).alias("name"))).alias("best"))
    )
    own = stage(
        found.drop("held")
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "path",
            "dir",
            F.col("best.name").alias("own_license"),
            (-F.col("best.less")).alias("own_score"),
            F.when(F.col("best.last"), F.lit("header")).when(~F.col("best.last"), F.lit("file")).alias("evidence"),
        ),
        "licence-own",
    )
    files = own.where("evidence = 'file'").select("dir", F.col("own_license").alias("license"), F.col("own_score").alias("score"))
    above = stage(inherited(files, own.select("dir").distinct()), "licence-inherited")
    joined = own.join(above.withColumnRenamed("license", "passed"), "dir", "left")
    alone = F.col("evidence").isNull()
    return joined.select(
        "doc_id",
        "path",
        "own_license",
        "own_score",
        F.when(~alone, F.col("evidence")).when(F.col("passed").isNotNull(), F.lit("inherited")).alias("evidence"),
        F.when(~alone, F.col("own_license")).otherwise(F.col("passed")).alias("license"),
        F.when(alone, F.col("license_dir")).alias("license_dir"),
    )
