"""Licence texts as projects carry them, none of them a template word by word."""

from __future__ import annotations

import pytest

from salesflow.llm import licenses

MIT = """The MIT License (MIT)

Copyright (c) 2019 Jane Roe and contributors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

BSD = """Copyright (c) 2011, The Example Authors
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

 * Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
 * Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
 * Neither the name of Example nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""

APACHE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document."""

GPL = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed."""

GNU_HEADER = """# frobnicate - turns knobs
# Copyright (C) 2020 Jane Roe
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.

import knobs
"""

APACHE_HEADER = """/*
 * Copyright 2021 Example
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
int main() { return 0; }
"""

CODE = "\n".join(f"let value{i} = compute(value{i - 1}) plus other{i};" for i in range(60))

FOUND = {
    "mit/LICENSE": (MIT, "MIT", "file"),
    "bsd/COPYING": (BSD, "BSD-3-Clause", "file"),
    "apache/LICENSE": (APACHE, "Apache-2.0", "file"),
    "gpl/COPYING": (GPL, "GPL-3.0", "file"),
    "one/main.py": (GNU_HEADER + CODE, "GPL-3.0", "header"),
    "two/main.c": (APACHE_HEADER + CODE, "Apache-2.0", "header"),
    "three/x.js": ("// SPDX-License-Identifier: MIT\n" + CODE, "MIT", "header"),
    "three/y.js": (CODE + "\n// SPDX-License-Identifier: BSD-2-Clause\n" + CODE, "BSD-2-Clause", "header"),
    "four/z.txt": (CODE + "\nThis file is released under the MIT License.\n" + CODE, "MIT", "header"),
    "five/long.txt": ("filler words here\n" * 200_000 + "# Released under the MIT License by Acme.", "MIT", "header"),
    "six/none.txt": (CODE + "\nReleased under the Foo License.\n// SPDX-License-Identifier: Foo", None, None),
    "mit/deep/er/code.txt": (CODE, None, "inherited"),
}
COMMON = "this is a file of the plain kind that the team keeps under a shelf by the door"


def _table(spark, others):
    rows = [(i, p, t) for i, (p, (t, *_)) in enumerate(FOUND.items())]
    plain = spark.range(others).selectExpr("id + 1000 AS doc_id", "concat('other/', id) AS path", f"concat('{COMMON} ', id) AS text")
    return spark.createDataFrame(rows, "doc_id long, path string, text string").union(plain).repartition(6)


@pytest.fixture(scope="module")
def scanned(spark):
    return {r.path: r for r in licenses.scan(_table(spark, 1000)).where("doc_id < 1000").collect()}


@pytest.mark.parametrize("path", FOUND)
def test_real_notices_and_files(scanned, path):
    _, name, evidence = FOUND[path]
    assert (scanned[path].own_license, scanned[path].evidence) == (name, evidence)
    assert scanned["mit/deep/er/code.txt"].license == "MIT"


def test_scores_depend_on_shares_alone(spark):
    """Thirty times the rows with the same shares: the same scores."""
    few = _table(spark, 1000).where("path <> 'five/long.txt'")
    many = few.crossJoin(spark.range(30).withColumnRenamed("id", "copy"))
    first = {r.path: r.own_score for r in licenses.scan(few).where("doc_id < 1000").collect()}
    for r in licenses.scan(many).where("doc_id < 1000").distinct().collect():
        assert r.own_score == first[r.path]


def test_a_notice_in_a_third_of_all_rows(spark):
    text = "CASE WHEN id % 3 = 0 THEN 'Licensed under CC BY 4.0.' WHEN id % 3 = 1 THEN concat('plain ', id) END"
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('d', id % 7, '/', id) AS path", f"{text} AS text", "1 AS bag", "2 AS row", "3 AS term")
    rows = licenses.scan(df).collect()
    assert len(rows) == 3000
    assert all(r.own_license == ("CC-BY-4.0" if r.doc_id % 3 == 0 else None) for r in rows)


def test_equal_scores_go_to_the_first_name(spark):
    twins = [(n, "notice", "granted under terms of the house", "house") for n in ("Z-1", "A-1")]
    df = spark.createDataFrame([(1, None, "granted under terms of the house"), (2, "x/y", "")], "doc_id long, path string, text string")
    rows = {r.doc_id: r for r in licenses.scan(df, templates=twins).collect()}
    assert (rows[1].own_license, rows[1].evidence, rows[2].license) == ("A-1", "file", "A-1")
    free = [("F-1", "notice", "granted under terms of the house", "")]
    assert {r.doc_id: r.own_license for r in licenses.scan(df, templates=free).collect()} == {1: "F-1", 2: None}
