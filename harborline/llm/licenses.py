"""Licence scans: whole files and notices matched to templates by TF-IDF cosine, then inherited along directories.

What is compared with the templates, as sparse vectors of words: the whole text of a file with a cue word, each of its
blocks (lines up to a line without letters or digits) with one, and each line with one, alone and joined with its
neighbours, so that wrapped notices and comment headers are read whole.  Template words are weighted by how rare they are
among all files; any other word weighs like the rarest.  The nearest template above ``least_cosine`` is the file's own
licence; a text that two licences match about alike names none.  A file speaks for its directory if it has a licence file's
name and a licence, or if its whole text is close to a template; files without a licence take that of the nearest
ancestor directory for which a file speaks.

Rows: a NULL or empty text has no notice and may inherit; a NULL path neither speaks nor inherits; files with the same
path are one file, with its best match; several licence files in a directory: the best match, then the first name; extra
columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import written

# Public licence texts, the openings of the long ones, and the notices by which licences are named.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""


def _gnu(name: str, version: int) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""


TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", _APACHE, _APACHE.split("Unless")[0], _APACHE.split(" You may obtain")[0],
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", f"{_BSD} {_BSD_REST}"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", f"{_BSD} {_BSD_THIRD} {_BSD_REST}",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", "Creative Commons Legal Code CC0 1.0 Universal"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _gnu("General Public License", 2),
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _gnu("General Public License", 3),
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "ISC": ["Released under the ISC License.", _ISC],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _gnu("Lesser General Public License", 3),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", f"{_MIT} {_MIT_REST}", _MIT,
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "Mozilla Public License Version 2.0"],
}
CUE = r"(?i)licen[sc]e|copyright|public domain|permission is hereby granted|permission to use|redistribution and use|legal code"
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicen[sc]e)([._-][^/]*)?$"
LEAST_COSINE, FILE_COSINE = 0.6, 0.8
CLEAR = 0.75  # the best licence lacks less than this share of what the second best lacks of a full match
NOT_WORD = "[^a-z0-9]+"
BETWEEN_BLOCKS = r"\n(?:[^A-Za-z0-9\n]*\n)+"
JOINED = [(0, 1), (-1, 2), (0, 2), (-1, 3), (0, 4)]  # lines that are read together: from where, and how many


def template_rows() -> list[tuple[int, str, str, int]]:
    """(template, licence, word, times) of all templates."""
    import re

    texts = [(name, text) for name, all_ in TEMPLATES.items() for text in all_]
    return [(i, name, word, times) for i, (name, text) in enumerate(texts)
            for word, times in sorted(Counter(re.split(NOT_WORD, text.lower())).items()) if word]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def rarity(n: Column, holders: Column) -> Column:
    return F.log((n + 1) / (holders + 1)) + 1


def word_weights(files: DataFrame) -> DataFrame:
    """word, weight of every template word, from the number of files that hold it; '' stands for all other words."""
    known = sorted({word for _, _, word, _ in template_rows()})
    held = F.explode(F.array_intersect(words(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, known))))
    held = files.select(held.alias("word")).groupBy("word").agg(F.count("*").alias("holders"))
    total = files.count()
    every = files.sparkSession.sql("SELECT explode(array(" + ", ".join(f"'{w}'" for w in ["", *known]) + ")) AS word")
    every = every.join(held, "word", "left")
    return every.select("word", rarity(F.lit(total), F.coalesce("holders", F.lit(0))).alias("weight"))


def notices(files: DataFrame) -> DataFrame:
    """path, whole (whether it is the text of the file), text: all that is compared with the templates."""
    lines = F.split("text", "\n")
    cued = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(CUE))
    joined = F.flatten(F.transform("cued", lambda i: F.array(*[F.array_join(F.slice(
        F.col("lines"), F.greatest(i + (at + 1), F.lit(1)), F.lit(n)), " ") for at, n in JOINED])))
    blocks = F.filter(F.split("text", BETWEEN_BLOCKS), lambda x: x.rlike(CUE))
    parts = F.array_distinct(F.concat(blocks, joined))
    found = files.where(F.col("text").rlike(CUE)).select("path", "text", lines.alias("lines"))
    found = found.select("path", "text", "lines", cued.alias("cued")).select("path", "text", parts.alias("parts"))
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("text"))), F.transform("parts", lambda x: F.struct(
        F.lit(False).alias("whole"), x.alias("text"))))
    return found.select("path", F.inline(units))


def matched(files: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """path, licence, cosine, is_file: the best template of each file with a text close enough to one."""
    spark = files.sparkSession
    weights = written(word_weights(files), "word-weights")
    values = ", ".join(f"({i}, '{name}', '{word}', {times})" for i, name, word, times in template_rows())
    templates = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, licence, word, times)").join(weights, "word")
    templates = templates.withColumn("w", F.col("times") * F.col("weight"))
    norms = templates.groupBy("template").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    templates = written(templates.join(norms, "template").select("template", "licence", "word", "w", "norm"), "templates")
    other = weights.where("word = ''").first()["weight"]
    unit = ["path", "whole", "hash"]
    spoken = notices(files).select("path", "whole", F.xxhash64("text").alias("hash"), words(F.col("text")).alias("words")).distinct()
    spoken = spoken.select(*unit, F.explode("words").alias("word")).groupBy(*unit, "word").agg(F.count("*").alias("times"))
    spoken = spoken.join(weights, "word", "left").withColumn("v", F.col("times") * F.coalesce("weight", F.lit(other)))
    spoken = written(spoken.select(*unit, "word", "v"), "notice-words")
    length = spoken.groupBy(*unit).agg(F.sqrt(F.sum(F.col("v") ** 2)).alias("length"))
    dots = spoken.join(templates, "word").groupBy(*unit, "template", "licence", "norm").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    scored = dots.join(length, unit).select(*unit, "licence", F.round(F.col("dot") / (F.col("length") * F.col("norm")), 9).alias("cosine"))
    scored = scored.where(F.col("cosine") >= least_cosine).groupBy(*unit, "licence").agg(F.max("cosine").alias("cosine"))
    # As many entries as there are licences; what two of them match about alike names neither.
    best = scored.groupBy(*unit).agg(F.sort_array(F.collect_list(F.struct((-F.col("cosine")).alias("less"), "licence"))).alias("all"))
    missing = [1 + F.get("all", F.lit(i))["less"] for i in (0, 1)]  # what the two best lack of a full match
    best = best.where((F.size("all") == 1) | (missing[0] < CLEAR * missing[1]))
    best = best.select("path", "whole", F.get("all", F.lit(0)).alias("b")).groupBy("path").agg(
        F.min("b").alias("b"), F.max(F.col("whole") & (-F.col("b.less") >= FILE_COSINE)).alias("is_file"))
    return best.select("path", "b.licence", (-F.col("b.less")).alias("cosine"), (F.col("is_file") | F.col("path").rlike(FILE_NAME)).alias("is_file"))


def folder(path: Column) -> Column:
    """The path without its last part; '' above a single part."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """dir, licence, origin: for each directory the licence of the nearest directory upwards with a licence file.

    The work is per distinct directory, so a directory with many files is looked up once.
    """
    speaks = own.where("is_file").groupBy(folder(F.col("path")).alias("origin")).agg(
        F.min(F.struct((-F.col("cosine")).alias("less"), "path", "licence")).getField("licence").alias("licence"))
    dirs = files.select(folder(F.col("path")).alias("dir")).where("dir IS NOT NULL").distinct()
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    up = dirs.select("dir", F.explode(F.array_distinct(up)).alias("origin"))
    near = up.join(speaks, "origin").groupBy("dir").agg(F.max(F.struct(F.length("origin"), "origin", "licence")).alias("n"))
    return near.select("dir", "n.licence", "n.origin")


def scan(files: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """Per file (path, text): path, own_licence, cosine, is_licence_file, licence, origin (the directory it comes from)."""
    files = files.select("path", "text")
    own = written(matched(files, least_cosine), "own-licences")
    above = written(inherited(files, own), "directory-licences").select("dir", F.col("licence").alias("above"), "origin")
    own = own.select(F.col("path").alias("_path"), F.col("licence").alias("own_licence"), "cosine", "is_file")
    out = files.select("path", folder(F.col("path")).alias("_dir")).join(own, F.col("path") == F.col("_path"), "left")
    out = out.join(above, F.col("_dir") == F.col("dir"), "left")
    return out.select("path", "own_licence", "cosine", F.coalesce("is_file", F.lit(False)).alias("is_licence_file"),
                      F.coalesce("own_licence", "above").alias("licence"), F.when(F.col("own_licence").isNull(), F.col("origin")).alias("origin"))
