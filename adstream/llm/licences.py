"""Licence scans: TF-IDF cosine to templates, then inheritance from directories.

Headers (lines that speak of licensing, each alone, with a neighbour, and in runs) and
whole licence files are sparse TF-IDF vectors; document counts come from all of them
and all templates. A licence has several templates: its SPDX line, title, notices and,
where it is short, its text. A file has the licence of its best match. A file named as
a licence file, or one that is a licence as a whole, gives its licence to its directory,
and files without one of their own take that of their nearest ancestor that has one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm.tables import split_join, stored

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""

# By which texts a work names its licence.
TEMPLATES = {
    "apache-2.0": (
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "mit": (
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        "MIT License " + _MIT,
    ),
    "gpl-3.0": (
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "gpl-2.0": (
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "lgpl-3.0": (
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ),
    "bsd-3-clause": (
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD 3-Clause License",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
        "BSD 3-Clause License All rights reserved. " + _BSD,
    ),
    "mpl-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License Version 2.0",
        "Subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-4.0": (
        "SPDX-License-Identifier: CC-BY-4.0",
        "Creative Commons Attribution 4.0 International",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying is prohibited.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}
# Works under other licences reserve all rights too, so this one counts where it is alone.
RESERVED = "proprietary"

HEADER = r"(?i)licen[cs]e|copyright|redistribution|all rights reserved|permission is hereby granted|creative commons|unauthori[sz]ed copying"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]es?|copying|notice)([._-][^/]*)?$"
WORD = r"[a-z0-9]+(?:[.][0-9]+)*"
WHOLE = -1


@dataclass(frozen=True)
class Matching:
    """Least cosine of a header or a licence file."""

    cosine: float = 0.7


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession, named: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    rows = [(licence, k, text) for licence, texts in sorted((named or TEMPLATES).items()) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "licence string, number int, passage string")


def passages(files: DataFrame) -> DataFrame:
    """(path, text_key, line_no, passage) of what is compared with the templates.

    Of a file with a line that speaks of licensing, and of one named as a licence file:
    each such line, it and each neighbour that is not blank, each run of three or more
    such lines, and the whole text, whose line_no is WHOLE. Whole texts are looked at.
    """
    asked = files.where(F.col("text").rlike(HEADER) | (F.col("path").rlike(LICENCE_FILE) & F.col("text").isNotNull()))
    asked = asked.withColumn("lines", F.split("text", "\n"))
    asked = asked.withColumn("tells", F.transform("lines", lambda x: x.rlike(HEADER)))
    at = F.sequence(F.lit(0), F.size("lines") - 1)

    def tells(k):
        return F.coalesce(F.get("tells", k), F.lit(False))

    def filled(k):
        return F.length(F.trim(F.get("lines", k))) > 0

    def taken(first, count):
        joined = F.array_join(F.slice("lines", first + 1, count), " ")
        return F.struct(first.cast("bigint").alias("line_no"), F.trim(joined).alias("passage"))

    singles = F.transform(F.filter(at, tells), lambda k: taken(k, F.lit(1)))
    pairs = F.filter(at, lambda k: (tells(k) | tells(k + 1)) & filled(k) & F.coalesce(filled(k + 1), F.lit(False)))
    begins = F.filter(at, lambda k: tells(k) & ~tells(k - 1))
    ends = F.filter(at, lambda k: tells(k) & ~tells(k + 1))
    runs = F.zip_with(begins, ends, lambda x, y: F.struct(x.alias("first"), (y - x + 1).alias("count")))
    runs = F.filter(runs, lambda r: r["count"] > 2)
    whole = F.array(F.struct(F.lit(WHOLE).cast("bigint").alias("line_no"), F.trim("text").alias("passage")))
    every = F.concat(
        whole, singles, F.transform(pairs, lambda k: taken(k, F.lit(2))),
        F.transform(runs, lambda r: taken(r["first"], r["count"])),
    )
    return asked.select("path", "text_key", F.explode(every).alias("p")).select("path", "text_key", "p.*")


def matches(found: DataFrame, known: DataFrame) -> DataFrame:
    """(key, licence, cosine) of the best template of each licence and each different passage,
    from (key, passage), in all of which equal keys have equal passages.

    Equal passages are one vector, but each counts as a document of its own.
    """
    words = found.select("key", F.explode(_words(F.col("passage"))).alias("word"))
    counted = words.groupBy("key", "word").agg(F.count("*").alias("all"))
    seen = found.groupBy("key").agg(F.count("*").alias("times"))
    counted = split_join(counted, seen, ["key"])
    counted = stored(counted.withColumn("tf", F.col("all") / F.col("times")), "header_words")
    own = known.select("licence", "number", F.explode(_words(F.col("passage"))).alias("word"))
    own = own.groupBy("licence", "number", "word").agg(F.count("*").alias("tf"))
    total = found.count() + known.count()
    often = (
        counted.select("word", "times")
        .unionByName(own.select("word", F.lit(1).cast("bigint").alias("times")))
        .groupBy("word")
        .agg(F.sum("times").alias("df"))
        .select("word", (F.log(F.lit(total + 1.0) / (F.col("df") + 1)) + 1).alias("idf"))
    )
    often = stored(often, "header_idf")
    tf_idf = F.col("tf") * F.col("idf")
    vectors = split_join(counted, often, ["word"]).select("key", "word", tf_idf.alias("x"))
    own = own.join(often, "word").select("licence", "number", "word", tf_idf.alias("y"))
    norms = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("x_norm"))
    own_norms = own.groupBy("licence", "number").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("y_norm"))
    dots = (
        vectors.join(own, "word")
        .groupBy("key", "licence", "number")
        .agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    )
    scored = split_join(dots, norms, ["key"]).join(own_norms, ["licence", "number"])
    cosine = F.round(F.col("dot") / (F.col("x_norm") * F.col("y_norm")), 6)
    return scored.groupBy("key", "licence").agg(F.max(cosine).alias("cosine"))


def _parent(path: Column) -> Column:
    """The directory of a path; the root is the empty path."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, how: Matching = Matching(), named: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(path, licence, cosine, origin, licence_path) of each file, from (path, text).

    origin is ``own``, ``inherited`` or ``none``. Of several matches in a file one that is
    not RESERVED decides, then the most similar, then the whole text and the first line,
    then the name. A file gives its licence to its directory where its name is that of a
    licence file or its whole text matches that licence; of several in a directory again
    the first in this order, then by path. Null and empty texts have no header and may
    inherit; a null path keeps its row, and neither gives nor inherits. Repeated rows
    keep theirs. No rows give no rows.
    """
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    known = templates(files.sparkSession, named)
    keyed = files.withColumn("text_key", F.struct(F.xxhash64("text"), F.hash("text")))
    found = passages(keyed).withColumn("key", F.md5("passage"))
    found = stored(found, "headers")
    alike = matches(found.select("key", "passage"), known).where(F.col("cosine") >= how.cosine)
    found = split_join(found.drop("passage"), alike, ["key"])
    order = F.struct(
        (F.col("licence") == RESERVED).alias("reserved"), (-F.col("cosine")).alias("less"), "line_no", "licence"
    )
    wholes = F.collect_set(F.when(F.col("line_no") == WHOLE, F.col("licence")))
    best = found.groupBy(F.struct("path", "text_key").alias("file")).agg(
        F.min(order).alias("best"), wholes.alias("wholes")
    )
    own = split_join(keyed.select(F.struct("path", "text_key").alias("file")), best, ["file"], "left")
    own = stored(own.select("file.path", "best", "wholes"), "own_licences")
    gives = F.col("path").rlike(LICENCE_FILE) | F.array_contains("wholes", F.col("best.licence"))
    places = own.where(F.col("best").isNotNull() & F.col("path").isNotNull() & gives)
    places = places.groupBy(_parent(F.col("path")).alias("above")).agg(
        F.min(F.struct("best.reserved", "best.less", "path", "best.licence")).alias("giver")
    )
    asking = own.where("best is null and path is not null").select(_parent(F.col("path")).alias("directory"))
    parts = F.split("directory", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")
    )
    asking = asking.distinct().withColumn("above", F.explode(F.array_distinct(above)))
    nearest = split_join(asking, places, ["above"]).groupBy("directory").agg(
        F.max_by("giver", F.length("above")).alias("giver")
    )
    nearest = stored(nearest, "directory_licences")
    has = F.col("best").isNotNull()
    return split_join(
        own.withColumn("directory", F.when(~has, _parent(F.col("path")))), nearest, ["directory"], "left"
    ).select(
        "path",
        F.coalesce("best.licence", "giver.licence").alias("licence"),
        (-F.coalesce("best.less", "giver.less")).alias("cosine"),
        F.when(has, "own").when(F.col("giver").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("giver.path")).alias("licence_path"),
    )
