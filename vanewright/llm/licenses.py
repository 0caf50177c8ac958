"""Licence texts by canonical digest, with DataFrame functions only.

A text is made canonical: lower case; of a copyright line only what follows the holder; words, which
are runs of letters and digits, each between two spaces; equivalent spellings replaced by one.
Its SHA-256 is joined to the digests of the known licences, which are made by the same
expression.  Entire texts are looked up, and, as notices often stand in a line of their own,
entire lines; a line longer or shorter than every known licence is not digested.

The known side is a table of (license, notice), ``LICENSES`` or the caller's.  Up to ``MOST_KNOWN`` rows
it is sent to every task; a larger one is joined by digest, texts and exploded lines alike.

Defined results: null and empty texts have the digest of the empty text and no
licence; repeated rows are reported each; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.llm.tables import stored

#: Known digests, of about 100 bytes, that are sent to every task.
MOST_KNOWN = 10_000

# Notices by licence, and the texts of common licences.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("Proprietary", "All rights reserved."),
]
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.
"""
TEXTS = [
    ("MIT", _GRANT), ("MIT", "MIT License\n\n" + _GRANT), ("MIT", "The MIT License (MIT)\n\n" + _GRANT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("Apache-2.0", _APACHE_HEADER),
]
LICENSES = NOTICES + TEXTS

# Equivalent spellings, applied in this order to whole words.
SPELLINGS = [
    ("released under", "licensed under"), ("distributed under", "licensed under"), ("this work is licensed", "licensed"),
    ("this software is licensed", "licensed"), ("this file is licensed", "licensed"), ("version", ""),
    ("gnu general public license", "gpl"), ("creative commons attribution noncommercial", "cc by nc"), ("http", ""), ("https", ""), ("the", ""),
]
#: A copyright line, and what of it follows the holder.
COPYRIGHT = (r"(?m)^[ \t]*(?:\(c\)|©|copyright\b)[^\n]*?((?:\b(?:all rights reserved|licen[cs]ed under|released under|distributed under"
             r"|permission (?:is hereby|to use)|this (?:work|software|file) is)\b[^\n]*)?)$")


def spaced(phrase: str) -> str:
    """Words as they stand in a canonical text."""
    return "".join(f" {w} " for w in phrase.split())


def _spelled(words: Column) -> Column:
    """One spelling for equivalent ones, in a text of words between two spaces."""
    out = F.regexp_replace(F.replace(words, F.lit(" licence"), F.lit(" license")), " v([0-9])", " $1")
    return reduce(lambda t, pair: F.replace(t, F.lit(spaced(pair[0])), F.lit(spaced(pair[1]))), SPELLINGS, out)


def _own(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "$1")


def canonical(text: Column) -> Column:
    """Every word between two spaces of its own, so that spellings that follow each other share none."""
    return F.trim(_spelled(F.concat(F.lit(" "), F.regexp_replace(_own(text), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))))


def canonical_lines(text: Column) -> Column:
    """The canonical texts of all lines."""
    words = F.replace(F.regexp_replace(_own(text), r"[^\p{L}\p{N}\n]+", "  "), F.lit("\n"), F.lit(" \n "))
    return F.transform(F.split(_spelled(F.concat(F.lit(" "), words, F.lit(" "))), "\n"), lambda x: F.trim(x))


def known_licenses(spark: SparkSession, notices: list[tuple[str, str]] | DataFrame = LICENSES) -> DataFrame:
    """(digest, license, size), one row per digest, from (license, notice) rows or a table of them."""
    rows = notices if isinstance(notices, DataFrame) else spark.createDataFrame(notices, "license string, notice string")
    rows = rows.where(F.col("license").isNotNull()).select(canonical(F.col("notice")).alias("canon"), "license").where("canon <> ''")
    return rows.groupBy(F.sha2("canon", 256).alias("digest")).agg(F.min("license").alias("license"), F.max(F.length("canon")).alias("size"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, digest, license, line_licenses) per row: the digest of the whole canonical text,
    the licence that it is, if any, and the sorted distinct licences that are lines of it."""
    bounds = known.agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max("size").alias("most")).first()
    lines = F.filter(canonical_lines(F.col(text)), lambda x: F.length(x).between(bounds["least"] or 1, bounds["most"] or 0))
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(canonical(F.col(text)), 256).alias("digest"),
                       F.array_distinct(F.transform(lines, lambda x: F.sha2(x, 256))).alias("lines"))
    none = F.array().cast("array<string>")
    if bounds["n"] <= MOST_KNOWN:
        listed = F.create_map(*[F.lit(x) for r in known.collect() for x in (r["digest"], r["license"])]) if bounds["n"] \
            else F.create_map().cast("map<string,string>")
        found = F.filter(F.transform("lines", lambda d: F.try_element_at(listed, d)), lambda x: x.isNotNull())
        rows = rows.join(F.broadcast(known.select("digest", "license")), "digest", "left").withColumn("found", found)
    else:
        # A row's number is fixed once the rows are kept.
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
        side = known.select("digest", "license")
        found = rows.select("row", F.explode("lines").alias("digest")).join(side, "digest") \
                    .groupBy("row").agg(F.collect_set("license").alias("found"))
        rows = rows.join(side, "digest", "left").join(found, "row", "left")
    return rows.select(F.col("id").alias(id_col), "digest", "license",
                       F.array_sort(F.array_distinct(F.coalesce("found", none))).alias("line_licenses"))
