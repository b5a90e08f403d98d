"""License scans by canonical digest, DataFrame functions only.

A text is made canonical (case, punctuation and white space, copyright lines,
equivalent spellings) and its SHA-256 is looked up among the digests of known
licence texts, made canonical in the same way.  Entire texts are compared: the
whole document, and each of its lines as a text of its own, since notices
mostly stand on a line between others.  The full texts known by default are
MIT, ISC, Zlib, BSD-2-Clause, BSD-3-Clause, Apache-2.0, MPL-2.0, CC0-1.0,
GPL-2.0, GPL-3.0, LGPL-2.1 and LGPL-3.0, with and without their titles; others
are found by their notices only, or by a list that the caller gives.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import saved, text_or_empty
from tessera.llm.license_texts import with_dress

#: Spellings that count as equal, (variant, canonical). Stems hold inside words ...
STEMS = [
    ("licenc", "licens"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("dgement", "dgment"),
    ("merchantib", "merchantab"),
]
#: ... and these are whole words, which may stand on two lines.
PHRASES = [
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("cc by nc", "creative commons attribution noncommercial"),
]

#: Public licence texts and customary notices, by SPDX identifier.
KNOWN = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License v2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
]

#: A line that starts with a copyright statement ("Copyright (c) 2020 Someone", "(c) 2020 ...", "© 2020 ...").
COPYRIGHT_LINE = (
    r"(?md)^[^\p{L}\p{N}\n(©]*(?:copyright\b[^\n]*(?:\d{4}|\(c\)|©)|(?:\(c\)|©)\s*(?:copyright\s*)?\d{4})[^\n]*$"
)


EMPTY = hashlib.sha256(b"").hexdigest()


def _words(phrase: str) -> str:
    return " " + "  ".join(phrase.split()) + " "


def canonical_lines(text: Column) -> Column:
    """Canonical text with its line feeds: case, copyright lines, punctuation, stems.

    Every word gets a blank of its own on both sides, so that a plain
    replacement hits whole words only.
    """
    t = F.replace(F.replace(F.lower(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(F.regexp_replace(t, COPYRIGHT_LINE, " "), r"[^\p{L}\p{N}\n]+", "  ")
    for variant, one in STEMS:
        t = F.replace(t, F.lit(variant), F.lit(one))
    return F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" "))


def digest(lines: Column) -> Column:
    """SHA-256 of canonical lines taken as one text; null if nothing but punctuation is left."""
    t = F.regexp_replace(lines, r"\s+", "  ")
    for variant, one in PHRASES:
        t = F.replace(t, F.lit(_words(variant)), F.lit(_words(one)))
    return F.nullif(F.sha2(F.btrim(t).cast("binary"), 256), F.lit(EMPTY))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(digest, license_id)`` of the known texts; the list is a parameter and never grows with the data.

    Default: the notices of ``KNOWN`` and the full texts of :mod:`tessera.llm.license_texts`.
    """
    known = KNOWN + with_dress(KNOWN) if known is None else known
    rows = spark.createDataFrame(known, "license_id string, known string")
    return (
        rows.select("license_id", digest(canonical_lines(F.col("known"))).alias("digest"))
        .filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("license_id").alias("license_id"))
    )


def scan(
    docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id, text_digest, license_id, notice_ids``.

    ``license_id``: the licence that the entire text is, else null;
    ``notice_ids``: sorted ids of the licences that a line of it is, null if
    none (at most one per known licence).  Null and empty texts have a null
    digest and no notices.  Ids may repeat or be null; other columns are
    ignored; an empty table gives no rows.
    """
    # the known list does not grow with the data (one short row per licence), so it may be broadcast
    texts = F.broadcast(known_digests(docs.sparkSession, known))
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), canonical_lines(text).alias("lines")
    )
    # the texts are read and made canonical once; what follows works on digests
    digests = saved(
        rows.select(
            "id",
            "h",
            digest(F.col("lines")).alias("text_digest"),
            F.array_compact(
                F.transform(F.filter(F.split("lines", "\n"), lambda x: F.btrim(x) != ""), digest)
            ).alias("line_digests"),
        ),
        "license-digests",
    )
    whole = digests.drop("line_digests").join(texts.withColumnRenamed("digest", "text_digest"), "text_digest", "left")
    notices = (
        digests.select(F.col("id").alias("n_id"), F.col("h").alias("n_h"), F.explode("line_digests").alias("digest"))
        .join(texts, "digest")
        .groupBy("n_id", "n_h")
        .agg(F.sort_array(F.collect_set("license_id")).alias("notice_ids"))
    )
    return whole.join(notices, F.col("id").eqNullSafe(F.col("n_id")) & (F.col("h") == F.col("n_h")), "left").select(
        "id", "text_digest", "license_id", "notice_ids"
    )
