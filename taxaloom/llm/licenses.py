"""License scans by canonical digests.

A text is normalised (case, copyright lines, equivalent spellings, punctuation, white space) and its
digest is joined with the digests of known license texts. Whole documents are looked up, and each of their
lines, so that notices inside other text are found; both must match a known text entirely. Only lines
as long as some known text are digested and moved.

``text_digest`` and lines leave out every line that begins with "copyright". A wrapped license text has such lines
too, so a whole text is also looked up in a second form that leaves out statements of a year or a holder only.

Defined results: null and empty texts, and texts of copyright lines only, have no license; rows that
repeat an id are one document with the licenses of all its rows; a null id has one row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: equivalent spellings, each replaced by the second (fixed values)
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
    ("noninfringement", "non infringement"),
    ("https", "http"),
]

#: license texts and notices (fixed values; copyright lines are left out by the normalisation)
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("reserved", "All rights reserved."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "ISC",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
]

#: first lines that stand above a license text, or don't
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "Zlib": ["zlib License", "The zlib License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}


def full_texts() -> list[tuple[str, str]]:
    """Whole license texts: those of ``license_texts`` as published, and all that have titles with each of these, with
    and without the line that often follows a copyright line."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    out = [(p.stem, p.read_text(encoding="utf-8")) for p in files]
    out += [(name, text) for name, text in KNOWN if len(text) > 300]
    return [
        (name, "\n".join([*title, *reserved, text]))
        for name, text in out
        for title in [[], *([t] for t in TITLES.get(name, []))]
        for reserved in ([], ["All rights reserved."])
    ]


_COPYRIGHT = r"(?m)^[ \t]*(copyright|\(c\)|\x{00A9})[^\n]*$"
_NO_WORD = r"[^a-z0-9\x{0080}-\x{10FFFF}\n]+"


def _statement() -> str:
    """Pattern of a line that states a copyright: the sign, a year or a holder follows, not a word that follows in a
    license text ("copyright notice", "(c) You must")."""
    after: dict[str, set[str]] = {"copyright": set(), "(c)": set()}
    for _, text in full_texts():
        for start, word in re.findall(r"(copyright|\(c\))\s+([a-z]+)", text.lower()):
            after[start].add(word)
    words = {k: "|".join(sorted(v - {"copyright"})) for k, v in after.items()}
    more = r"[ \t:,]*(?:\(c\)|\x{00A9}|[0-9]{4}|[<\[{])"
    return (
        rf"(?m)^[ \t]*(?:\x{{00A9}}|copyright{more}|\(c\){more}|copyright[ \t]+(?!(?:{words['copyright']})\b)[^ \t\n]"
        rf"|\(c\)[ \t]+(?!(?:{words['(c)']})\b)[^ \t\n])[^\n]*$"
    )


def lined(text: Column, copyright_: str = _COPYRIGHT) -> Column:
    """The text in canonical form, its lines kept: words with one space between them."""
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.regexp_replace(F.regexp_replace(plain, "\r", "\n"), copyright_, "")
    plain = F.regexp_replace(plain, _NO_WORD, " ")
    for old, new in SPELLINGS:
        plain = F.regexp_replace(plain, rf"\b{old}\b", new)
    return plain


def squeezed(lines: Column) -> Column:
    """One line of what ``lined`` gives."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license, n_chars) of known texts, normalised as documents are, in both forms."""
    rows = spark.createDataFrame(KNOWN + full_texts() if known is None else known, "license string, text string")
    forms = F.array(squeezed(lined(F.col("text"))), squeezed(lined(F.col("text"), _statement())))
    rows = rows.select("license", F.explode(F.array_distinct(forms)).alias("canonical"))
    canonical = F.col("canonical")
    return rows.select(F.md5(canonical).alias("digest"), "license", F.length(canonical).alias("n_chars")).dropDuplicates(["digest"])


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_digest, license, line_licenses, n_lines) per id: the license that the whole text is, those that
    lines are (sorted, comma-joined) and the number of such lines."""
    known = known_digests(docs.sparkSession) if known is None else known
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the second form differs only where the first one leaves lines out
    second = F.when(text.rlike("(?i)" + _COPYRIGHT.replace("^", r"(?:^|\r)", 1)), F.md5(squeezed(lined(text, _statement()))))
    rows = docs.select(F.col(id_col).alias("id"), lined(text).alias("lines"), second.alias("second"))
    rows = rows.withColumn("whole", squeezed(F.col("lines")))
    lengths = sorted(r.n_chars for r in known.select("n_chars").distinct().collect())  # one row per known length
    lines = F.transform(F.split("lines", "\n"), lambda x: F.trim(F.regexp_replace(x, " +", " ")))
    units = rows.select(
        "id",
        F.md5("whole").alias("text_digest"),
        F.explode(
            F.concat(
                F.transform(
                    F.array_distinct(F.array(F.md5("whole"), F.coalesce("second", F.md5("whole")))),
                    lambda x: F.struct(F.lit(True).alias("all"), x.alias("digest")),
                ),
                F.transform(
                    F.filter(lines, lambda x: F.length(x).isin(lengths)),
                    lambda x: F.struct(F.lit(False).alias("all"), F.md5(x).alias("digest")),
                ),
            )
        ).alias("unit"),
    ).select("id", "text_digest", "unit.*")
    found = units.join(F.broadcast(known.select("digest", "license")), "digest", "left")  # the known texts only
    return found.groupBy("id").agg(
        F.min(F.when(F.col("all"), F.col("text_digest"))).alias("text_digest"),
        F.min(F.when(F.col("all"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("all"), F.col("license")))), ",").alias("line_licenses"),
        F.count(F.when(~F.col("all"), F.col("license"))).alias("n_lines"),
    ).withColumnRenamed("id", id_col)
