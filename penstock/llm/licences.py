"""Licence scans by canonical digest.

Texts are normalised in case, copyright lines, punctuation, blanks and equivalent spellings; the
digest of the whole normalised text is looked up among those of known licences. The known list is a
parameter; its size is bounded by the list, not by the documents, so the join moves no document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public texts of short licences and the usual one-line notices, without titles
# and copyright lines.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
}

# The right-hand spelling stands for both.
SPELLINGS = {
    "licence": "license",
    "licenc": "licens",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "behaviour": "behavior",
    "favour": "favor",
    "fulfil ": "fulfill ",
    "judgement": "judgment",
    "labour": "labor",
    "merchantibility": "merchantability",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "percent ": "per cent ",
    "sub license": "sublicense",
    "whilst": "while",
    "wilful": "willful",
}

COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|©|\(c\))[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The text in its canonical form. Lines that begin with a copyright mark go."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    plain = F.concat(F.trim(F.regexp_replace(plain, NOT_WORD, " ")), F.lit(" "))
    for other, usual in SPELLINGS.items():
        plain = F.replace(plain, F.lit(other), F.lit(usual))
    return F.trim(plain)


def known_licences(spark, texts: dict[str, str] | None = None) -> DataFrame:
    """(`licence`, `digest`) of the known texts; of equal ones the first name."""
    rows = list((KNOWN if texts is None else texts).items())
    frame = spark.createDataFrame(rows, "licence string, text string")
    return frame.groupBy(F.md5(canonical(F.col("text"))).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """`row` (the document), `canonical_chars`, `digest` of its canonical text, and `licence`, null
    where the text is not a known one.

    Null text counts as empty, whose digest no licence should have. Every row is looked up by
    itself: ties, repeated rows and null ids change nothing."""
    plain = docs.select(F.struct("*").alias("row"), canonical(F.coalesce("text", F.lit(""))).alias("plain"))
    digests = plain.select(
        "row", F.length("plain").cast("long").alias("canonical_chars"), F.md5("plain").alias("digest")
    )
    return digests.join(known, "digest", "left").select("row", "canonical_chars", "digest", "licence")


def _sql_canonical(text: str) -> str:
    plain = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '\\1', 'g')"
    plain = f"trim(regexp_replace({plain}, '{NOT_WORD}', ' ', 'g')) || ' '"
    for other, usual in SPELLINGS.items():
        plain = f"replace({plain}, '{other}', '{usual}')"
    return f"trim({plain})"


def scan_sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in KNOWN.items())
    return f"""
WITH known AS (
  SELECT md5({_sql_canonical("text")}) AS digest, min(licence) AS licence
  FROM (VALUES {quoted}) AS t(licence, text) GROUP BY 1),
plain AS (SELECT doc_id, {_sql_canonical("coalesce(text, '')")} AS p FROM documents)
SELECT doc_id, CAST(length(p) AS BIGINT) AS canonical_chars, md5(p) AS digest, licence
FROM plain LEFT JOIN known ON known.digest = md5(p)"""
