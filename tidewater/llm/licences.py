"""Licence texts by canonical digest. DataFrame functions only.

A text is brought into a canonical form: lower case, copyright lines dropped, punctuation and white space as single blanks,
equivalent spellings made one. Its SHA-256 is then looked up, by hash join, among the digests of known licences, which go
through the same functions. What is looked up is an entire text, or an entire line for one-line notices; no part is guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence texts and notices as their stewards publish them.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.\n\n"
)
_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
LICENCES = {
    "MIT": [_MIT, "MIT License\n\n" + _MIT, "Released under the MIT License.", "Licensed under the MIT License."],
    "ISC": [f"{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_AS_IS}", "Licensed under the ISC License."],
    "0BSD": [f"{_GRANT}.\n\n{_AS_IS}"],
    "BSD-2-Clause": [_BSD_2 + _BSD_END],
    "BSD-3-Clause": [_BSD_2 + _BSD_3 + _BSD_END],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
}
# Spellings that licence texts use for one another.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "organisation": "organization", "authorised": "authorized",
    "centre": "center", "favour": "favor", "honour": "honor", "labour": "labor", "merchantibility": "merchantability", "modelled": "modeled",
    "recognise": "recognize", "utilisation": "utilization", "acknowledgement": "acknowledgment", "analogue": "analog", "artefact": "artifact",
    "behaviour": "behavior", "fulfil": "fulfill", "programme": "program", "whilst": "while", "wilful": "willful",
}
PUNCTUATION = ".,;:!?\"'`()[]{}<>/\\|*#_=~^-‘’“”–—\t\r\x0b\x0c"
_COPYRIGHT = r"(?m)^[ #*/]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
_VARIANTS = r"\b(?:" + "|".join(SPELLINGS) + r")\b"


def canonical(text: Column) -> Column:
    """The canonical form, line by line; an empty line where nothing is left."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.when(t.rlike(r"copyright|\(c\)|\x{a9}|all rights reserved"), F.regexp_replace(t, _COPYRIGHT, "")).otherwise(t)
    t = F.translate(t, PUNCTUATION, " " * len(PUNCTUATION))
    spelled = t
    for variant, common in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, rf"\b{variant}\b", common)
    t = F.when(t.rlike(_VARIANTS), spelled).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, " {2,}", " "), "(?m)^ | $", "")


def _joined(canon: Column) -> Column:
    """The whole text as one line."""
    return F.trim(F.regexp_replace(canon, "[\\n ]+", " "))


def known_digests(spark: SparkSession, licences: dict[str, list[str]] | None = None) -> DataFrame:
    """``digest, licence, n_chars`` of the known texts; two licences with one digest keep the name that sorts first."""
    rows = [(name, text) for name, texts in (licences or LICENCES).items() for text in texts]
    known = spark.createDataFrame(rows, "licence string, text string").withColumn("canon", _joined(canonical(F.col("text"))))
    return known.groupBy(F.sha2("canon", 256).alias("digest")).agg(F.min("licence").alias("licence"), F.max(F.length("canon")).alias("n_chars"))


def licence_matches(docs: DataFrame, licences: dict[str, list[str]] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``digest`` of the entire text, ``licence`` it is (or NULL), and
    ``notices``: licences that an entire line states, in order, comma-joined (NULL if none).

    The known digests are a fixed list of the caller, so they are broadcast; the rows are not shuffled. NULL and empty texts
    have the digest of nothing and no licence. Equal rows give equal rows. Other columns are not read.
    """
    spark = docs.sparkSession
    known = known_digests(spark, licences)
    # the list of known digests is a parameter: as many rows as the caller gave texts
    rows = known.where("n_chars > 0").collect()
    longest, shortest = max((r.n_chars for r in rows), default=0), min((r.n_chars for r in rows), default=0)
    names = F.create_map(*[F.lit(x) for r in rows for x in (r.digest, r.licence)]) if rows else F.lit(None).cast("map<string,string>")
    canon = docs.select(F.col(doc_id).alias("doc_id"), canonical(F.col(text).cast("string")).alias("canon"))
    lines = F.filter(F.split("canon", "\n", -1), lambda x: F.length(x).between(shortest, longest))
    notices = F.filter(F.transform(lines, lambda x: F.try_element_at(names, F.sha2(x, 256))), lambda x: x.isNotNull())
    hashed = canon.select("doc_id", F.sha2(_joined(F.col("canon")), 256).alias("digest"), F.array_join(notices, ",").alias("notices"))
    found = hashed.join(F.broadcast(known.where("n_chars > 0").select("digest", "licence")), "digest", "left")
    return found.select("doc_id", "digest", "licence", F.when(F.col("notices") != "", F.col("notices")).alias("notices"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB."""
    q = lambda s: "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        t = f"lower(coalesce({x}, ''))"
        t = f"regexp_replace({t}, {q(_COPYRIGHT)}, '', 'g')"
        t = f"translate({t}, {q(PUNCTUATION)}, {q(' ' * len(PUNCTUATION))})"
        for variant, common in SPELLINGS.items():
            t = f"regexp_replace({t}, {q(rf'\b{variant}\b')}, {q(common)}, 'g')"
        t = f"regexp_replace({t}, ' {{2,}}', ' ', 'g')"
        return f"regexp_replace({t}, '(?m)^ | $', '', 'g')"

    def joined(x: str) -> str:
        return rf"trim(regexp_replace({x}, '[\n ]+', ' ', 'g'))"

    values = ", ".join(f"({q(name)}, {q(text)})" for name, texts in LICENCES.items() for text in texts)
    return f"""
WITH given(licence, text) AS (VALUES {values}),
known AS (SELECT sha256({joined(canon('text'))}) AS digest, min(licence) AS licence FROM given GROUP BY 1),
canon AS (SELECT row_number() OVER () AS r, doc_id, {canon('text')} AS canon FROM {table}),
lines AS (SELECT r, unnest(string_split(canon, chr(10))) AS line, generate_subscripts(string_split(canon, chr(10)), 1) AS i FROM canon),
notices AS (SELECT r, string_agg(licence, ',' ORDER BY i) AS notices FROM lines JOIN known ON sha256(line) = digest GROUP BY r)
SELECT doc_id, sha256({joined('canon')}) AS digest, known.licence, notices
FROM canon LEFT JOIN known ON known.digest = sha256({joined('canon')}) LEFT JOIN notices USING (r)
"""
