"""Licence scan by digests of canonical texts.

A text's canonical form has lower case only, no lines of copyright notices,
no punctuation, and one spelling of each equivalent word. Its SHA-256 is
looked up in a table of known licences with a hash join. Entire texts are
compared: the whole document, and each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import documents
from tripmart.llm.license_texts import DIGESTS, further
from tripmart.operators.joins import bounded_broadcast

# Words that licence-matching guidelines treat as equal (the
# first form becomes the second).
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("noncommercial", "non  commercial"), ("copyright  holder", "copyright  owner"),
    ("sublicence", "sublicense"), ("sub  license", "sublicense"), ("per  cent", "percent"), ("https", "http"),
]

# The texts of short licences, and notices that name one.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]

COPYRIGHT = r"(?m)^[^\n0-9A-Za-z©(]*(copyright +(\(c\)|©|[0-9]{4})|\(c\) *(copyright|[0-9]{4})|©)[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Canonical form: words between two blanks each, so that replacing one
    word leaves the blanks its neighbours need."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    out = F.concat(F.lit(" "), F.regexp_replace(out, OTHER, "  "), F.lit(" "))
    for word, same in EQUIVALENT:
        out = F.replace(out, F.lit(f" {word} "), F.lit(f" {same} "))
    return F.trim(out)


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None,
                   digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """license_id and digest of each known text; the first id of a digest.

    Without ``texts``, those of KNOWN and of ``license_texts``. A caller adds
    licences as texts, or as digests of canonical texts.
    """
    texts = [*KNOWN, *further(KNOWN)] if texts is None else texts
    given = spark.createDataFrame(texts, "license_id string, text string").select(
        "license_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"))
    more = spark.createDataFrame(digests, "license_id string, canonical_sha256 string")
    return given.unionByName(more).groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, unit, canonical_sha256, license_id.

    Unit 0 is the whole text, one row for each row of ``docs``, with a null
    license_id where it is no known licence. Units from 1 are lines; only
    those that are known licences are returned, and a text of one line has
    none. A null text has a null digest; empty texts have the digest of the
    empty string, which no licence has. Repeated rows are scanned each.
    """
    line = F.split("text", "\n")
    units = F.when(F.size(line) > 1, F.concat(F.array("text"), line)).otherwise(F.array("text"))
    rows = docs.select("doc_id", F.posexplode(units).alias("at", "unit_text"))
    rows = rows.select("doc_id", F.col("at").cast("long").alias("unit"),
                       F.sha2(canonical(F.col("unit_text")), 256).alias("canonical_sha256"))
    return (rows.join(bounded_broadcast(known), "canonical_sha256", "left")
            .where((F.col("unit") == 0) | F.col("license_id").isNotNull())
            .select("doc_id", "unit", "canonical_sha256", "license_id"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), known_licenses(spark))


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{COPYRIGHT}', '', 'g')"
    out = f"' ' || regexp_replace({out}, '{OTHER}', '  ', 'g') || ' '"
    for word, same in EQUIVALENT:
        out = f"replace({out}, ' {word} ', ' {same} ')"
    return f"trim({out}, ' ')"


_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
OP1_SQL = f"""
WITH known AS (
  SELECT sha256({_sql_canonical('text')}) AS canonical_sha256, min(license_id) AS license_id
  FROM (VALUES {_VALUES}) AS v(license_id, text) GROUP BY 1
), split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), units AS (
  SELECT doc_id, 0::BIGINT AS unit, text AS t FROM split
  UNION ALL
  SELECT doc_id, unnest(range(1, len(lines) + 1))::BIGINT, unnest(lines) FROM split WHERE len(lines) > 1
), hashed AS (SELECT doc_id, unit, sha256({_sql_canonical('t')}) AS canonical_sha256 FROM units)
SELECT doc_id, unit, canonical_sha256, license_id
FROM hashed LEFT JOIN known USING (canonical_sha256)
WHERE unit = 0 OR license_id IS NOT NULL
"""
