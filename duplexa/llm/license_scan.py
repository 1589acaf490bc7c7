"""Licence texts by canonical digest: normalise, digest, and join on equality."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short licences and licence notices, as published.
LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}

# Spellings that count as the same, applied in this order to lower-case lines.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("https:", "http:"),
    ("&", " and "),
]
NOT_WORDS = r"[^\p{L}\p{N}]+"
#: Canonical lines that say whose rights they are, not which: not part of a licence text.
OWNER_LINES = r"^((copyright )?(c )?(copyright )?[0-9]{4}( .*)?|copyright c .*|all rights reserved)$"
#: Where the full texts lie, one a file named by its id.
TEXTS = Path(__file__).parent / "licenses"
#: Canonical lines before a licence's first own line that name it, its version and place, or its owner, with or without a year.
HEADER_LINES = (
    r"(the )?(mit|expat|x11|isc|0bsd|bsd|zlib|apache|mozilla|gnu|artistic|unlicense)( [\p{L}\p{N}]+){0,5} license( [\p{L}\p{N}]+){0,5}"
    r"|(the )?(unlicense|artistic license)|license|version [0-9 ]+[a-z]+ [0-9]{4}|http www apache org licenses|spdx license identifier .*"
    r"|copyright( [\p{L}\p{N}]+){1,12}|(51 franklin|59 temple|675 mass) .*"
)


def texts() -> list[tuple[str, str]]:
    """(license_id, text) of every known licence, full texts also without what follows their terms or the owner's line in it."""
    known = list(LICENSES.items())
    for file in sorted(TEXTS.glob("*.txt")):
        name, text = file.name.removesuffix(".txt").removesuffix("-Regents"), file.read_text("utf-8")
        known += [(name, text), (name, re.sub(r"(?m)^ *Copyright \[yyyy\].*$", "", text))]
        if end := re.search(r"END OF TERMS AND CONDITIONS", text):
            known += [(name, text[: end.end()]), (name, text[: end.start()])]
    return known


def canonical_line(line: Column) -> Column:
    out = F.lower(line)
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(F.regexp_replace(out, NOT_WORDS, " "))


def canonical_lines(text: Column) -> Column:
    """Lower-case words of each line, without punctuation, blank lines and copyright lines."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line)
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(OWNER_LINES))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def own_digest(lines: Column, whole: Column) -> Column:
    """The digest of canonical lines from a licence's first own line on; ``whole`` is that of all of them."""
    header = rf"^(?:(?:{HEADER_LINES})(?:\n|$))+"
    joined = F.array_join(lines, "\n")
    return F.when(joined.rlike(header), digest(F.replace(F.regexp_replace(joined, header, ""), F.lit("\n"), F.lit(" ")))).otherwise(whole)


def known_digests(spark, licenses: list[tuple[str, str]]) -> DataFrame:
    """(license_id, known_digest), a row for each licence text given."""
    rows = spark.createDataFrame(licenses, "license_id string, license_text string").select("license_id", canonical_lines(F.col("license_text")).alias("lines"))
    key = own_digest(F.col("lines"), digest(F.array_join("lines", " ")))
    return rows.groupBy(key.alias("known_digest")).agg(F.min("license_id").alias("license_id"))


def scan(documents: DataFrame, licenses: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_digest, license_id and notices of every document, by DataFrame functions alone.

    The digest is of the entire canonical text: one licence wrapped, spelt, punctuated or
    capitalised otherwise, or under another copyright line, has one digest. license_id is
    the known licence of the text after its header (HEADER_LINES), null if none; notices are the known licences that
    single lines are, sorted and joined by commas. ``licenses`` is the caller's table
    in place of ``texts()``, a row a licence, whose digests are broadcast; documents are not shuffled.

    Null and empty texts, and texts of nothing but punctuation or copyright lines, have
    the digest of the empty string and no licence. Repeated rows stay; other columns are
    ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    known = spark.createDataFrame(known_digests(spark, texts() if licenses is None else list(licenses.items())).collect(), "known_digest string, license_id string")
    by_digest = F.create_map(*(F.lit(x) for row in known.collect() for x in row))
    rows = documents.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col).cast("string")).alias("lines"))
    rows = rows.select("id", digest(F.array_join("lines", " ")).alias("text_digest"), F.transform("lines", digest).alias("line_digests"), "lines")
    rows = rows.withColumn("own_digest", own_digest(F.col("lines"), F.col("text_digest")))
    joined = rows.join(F.broadcast(known), F.col("own_digest") == F.col("known_digest"), "left")
    notices = F.array_sort(F.array_distinct(F.filter(F.transform("line_digests", lambda d: F.try_element_at(by_digest, d)), lambda x: x.isNotNull())))
    return joined.select(
        F.col("id").alias(id_col),
        "text_digest",
        F.when(F.col("own_digest") != digest(F.lit("")), F.col("license_id")).alias("license_id"),
        F.array_join(notices, ",").alias("notices"),
    )
