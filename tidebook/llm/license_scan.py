"""License scans: digests of canonical texts, hash-joined to those of known licences; DataFrame functions only."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import materialize

# Whole texts of short licences, and one-line notices, as their stewards publish them.
_PERMIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
TEXTS = (
    ("MIT", f"MIT License\n\nCopyright (c) <year> <copyright holders>\n\n{_PERMIT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_WARRANTY}"),
    ("MIT", f"{_PERMIT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\nCopyright (c) <year> <copyright holders>\n\n{_PERMIT}.\n\n{_WARRANTY}"),
    ("ISC", f"ISC License\n\nCopyright (c) <year> <copyright holders>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}{_BSD_NAME}{_BSD_TAIL}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
)
#: Spellings taken as equal, after lower case.
EQUIVALENT = (("licence", "license"), ("sub-license", "sublicense"), ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("http://", "https://"), ("&", " and "))
#: A line that only says who holds the copyright, or that all rights are reserved.
CLAIM = r"\n[ \t]*(copyright[ \t]*(\(c\)|©|[0-9<\[])|\(c\)[ \t]|©|all rights reserved\.?[ \t]*(\n|$))[^\n]*"
#: Where every known notice holds this, lines without it need no digest; else all lines get one.
NOTICE_MARK = "licen"


#: A licence is also known without what follows this: how to apply it.
TERMS_END = "END OF TERMS AND CONDITIONS"


@lru_cache(1)
def known_texts() -> tuple[tuple[str, str], ...]:
    """``TEXTS`` and the long licences of ``licenses``, each file named by its licence."""
    own = []
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, mark, _ = text.partition(TERMS_END)
        own += [(path.stem, text)] + [(path.stem, t) for t in (terms, terms + mark) if mark]
    return (*TEXTS, *own)


def canonical(text: Column) -> Column:
    """Lower case, no claim lines, equal spellings, and each run of other than letters and digits as one blank."""
    t = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), CLAIM, "\n")
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def license_table(spark: SparkSession, texts: tuple[tuple[str, str], ...] | None = None, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """``license, text, whole``: the known licences as a table; ``whole`` is true for full texts, false for one-line notices.

    ``texts`` are ``known_texts()`` if none are given."""
    rows = [(n, t, True) for n, t in (known_texts() if texts is None else texts)] + [(n, t, False) for n, t in notices]
    return spark.createDataFrame(rows, "license string, text string, whole boolean")


def known(licenses: DataFrame) -> DataFrame:
    """``known_digest, known_whole, known_license``: a row per distinct digest, the first licence by name if several share it."""
    rows = licenses.where("text is not null and license is not null").select("license", digest(F.col("text")).alias("known_digest"), F.coalesce("whole", F.lit(True)).alias("known_whole"))
    return rows.groupBy("known_digest", "known_whole").agg(F.min("license").alias("known_license"))


def scan(df: DataFrame, licenses: DataFrame | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per input row ``doc_id, digest, license, notices``.

    ``digest`` is that of the whole canonical text; ``license`` the licence that the text is, whole, or null;
    ``notices`` the licences of which a line is a known notice, in order, comma-joined, empty if none.
    ``licenses`` is a table as :func:`license_table` gives, of any size: it is written once, and both digests of whole
    texts and digests of lines are hash-joined to it.  A text is known again by its id and hash when its lines' finds
    come back; only texts with a find have a row there.
    Null and empty texts have the digest of the empty text and no licence; repeated rows each give a row; null ids are
    ids; an empty table gives none; very long lines are digested whole; other columns play no part.
    """
    spark = df.sparkSession
    table = materialize(known(license_table(spark) if licenses is None else licenses), "licenses")
    marked = not (license_table(spark) if licenses is None else licenses).where(~F.col("whole") & ~F.contains(canonical(F.col("text")), F.lit(NOTICE_MARK))).limit(1).count()
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("form", F.xxhash64("text"))
    lines = F.split("text", "\n")
    if marked:
        lines = F.filter(lines, lambda x: F.contains(F.lower(x), F.lit(NOTICE_MARK)))
    said = rows.select("doc_id", "form", F.explode(F.array_distinct(lines)).alias("line")).withColumn("line_digest", digest(F.col("line")))
    found = said.join(table.where("not known_whole"), F.col("line_digest") == F.col("known_digest")).groupBy(F.col("doc_id").alias("found_id"), F.col("form").alias("found_form"))
    found = found.agg(F.array_join(F.array_sort(F.collect_set("known_license")), ",").alias("found"))
    whole = table.where("known_whole")
    out = rows.select("doc_id", "form", digest(F.col("text")).alias("digest")).join(whole, F.col("digest") == F.col("known_digest"), "left")
    out = out.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("form") == F.col("found_form")), "left")
    return out.select("doc_id", "digest", F.col("known_license").alias("license"), F.coalesce("found", F.lit("")).alias("notices"))


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(t: str) -> str:
    e = f"regexp_replace(chr(10) || lower({t}), {_sql(CLAIM)}, chr(10), 'g')"
    for a, b in EQUIVALENT:
        e = f"replace({e}, {_sql(a)}, {_sql(b)})"
    return f"sha256(trim(regexp_replace({e}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '))"


def oracle() -> str:
    values = lambda pairs: ", ".join(f"({_sql(n)}, {_sql(t)})" for n, t in pairs)
    return f"""
WITH t AS (SELECT {_canonical_sql("x")} AS d, min(n) AS license FROM (VALUES {values(known_texts())}) v(n, x) GROUP BY 1),
n AS (SELECT {_canonical_sql("x")} AS d, min(n) AS license FROM (VALUES {values(NOTICES)}) v(n, x) GROUP BY 1),
r AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM r),
f AS (SELECT row_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM l JOIN n ON n.d = {_canonical_sql("line")} GROUP BY row_id)
SELECT doc_id, {_canonical_sql("text")} AS digest, t.license, coalesce(f.notices, '') AS notices
FROM r LEFT JOIN t ON t.d = {_canonical_sql("text")} LEFT JOIN f USING (row_id)
"""
