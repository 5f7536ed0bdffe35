"""Licence scans: canonical digests of whole texts and lines, looked up by a hash join.

A text's canonical form has lower case, no copyright lines, one blank for all that isn't a
letter or digit, and one spelling of words that are spelled in several ways. Its sha256 is
joined with those of known licences. Whole documents are looked up among full licence texts,
and each of their lines (as a text of its own) among notices. DataFrame functions only.

Defined results: NULL and texts without a letter or digit have the digest of the empty text and
no licence; texts are taken whole; each row of the table is a row of the result, and rows that
repeat a doc_id share the notices found in any of them; if several known texts have one
digest, the first id counts; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Spellings = tuple[tuple[str, str], ...]
Known = tuple[tuple[str, str], ...] | DataFrame

# Spellings that count as equal, after SPDX's matching guidelines.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("catalogue", "catalog"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("noncommercial", "non commercial"),
    ("non-commercial", "non commercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https://", "http://"),
)
COPYRIGHT_LINE = r"^\s*[#*/;-]*\s*(copyright|\(c\)|©)[^a-z]*(\(c\)|©|[0-9]{4}|<year>|\[year\])|^\s*all rights reserved\.?\s*$"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted"""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.
"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution.
"""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License.
"""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either
in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org"""

# Public licence texts, and notices that name a licence.
TEXTS = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_WARRANTY),
    ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "/>"),
    ("Apache-2.0", _APACHE_HEADER),
)
# sha256 of the canonical forms of longer public licence texts, as the licences'
# stewards publish them. A change of ``canonical`` makes other digests.
DIGESTS = (
    ("Apache-2.0", "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "58b6ebdf2bd26f81dd551d8efda909bfbc8914ce77996a5c289c28616b91ceeb"),
    ("GFDL-1.3", "c4f8ea2b5247ab1ff721ce8255137250d4c14f50a0fb68c00fd793f496ced65e"),
    ("GPL-1.0", "0c28ca4dd58dd03edf3afbd7bcf01857c943e8fa9c124d4ca1eaefab216d6b0f"),
    ("GPL-2.0", "9c05d74a883c3b9a1f9c0850cd047eb9d7a3580bdda1f342f19570447984ab29"),
    ("GPL-3.0", "dfd1fc3abea1d3d88bd12db363da0b9cdb8731d6e379deb4759ae40fc0208bcb"),
    ("LGPL-2.0", "e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d"),
    ("LGPL-2.1", "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
)
# SPDX's ids. Those of the GNU licences are followed by "-only" or "-or-later".
SPDX_IDS = (
    "0BSD", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "EPL-2.0", "ISC",
    "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib",
)
GNU_IDS = ("AGPL-3.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
CC_TERMS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}


def _notices() -> tuple[tuple[str, str], ...]:
    """The lines that name a licence, by the rules of their kind."""
    out = [(i, f"SPDX-License-Identifier: {i}") for i in SPDX_IDS]
    out += [(i, f"SPDX-License-Identifier: {i}{end}") for i in GNU_IDS for end in ("", "-only", "-or-later")]
    for short, terms in CC_TERMS.items():
        made = f"CC-{short}-4.0"
        out += [(made, f"SPDX-License-Identifier: {made}"), (made, f"Licensed under CC {short} 4.0.")]
        out.append((made, f"This work is licensed under a Creative Commons {terms} 4.0 International License."))
    return tuple(out)


NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    *_notices(),
)
KNOWN_ROWS = 100_000


def canonical(text: Column) -> Column:
    """The form in which texts are compared."""
    lines = F.split(F.lower(F.coalesce(text, F.lit(""))), "\r?\n")
    return _plain(F.array_join(F.filter(lines, lambda x: ~x.rlike(COPYRIGHT_LINE)), "\n"), SPELLINGS)


def _canonical_line(line: Column, spellings: Spellings) -> Column:
    """The same of a single line, with some of the spellings."""
    low = F.lower(line)
    return F.when(low.rlike(COPYRIGHT_LINE), "").otherwise(_plain(low, spellings))


def _plain(kept: Column, spellings: Spellings) -> Column:
    for given, standard in spellings:
        kept = F.replace(kept, F.lit(given), F.lit(standard))
    return F.trim(F.regexp_replace(kept, r"[^\p{L}\p{N}]+", " "))


def _relevant(known: Known) -> Spellings:
    """The spellings that can make a line equal to a known text: those that one of them has.
    A line with any other word that has two spellings is equal to none, in either."""
    if isinstance(known, DataFrame):
        return SPELLINGS
    texts = [text.lower() for _, text in known]
    return tuple(pair for pair in SPELLINGS if any(word in text for word in pair for text in texts))


def _digests(spark: SparkSession, known: Known, digests: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(digest, license_id) of known texts and digests, the first id of each digest."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license_id string, text string")
    form = canonical(F.col("text"))
    rows = known.select(F.sha2(form, 256).alias("digest"), "license_id").where(F.length(form) > 0)
    if digests:
        rows = rows.unionByName(spark.createDataFrame(list(digests), "license_id string, digest string"))
    found = rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    # Broadcast as long as the table of known licences is small; else joined by a shuffle.
    return F.broadcast(found) if found.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS else found


def scan(
    df: DataFrame,
    texts: Known = TEXTS,
    notices: Known = NOTICES,
    doc_id: str = "doc_id",
    text: str = "text",
    digests: tuple[tuple[str, str], ...] = DIGESTS,
) -> DataFrame:
    """(doc_id, digest, license_id, notices): the sha256 of each document's canonical form, the
    licence whose text it is (or NULL), and the ids of the licences that its lines name, in
    order and joined by commas. ``digests`` are those of further texts' canonical forms."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"))
    whole = whole.join(_digests(spark, texts, digests), "digest", "left")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    form = _canonical_line(F.col("line"), _relevant(notices))
    lines = lines.select("doc_id", F.sha2(form, 256).alias("digest"))
    named = lines.join(_digests(spark, notices), "digest").groupBy("doc_id")
    named = named.agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    named = named.withColumnRenamed("doc_id", "_doc")
    return whole.join(named, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices")
    )


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    lines = f"regexp_split_to_array(lower(coalesce({text}, '')), '\\r?\\n')"
    kept = f"array_to_string([x for x in {lines} if not regexp_matches(x, {_quoted(COPYRIGHT_LINE)})], chr(10))"
    for given, standard in SPELLINGS:
        kept = f"replace({kept}, {_quoted(given)}, {_quoted(standard)})"
    return f"trim(regexp_replace({kept}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def scan_sql(
    texts: tuple[tuple[str, str], ...] = TEXTS,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    digests: tuple[tuple[str, str], ...] = DIGESTS,
) -> str:
    """The same in DuckDB's SQL over ``documents``."""

    def known(rows: tuple[tuple[str, str], ...], digests: tuple[tuple[str, str], ...] = ()) -> str:
        values = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in rows)
        made = f"""select sha256(form) as digest, license_id from (select license_id,
            {_canonical_sql('t')} as form from (values {values}) as k(license_id, t)) where form <> ''"""
        if digests:
            given = ", ".join(f"({_quoted(d)}, {_quoted(i)})" for i, d in digests)
            made += f" union all select * from (values {given}) as d(digest, license_id)"
        return f"(select digest, min(license_id) as license_id from ({made}) group by 1)"

    return f"""with w as (select doc_id, sha256({_canonical_sql('text')}) as digest from documents),
l as (select doc_id, sha256({_canonical_sql('line')}) as digest
    from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)),
n as (select doc_id, string_agg(distinct license_id, ',' order by license_id) as notices
    from l join {known(notices)} using (digest) group by 1)
select w.doc_id, w.digest, t.license_id, coalesce(n.notices, '') as notices
from w left join {known(texts, digests)} t using (digest) left join n on w.doc_id is not distinct from n.doc_id"""
