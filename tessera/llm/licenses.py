"""Licence scans by canonical digest, in DataFrame functions only.

A text's canonical form drops copyright lines (those that begin with a notice and not
merely with the word) and a line "All rights reserved" next to one, lower-cases, turns every run of other
characters than letters and digits into a gap, and replaces equivalent spellings
word by word; its SHA-256 is compared with those of known licence texts, made the
same way. A document matches when its entire text is a licence, with or without the
licence's title lines and its appendix on how to apply it; a notice or a licence inside
a longer text doesn't match.

The known licences are a table of (license_id, text) that the caller may pass; its
digests are broadcast, so it must be a list of licences (``MOST_LICENSES``), not a
corpus. Documents are never shuffled.

Nulls: a null text is empty; an empty canonical form matches nothing. Null licence texts are
ignored; of licences with equal digests the least id counts. Repeated rows are
scanned alike. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_LICENSES = 10_000
#: The notices that the SQL knows.
COPYRIGHT = r"(?im)^[ \t*#/]*(?:copyright[ \t]*(?:\(c\)|©|:|[0-9])|\(c\)|©)[^\n]*$"
#: Comment signs and the like before a notice.
_MARK = r"(?:[ \t*#/;%!<>|'\".:\-\\{]|(?:rem|dnl|portions?(?: of [^\n]{0,80}?)?(?: are)?)[ \t])*+"
#: Words after "copyright" that go on with a sentence.
_SENTENCE = r"(?:and|or|of|in|is|are|as|for|to|by|on|at|under|with|that|which|may|shall|must|will|law|laws|licen[cs]es?|licen[cs]ed|holders?|owners?|ownership|notices?|statements?|disclaimers?|interests?|rights?|claims?|protection|protected|treaty|treaties|terms?|information|status|infringement|material|works?|permission|permissions|only|act|office)"
#: Words after "(c)" where it is the third item of a list.
_ITEM = r"(?:you|your|if|in|any|all|under|representations|notwithstanding|the licen[cs]es?|this|that|no)"
_ABOUT = rf"(?:copyright(?:ed by)?[ \t]*(?:\(c\)|©|:|[0-9]|[\[<{{])|copr\.[ \t]*[\p{{L}}\p{{N}}\[<{{]|copyright[ \t]+(?!{_SENTENCE}\b)(?-i:\p{{Lu}})|©|\(c\)(?![ \t]*{_ITEM}\b))"
_RESERVED = r"all rights reserved[^\p{L}\p{N}\n]*"
#: What scan() drops: lines with notices, and "All rights reserved" on the line before or after.
NOTICE = rf"(?im)^(?:{_MARK}{_RESERVED}\n\s*)?{_MARK}{_ABOUT}[^\n]*$(?:\n[\s*#/;%>|\-]*+{_RESERVED}$)?"
GAP = r"[^\p{L}\p{N}]+"

#: Equivalent spellings, left replaced by right.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("colour", "color"), ("defence", "defense"), ("favour", "favor"), ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organisations", "organizations"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("sublicence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
#: Public licence texts.
LICENSES = {
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ' + _AS_IS,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC,
    "BSD-2-Clause": _BSD_HEAD + _BSD,
    "BSD-3-Clause": _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}
#: Title lines before a licence that is known by its body.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "MIT", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "0BSD License", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "The New BSD License", "Modified BSD License", "Revised BSD License", "BSD License", "The BSD License", "BSD-3-Clause"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License"],
}
#: Whole texts with their titles, a file per licence. Read on the driver only.
TEXTS = Path(__file__).parent / "license_texts"
TERMS_END = "END OF TERMS AND CONDITIONS"


def _forms(name: str, text: str) -> list[str]:
    """The forms in which a licence is shipped: with each title, without appendix, with either scheme in links."""
    bodies = [text]
    if name == "BSL-1.0":
        bodies.append(text.split("\n", 1)[1])
    if TERMS_END in text:
        terms = text.split(TERMS_END)[0]
        bodies += [terms, terms + TERMS_END]
    forms = [f"{title}\n{body}" for title in ("", *TITLES.get(name, [])) for body in bodies]
    return sorted({x for f in forms for x in (f, f.replace("https://", "http://"), f.replace("http://", "https://"))})


def canonical(text: Column) -> Column:
    """The canonical form: words between single gaps of two spaces, one at each end."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), NOTICE, "")
    spaced = F.concat(F.lit("  "), F.regexp_replace(F.lower(plain), GAP, "  "), F.lit("  "))
    # Two spaces between words: replacements of neighbours don't share one.
    return F.trim(reduce(lambda c, s: F.replace(c, F.lit(f" {s[0]} "), F.lit(f" {s[1]} ")), SPELLINGS, spaced))


def known_licenses(spark: SparkSession) -> DataFrame:
    whole = {p.stem: p.read_text(encoding="utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    rows = [(name, form) for name, text in (LICENSES | whole).items() for form in _forms(name, text)]
    return spark.createDataFrame(rows, "license_id string, text string")


def scan(docs: DataFrame, licenses: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text_digest (of the canonical form), license_id (null if none)."""
    known = known_licenses(docs.sparkSession) if licenses is None else licenses.select("license_id", "text")
    digests = known.filter("license_id is not null and text is not null").select("license_id", canonical(F.col("text")).alias("body")).filter("body <> ''")
    digests = digests.groupBy(F.sha2("body", 256).alias("text_digest")).agg(F.min("license_id").alias("license_id"))
    if digests.limit(MOST_LICENSES + 1).count() <= MOST_LICENSES:
        digests = F.broadcast(digests)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(canonical(F.col(text_col)), 256).alias("text_digest"))
    return rows.join(digests, "text_digest", "left").select("doc_id", "text_digest", "license_id")


def oracle_sql() -> str:
    """The same over DuckDB's view documents, with the bodies in LICENSES and the notices of COPYRIGHT alone."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(text: str) -> str:
        out = rf"'  ' || regexp_replace(lower(regexp_replace(coalesce({text}, ''), '{COPYRIGHT}', '', 'g')), '{GAP}', '  ', 'g') || '  '"
        for a, b in SPELLINGS:
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"trim({out})"

    rows = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in LICENSES.items())
    return f"""
        WITH known(license_id, body) AS (VALUES {rows}),
             digests AS (SELECT sha256({form("body")}) AS text_digest, min(license_id) AS license_id FROM known GROUP BY 1),
             d AS (SELECT doc_id, sha256({form("text")}) AS text_digest FROM documents)
        SELECT doc_id, d.text_digest, license_id FROM d LEFT JOIN digests ON d.text_digest = digests.text_digest"""
