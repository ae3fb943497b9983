"""License scan: canonical digests of whole texts, looked up among known licences.

A text and each known licence are brought to one canonical form: lower case,
without copyright notices, everything but letters and digits to single spaces,
equivalent spellings made equal. The SHA-256 of that form is joined by hash. One
expression makes the form on both sides. DataFrame operations only.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spellings that licence texts use for the same thing, words with single spaces
EQUIVALENT = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("copyright owner", "copyright holder"),
    ("organisation", "organization"), ("favour", "favor"), ("per cent", "percent"), ("acknowledgement", "acknowledgment"), ("whilst", "while"), ("http ", "https "),
)
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
# notices that are part of licence texts, wherever a line is wrapped (a blank stands for anything between two words)
OWN_NOTICES = "|".join((
    "copyright (?:(?:c|©) )?(?:[0-9]{4} ){1,20}free software foundation inc", "copyright (?:(?:c|©) )?the regents of the university of california",
    "copyright (?:(?:c|©) )?yyyy name of copyright owner", "copyright (?:(?:c|©) )?(?:year|19yy|19xx) (?:your name|name of author)",
    "copyright (?:c|©) all rights reserved", "all rights reserved",
    "51 franklin st(?:reet)? fifth floor boston ma 02110 1301(?: usa)?", "59 temple place suite 330 boston ma 02111 1307(?: usa)?",
    "https? (?:www )?fsf org",
)).replace(" ", NOT_WORD)
# a notice line: after comment marks, copyright with (c), the sign, a year or a placeholder, or as the first word of a
# paragraph; and the lines right below it that go on with the next holder
_MARKS = r"[ \t\r/*#;%!<>|-]*"
COPYRIGHT_LINE = (
    rf"\n{_MARKS}(?:copyright[ \t:]*(?:\(c\)|©|&copy;|[0-9]{{4}}|[\[<{{(](?:year|yyyy))|©|\(c\)[ \t]*[0-9]{{4}}|\n{_MARKS}copyright[ \t:]+[^ \t\r\n])"
    rf"[^\n]*(?:\n{_MARKS}(?:copyright[ \t:]|\(c\)|©)[^\n]*){{0,99}}"
)

# fixed values: texts of licences and of the usual notices
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
FOLDER = "licenses"   # beside this file: whole texts, one file a licence, named by its id
# fixed values: usual title lines above a text
TITLES = {
    "MIT": ("MIT", "MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "Expat License", "MIT/Expat License"),
    "0BSD": ("0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD 0-Clause License", "Zero-Clause BSD (0BSD)"),
    "ISC": ("ISC", "ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC License (ISCL)"),
    "BSD-2-Clause": (
        "BSD-2-Clause", "BSD 2-Clause License", "The BSD 2-Clause License", "BSD-2-Clause License", "The 2-Clause BSD License", "2-Clause BSD License",
        'BSD 2-Clause "Simplified" License', 'The BSD 2-Clause "Simplified" License', "Simplified BSD License", "The Simplified BSD License",
        "FreeBSD License", "BSD License", "The BSD License",
    ),
    "BSD-3-Clause": (
        "BSD-3-Clause", "BSD 3-Clause License", "The BSD 3-Clause License", "BSD-3-Clause License", "The 3-Clause BSD License", "3-Clause BSD License",
        'BSD 3-Clause "New" or "Revised" License', 'The BSD 3-Clause "New" or "Revised" License', "New BSD License", "The New BSD License", "Modified BSD License",
        "Revised BSD License", "BSD License", "The BSD License",
    ),
    "Zlib": ("zlib", "zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib License (Zlib)"),
    "BSL-1.0": ("Boost Software License 1.0", "BSL-1.0"),
    "Unlicense": ("Unlicense", "The Unlicense", "Unlicense License"),
}


def _numberless(text: str) -> str:
    """The same conditions as a bulleted list."""
    return re.sub(r"(?m)^[ \t]*[1-3]\. ", "* ", text)


def _whole(license_id: str) -> tuple[str, ...]:
    """The file's text as it is and in its usual cuts: without the appendix that tells how to
    apply the licence, and of CC0 without the line above its title."""
    text = (files(__package__) / FOLDER / f"{license_id}.txt").read_text(encoding="utf-8")
    out = [text]
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    if end:
        out += [text[:end.end()], text[:end.start()]]
    if license_id == "CC0-1.0":
        out.append(text[text.index("CC0 1.0 Universal"):])
    return tuple(out)


def _titled(license_id: str, *bodies: str) -> tuple[str, ...]:
    return (*bodies, *(f"{title}\n\n{body}" for title in TITLES.get(license_id, ()) for body in bodies))


_BSD_2, _BSD_3, _BSD_REGENTS = _BSD_START + _BSD_END, _BSD_START + _BSD_THIRD + _BSD_END, _whole("BSD-3-Clause")[0]
_ISC = f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"
KNOWN = {
    "MIT": (*_titled("MIT", _MIT), "Released under the MIT License."),
    "0BSD": _titled("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_END}"),
    "ISC": _titled("ISC", _ISC, _ISC.replace("and/or distribute", "and distribute")),
    "BSD-2-Clause": _titled("BSD-2-Clause", _BSD_2, _numberless(_BSD_2)),
    "BSD-3-Clause": _titled("BSD-3-Clause", _BSD_3, _numberless(_BSD_3), _BSD_REGENTS, _numberless(_BSD_REGENTS)),
    "Zlib": _titled("Zlib", _ZLIB, _numberless(_ZLIB)),
    "Apache-2.0": (*_whole("Apache-2.0"), "Licensed under the Apache License, Version 2.0."),
    "GPL-3.0": (*_whole("GPL-3.0"), "This work is licensed under the GNU General Public License, version 3."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "BSL-1.0": _titled("BSL-1.0", *_whole("BSL-1.0")),
    "Unlicense": _titled("Unlicense", *_whole("Unlicense")),
} | {
    k: _whole(k)
    for k in ("GPL-1.0", "GPL-2.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "GFDL-1.2", "GFDL-1.3", "MPL-1.1", "MPL-2.0", "CC0-1.0", "Artistic-1.0-Perl")
}


def canonical(text: Column) -> Column:
    """The canonical form; null for null."""
    form = F.regexp_replace(F.concat(F.lit("\n\n"), F.lower(text)), OWN_NOTICES, " ")
    form = F.trim(F.regexp_replace(F.regexp_replace(form, COPYRIGHT_LINE, ""), NOT_WORD, " "))
    for spelling, same in EQUIVALENT:
        form = F.replace(form, F.lit(spelling), F.lit(same))
    return form


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``(digest, license_id)``, one row a digest (of licences with the same canonical form the smaller id)."""
    rows = spark.createDataFrame([(k, t) for k, texts in known.items() for t in texts], "license_id string, text string")
    found = rows.select(digest(F.col("text")), "license_id").orderBy(F.desc("license_id")).collect()  # a few hundred; the texts stay out of the plan
    return spark.createDataFrame(list(dict(map(tuple, found)).items()), "digest string, license_id string")


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, digest, license_id (null if the
    whole text is no known licence).

    A null text has a null digest and no licence; an empty one has the digest of the
    empty form and no licence. Repeated rows and rows without a doc_id stay. ``known``
    (digest, license_id) may be given instead of the built-in texts; it must have one
    row a digest. Spark decides by its size whether it is broadcast.
    """
    known = known if known is not None else known_digests(docs.sparkSession)
    marked = docs.select(F.col("doc_id").cast("long"), digest(F.col("text").cast("string")).alias("digest"))
    return marked.join(known.where("digest is not null"), "digest", "left").select("doc_id", "digest", "license_id")


def oracle(known=KNOWN) -> str:
    """DuckDB SQL for the same rows."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    form = f"regexp_replace(chr(10) || chr(10) || lower(text), {quoted(OWN_NOTICES)}, ' ', 'g')"
    form = f"trim(regexp_replace(regexp_replace({form}, {quoted(COPYRIGHT_LINE)}, '', 'g'), {quoted(NOT_WORD)}, ' ', 'g'))"
    for spelling, same in EQUIVALENT:
        form = f"replace({form}, {quoted(spelling)}, {quoted(same)})"
    sha = f"sha256({form})"
    values = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, texts in known.items() for t in texts)
    return f"""
WITH known AS (SELECT {sha} AS digest, min(id) AS license_id FROM (VALUES {values}) AS t(id, text) GROUP BY 1),
marked AS (SELECT doc_id, {sha} AS digest FROM documents)
SELECT doc_id, marked.digest, license_id FROM marked LEFT JOIN known USING (digest)
"""
