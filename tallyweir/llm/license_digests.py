"""License scans: whole texts, in canonical form, are looked up among the digests of known licences.

The canonical form is that of common matching guidelines: lower case, lines that hold only a copyright statement
left out, equivalent spellings made one, and everything but letters and digits turned into single blanks. The
SHA-256 of a document's canonical text is joined to the digests of the known texts. The same lookup is made for
every line that mentions a licence, as notices stand in a document as lines of their own.

The known table is fixed: the texts below and those of the folder ``licenses``, a few hundred rows, so it may be broadcast. Any other table of
``license`` and ``text`` can be given, and is joined by hash whatever its size.

Defined results: a null text has the digest of the empty text and no licence; an empty known table finds nothing;
known texts with equal canonical forms are reported under the smallest name.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.llm.literals import literal_table
from tallyweir.session import broadcast_if_small, materialize

# Equivalent spellings, each pair as (pattern, replacement), applied in this order to plain words.
SPELLINGS = [
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("fulfilment", "fulfillment"),
    ("merchantibility", "merchantability"),
    ("whilst", "while"),
    ("per ?cent", "percent"),
    ("copyright holders?", "copyright holder"),
    ("https? ", ""),
]

# Texts of licences and of the notices by which files refer to them.
_PERMISSION = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software."
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
KNOWN = [
    ("MIT", f"MIT License\n\nCopyright (c) the authors\n\n{_MIT_GRANT}\n\n{_PERMISSION}\n\n{_AS_IS}"),
    ("MIT", f"{_MIT_GRANT}\n\n{_PERMISSION}\n\n{_AS_IS}"),
    ("MIT-0", f"MIT No Attribution\n\n{_MIT_GRANT.replace(', subject to the following conditions:', '.')}\n\n{_AS_IS}"),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in "
            f"all copies.\n\n{_ISC_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
            f"{_ISC_WARRANTY}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_BSD_TERMS = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
]
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def _bsd(n_terms: int, mark: str) -> str:
    terms = [f"{mark.format(i + 1)} {t}" for i, t in enumerate(_BSD_TERMS[:n_terms])]
    return "\n\n".join([_BSD_GRANT, *terms, _BSD_AS_IS])


def _titled(license: str, titles: list[str], text: str) -> list[tuple[str, str]]:
    return [(license, text), *((license, f"{t}\n\nCopyright (c) the authors\n\n{text}") for t in titles)]


#: Files of whole texts, in the folder ``licenses``.
_FILES = {
    "Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
    "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
}
_END = "END OF TERMS AND CONDITIONS"


def _whole_texts() -> list[tuple[str, str]]:
    """The texts of the folder, each also without what stands behind its terms."""
    out = []
    for name, license in _FILES.items():
        text = files("tallyweir.llm").joinpath("licenses", f"{name}.txt").read_text("utf-8")
        out.append((license, text))
        if _END in text:
            out += [(license, text[: text.index(_END)]), (license, text[: text.index(_END)] + _END)]
    return out


#: Names of licences in notices; the GNU licences by name, number and long name.
_NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "zlib": ["zlib License"], "Unlicense": ["Unlicense"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"], "CC0-1.0": ["CC0 1.0"],
}
_GNU = [
    ("GPL", "2", "General Public License"), ("GPL", "3", "General Public License"),
    ("LGPL", "2.1", "Lesser General Public License"), ("LGPL", "3", "Lesser General Public License"),
    ("AGPL", "3", "Affero General Public License"),
]
_NOTICES = ["Licensed under the {}", "Released under the {}", "This project is licensed under the {}"]


def _notices() -> list[tuple[str, str]]:
    """One-line notices in usual wordings; the GNU licences also as "or later"."""
    named = [(license, name) for license, names in _NAMES.items() for name in names]
    named += [(license, f"SPDX {license}") for license in _NAMES]
    for short, number, long in _GNU:
        license = f"{short}-{number}" if "." in number else f"{short}-{number}.0"
        for kind, end in ((license, ""), (f"{license}-or-later", " or later")):
            named += [(kind, f"{n}{v}{number}{end}") for n in (f"GNU {long}", f"GNU {short}") for v in (" version ", " v")]
            named += [(kind, f"SPDX {kind}{'' if end else '-only'}")]
    spdx = [(license, name.replace("SPDX ", "SPDX-License-Identifier: ")) for license, name in named if name.startswith("SPDX ")]
    return spdx + [(license, n.format(name)) for license, name in named if not name.startswith("SPDX ") for n in _NOTICES]


def _canonical_texts() -> list[tuple[str, str]]:
    out = _whole_texts() + [("Apache-2.0", _APACHE_HEADER), ("MPL-2.0", _MPL_HEADER)]
    for mark in ("{}.", "*"):
        out += _titled("BSD-2-Clause", ["BSD 2-Clause License", "The 2-Clause BSD License"], _bsd(2, mark))
        out += _titled("BSD-3-Clause", ["BSD 3-Clause License", "The 3-Clause BSD License"], _bsd(3, mark))
    out += _titled("zlib", ["zlib License", "The zlib License"], _ZLIB)
    out += [("Unlicense", _UNLICENSE), ("Unlicense", f"{_UNLICENSE}\n\nFor more information, please refer to <https://unlicense.org/>")]
    return out


KNOWN += [row for row in dict.fromkeys(_canonical_texts() + _notices()) if row not in set(KNOWN)]

#: Lines that begin with a copyright statement: the word with a mark or a year behind it, or a mark. A line of a
#: wrapped text that happens to begin with the word is none.
COPYRIGHT_LINE = r"(?:^|\n)[ \t]*(?:copyright[^\n]*(?:\(c\)|©|[0-9]{4})|\(c\)|©)[^\n]*"
_MENTIONS = r"(?i)licen[cs]"


def canonical(text: Column) -> Column:
    """The text in canonical form."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    plain = F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))
    for pattern, spelling in SPELLINGS:
        plain = F.regexp_replace(plain, pattern, spelling)
    return plain


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest`` and ``license`` of the known texts."""
    texts = literal_table(spark, KNOWN if known is None else known, ["license", "text"])
    return texts.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``digest``, ``license`` (of the whole text, else null) and ``notices``.

    ``notices`` holds the licences of the lines that are notices, sorted and joined by commas; empty without any.
    """
    table = broadcast_if_small(materialize(known_digests(docs.sparkSession) if known is None else known, "licences"))
    rows = docs.select("doc_id", "text", digest(F.col("text")).alias("digest"), F.xxhash64("text").alias("_hash"))
    whole = rows.join(table, "digest", "left").select("doc_id", "_hash", "digest", "license")
    lines = docs.filter(F.col("text").rlike(_MENTIONS)).select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), F.explode(F.split("text", "\n")).alias("line")
    )
    notices = (
        lines.filter(F.col("line").rlike(_MENTIONS))
        .select("_id", "_h", digest(F.col("line")).alias("digest"))
        .join(table, "digest")
        .groupBy("_id", "_h")
        .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
    )
    joined = whole.join(notices, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    return joined.select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def _duck_canonical(text: str) -> str:
    sql = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', ' ', 'g')"
    sql = rf"trim(regexp_replace({sql}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        sql = f"regexp_replace({sql}, '{pattern}', '{spelling}', 'g')"
    return sql


def oracle_sql() -> str:
    """The same in DuckDB's SQL."""
    values = ", ".join("('{}', '{}')".format(*(v.replace("'", "''") for v in row)) for row in KNOWN)
    return f"""
    WITH texts(license, text) AS (VALUES {values}),
    known AS (SELECT sha256({_duck_canonical("text")}) AS digest, min(license) AS license FROM texts GROUP BY 1),
    lines AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM documents),
    notices AS (
      SELECT doc_id, text, array_to_string(list_sort(list(DISTINCT license)), ',') AS notices
      FROM (SELECT doc_id, text, sha256({_duck_canonical("line")}) AS digest FROM lines
            WHERE regexp_matches(line, '{_MENTIONS}')) JOIN known USING (digest)
      GROUP BY doc_id, text)
    SELECT d.doc_id, d.digest, k.license, coalesce(n.notices, '') AS notices
    FROM (SELECT doc_id, text, sha256({_duck_canonical("text")}) AS digest FROM documents) d
    LEFT JOIN known k USING (digest)
    LEFT JOIN notices n ON n.doc_id IS NOT DISTINCT FROM d.doc_id AND n.text = d.text
    """
