from pathlib import Path

from tallyweir.llm import license_digests
from tests.llm.common import awkward, clashing, documents, empty

MIT = next(t for n, t in license_digests.KNOWN if n == "MIT" and "hereby granted" in t)


def found(docs):
    return {r["doc_id"]: (r["license"], r["notices"]) for r in license_digests.scan_licenses(docs).collect()}


def test_whole_texts_in_other_spellings(spark):
    variants = [
        MIT,
        "\n".join(x if "(c)" in x else x.upper().replace(" ", "\n  ") for x in MIT.split("\n")),
        MIT.replace("License", "Licence").replace("sublicense", "sub-license").replace('"', "“"),
        MIT.replace("Copyright (c) the authors", "Copyright © 2019-2024 Somebody Else <a@b.c>\n(c) 2025 Another"),
        MIT + " And one more condition.",
        MIT[: len(MIT) // 2],
        "Some text.\nReleased under the MIT licence\nlicensed under CC-BY-NC 4.0!\nLicensed under something else",
    ]
    rows = found(documents(spark, variants))
    assert [rows[i][0] for i in range(7)] == ["MIT"] * 4 + [None] * 3
    assert rows[6][1] == "CC-BY-NC-4.0,MIT"


def test_every_known_text_is_found(spark):
    rows = found(documents(spark, [t for _, t in license_digests.KNOWN]))
    assert [rows[i][0] for i in range(len(rows))] == [n for n, _ in license_digests.KNOWN]


def test_awkward_rows(spark):
    table = clashing(awkward(spark))
    rows = license_digests.scan_licenses(table).collect()
    assert len(rows) == table.count() and not any(r["license"] or r["notices"] for r in rows)
    assert license_digests.scan_licenses(empty(spark)).count() == 0
    none = license_digests.known_digests(spark, [])
    assert license_digests.scan_licenses(documents(spark, [MIT]), none).first()["license"] is None


def test_whole_texts_and_usual_notices_of_other_licenses(spark):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    texts = [(folder / f).read_text() for f in names]
    bsd = next(t for n, t in license_digests.KNOWN if n == "BSD-3-Clause" and "Neither the name" in t)
    texts += [bsd.replace("\"", "``").upper(), "Copyright (c) 2020, Somebody\nAll of it.\nlicensed under the GNU GPL v2 or later"]
    texts += ["  Released under the BSD 3-clause licence", "Licensed under the Apache License 2.0"]
    rows = found(documents(spark, texts))
    assert [rows[i][0] for i in range(6)] == [*names.values(), "BSD-3-Clause"]
    assert [rows[i][1] for i in (6, 7, 8)] == ["GPL-2.0-or-later", "BSD-3-Clause", "Apache-2.0"]
