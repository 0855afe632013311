import pytest

from cartograin.llm.licence_texts import LICENCES, NOTICES, from_folder
from cartograin.llm.licences import licence_scan

from .conftest import HARD


def scan(frame):
    return {r.doc_id: r for r in licence_scan(frame).collect()}


MIT = next(t for name, t in LICENCES if name == "MIT")


def test_whole_texts_in_other_dress(documents):
    dressed = MIT.replace("<year> <holders>", "2019, 2021 Some One <one@example.org>").replace("sublicense", "sub-licence").upper().replace("\n", "\r\n")
    commented = "\n".join(f" * {line}" for line in MIT.splitlines())
    bsd = next(t for name, t in LICENCES if name == "BSD-3-Clause").replace("1. ", "- ").replace("2. ", "(b) ").replace("copyright holder", "copyright owner")
    got = scan(documents([(1, dressed), (2, commented), (3, bsd), (4, MIT + "\nAnd one more thing."), (5, MIT.replace("free of charge", "for money"))]))
    assert [got[i].licence for i in (1, 2, 3, 4, 5)] == ["MIT", "MIT", "BSD-3-Clause", None, None]
    assert got[1].digest == got[2].digest != got[4].digest


def test_every_known_text_is_found(documents):
    got = scan(documents([(i, t) for i, (_, t) in enumerate(LICENCES)] + [(100 + i, t) for i, (_, t) in enumerate(NOTICES)]))
    assert all(got[i].licence == name for i, (name, _) in enumerate(LICENCES))
    assert all(got[100 + i].notices == name for i, (name, _) in enumerate(NOTICES))


def test_digests_of_different_licences_differ(documents):
    got = scan(documents([(i, t) for i, (_, t) in enumerate(LICENCES)]))
    by_digest = {}
    for r in got.values():
        by_digest.setdefault(r.digest, set()).add(r.licence)
    assert all(len(v) == 1 for v in by_digest.values())


def test_notice_lines_are_entire_lines(documents):
    got = scan(documents([(1, "Prose.\n  released under the MIT licence!\nLicensed under CC BY-NC 4.0.\nMore."), (2, "It was Released under the MIT License. Truly."), (3, "Released under the MIT\nLicense.")]))
    assert [got[i].notices for i in (1, 2, 3)] == ["CC-BY-NC-4.0,MIT", "", ""]


def test_hard_texts(documents):
    rows = licence_scan(documents(HARD)).collect()
    assert len(rows) == len(HARD) and all(r.licence is None and r.notices == "" for r in rows)
    digests = {r.doc_id: r.digest for r in rows}
    assert digests[1] == digests[2] == digests[3] == digests[8]
    assert licence_scan(documents([]).limit(0)).count() == 0


def test_no_python_in_the_plan(documents):
    plan = licence_scan(documents([(1, "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("line", ["Copyright (c) 2020 X", "© 2001 Y Z", "All rights reserved.", "Portions Copyright 1999 A"])
def test_copyright_lines_do_not_count(documents, line):
    got = scan(documents([(1, f"{line}\n{MIT}"), (2, MIT)]))
    assert got[1].digest == got[2].digest


def test_entire_long_licences_and_their_bare_headers(documents):
    text = {}
    for name, t in LICENCES:
        text.setdefault(name, t)
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0"]
    header = (
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law"
    )
    rows = [(i, text[n].replace("\n", "\r\n")) for i, n in enumerate(names)] + [(50, text["Apache-2.0"].split("END OF TERMS")[0]), (51, header)]
    got = scan(documents(rows))
    assert all(len(text[n].split()) > 1000 and got[i].licence == n for i, n in enumerate(names))
    assert got[50].licence == "Apache-2.0" and (got[51].licence, got[51].notices) == (None, "Apache-2.0")


def test_notices_of_every_kind(documents):
    lines = {
        "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0-only",
        "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later",
        "# SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
        "/* SPDX-License-Identifier: ISC */": "ISC",
        "This work is licensed under the GNU General Public License, version 2 or later.": "GPL-2.0-or-later",
        "Licensed under the GNU Lesser General Public License, version 3, or (at your option) any later version.": "LGPL-3.0-or-later",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    }
    got = scan(documents([(i, f"Prose.\n{line}\nMore.") for i, line in enumerate(lines)]))
    assert [got[i].notices for i in range(len(lines))] == list(lines.values())


def test_texts_from_a_folder(documents, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Do as you like.\nEND OF TERMS AND CONDITIONS\nHow to apply")
    rows = [(1, "do as you like"), (2, "Do as you like! End of terms and conditions. How to apply"), (3, "do as")]
    got = {r.doc_id: r.licence for r in licence_scan(documents(rows), LICENCES + from_folder(tmp_path)).collect()}
    assert got == {1: "Own-1.0", 2: "Own-1.0", 3: None}
