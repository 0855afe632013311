"""Texts of known licences and notices, by SPDX identifier."""

from pathlib import Path

_HERE = Path(__file__).resolve().parent

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""

_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

#: Whole licences: (identifier, text).
LICENCES: list[tuple[str, str]] = [
    (
        "MIT",
        f"""MIT License

Copyright (c) <year> <holders>

{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_MIT_WARRANTY}""",
    ),
    (
        "MIT",
        f"""{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_MIT_WARRANTY}""",
    ),
    ("MIT-0", f"MIT No Attribution\n\nCopyright <year> <holders>\n\n{_MIT_GRANT}.\n\n{_MIT_WARRANTY}"),
    ("ISC", f"ISC License\n\nCopyright <year> <holders>\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("0BSD", f"Zero-Clause BSD\n\n{_ISC_GRANT}.\n\n{_ISC_WARRANTY}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_WARRANTY}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\nCopyright (c) <year>, <holders>\n\n{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    (
        "BSD-3-Clause",
        f"""BSD 3-Clause License

Copyright (c) <year>, <holders>

{_BSD_HEAD}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

{_BSD_TAIL}""",
    ),
    (
        "BSD-3-Clause",
        f"""{_BSD_HEAD}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

{_BSD_TAIL}""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "BSL-1.0",
        """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    ),
]


def from_folder(folder: str | Path) -> list[tuple[str, str]]:
    """Licences in a folder of files named by identifier (``MPL-2.0.txt``): each text, and its terms without an appendix.

    The terms end with the line END OF TERMS AND CONDITIONS, which may be left out as well.
    """
    known = []
    for path in sorted(Path(folder).glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, mark, _ = text.partition("END OF TERMS AND CONDITIONS")
        known += [(path.stem, t) for t in ([text, terms + mark, terms] if mark else [text])]
    return known


LICENCES += from_folder(_HERE / "known_texts")

#: Notices that are a line of their own: (identifier, text).
NOTICES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
]

#: Every identifier of the SPDX list (spdx-license-ids 3.0.23), deprecated ones included.
IDENTIFIERS = (_HERE / "spdx_identifiers.txt").read_text().split()

#: The header of Apache-2.0, by the lines it is usually broken into.
_APACHE_HEADER = [
    'Licensed under the Apache License, Version 2.0 (the "License");',
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "http://www.apache.org/licenses/LICENSE-2.0",
]

_NAMES = {
    "MIT": ["the MIT License"],
    "ISC": ["the ISC License"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0"],
    "MPL-1.1": ["the Mozilla Public License, version 1.1", "the Mozilla Public License 1.1"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
}
_GNU = [
    ("GPL", "the GNU General Public License", ("1.0", "2.0", "3.0")),
    ("LGPL", "the GNU Library General Public License", ("2.0",)),
    ("LGPL", "the GNU Lesser General Public License", ("2.1", "3.0")),
    ("AGPL", "the GNU Affero General Public License", ("3.0",)),
]
for _short, _name, _versions in _GNU:
    for _version in _versions:
        for _said in dict.fromkeys([_version.removesuffix(".0"), _version]):
            _NAMES.setdefault(f"{_short}-{_version}-only", []).extend(f"{_name}{v} {_said}{only}" for v in (", version", "") for only in ("", " only"))
            _NAMES.setdefault(f"{_short}-{_version}-or-later", []).extend(
                f"{_name}{v} {_said}{later}"
                for v in (", version", "")
                for later in (" or later", ", or any later version", ", or (at your option) any later version")
            )
_TERMS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
for _id in IDENTIFIERS:
    _kind, _, _version = _id.removeprefix("CC-").rpartition("-")
    if _id.startswith("CC-BY") and _version in ("1.0", "2.0", "2.5", "3.0", "4.0") and set(_kind.split("-")) <= set(_TERMS):
        _long = "-".join(_TERMS[t] for t in _kind.split("-"))
        _scope = " International" if _version == "4.0" else " Unported" if _version == "3.0" else ""
        _NAMES[_id] = [f"CC {_kind} {_version}", f"a Creative Commons {_long} {_version}{_scope} License", f"the Creative Commons {_long} {_version}{_scope} License"]

NOTICES += [("Apache-2.0", line) for line in _APACHE_HEADER]
NOTICES += [(i, f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS]
NOTICES += [
    (i, f"{how} {name}.")
    for i, names in _NAMES.items()
    for name in names
    for how in ("Released under", "Licensed under", "Distributed under", "This work is licensed under", "This file is licensed under")
]
NOTICES = list(dict.fromkeys(NOTICES))
