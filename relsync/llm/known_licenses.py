"""The known licence texts of operator 1: a reference table of common licences.

KNOWN has (licence, text), several rows a licence: its full text as published and with each
paragraph on one line, with its usual headings and without, with and without the part that
tells how to apply it; the notices that the licences themselves recommend; customary one-line
notices; and SPDX lines. A licence is named by its SPDX id without ``-only`` or ``-or-later``:
which of the two holds is not told apart. The bare name of a licence is no notice.

Full texts: Apache-2.0, BSD-2-Clause, BSD-3-Clause, CC0-1.0, GPL-2.0, GPL-3.0, ISC, LGPL-2.1,
LGPL-3.0, MIT, MPL-2.0, Unlicense (the long ones in ``license_texts``). AGPL-3.0 and the other
Creative Commons licences: notices and SPDX lines only.
"""

from __future__ import annotations

import re
from importlib.resources import files

# Public licence texts and customary notices, one per row.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
LISTED = [
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]
BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_ITEMS = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD_THIRD = "Neither the name of {0} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE {0} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {1} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_PARTIES = [("COPYRIGHT HOLDERS AND CONTRIBUTORS", f"COPYRIGHT {x} OR CONTRIBUTORS") for x in ("HOLDER", "HOLDERS", "OWNER")] + [("REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS")]
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE_TAIL = """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {0}://mozilla.org/MPL/2.0/."""
GNU_NOTICE = """{0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free Software Foundation{3}

{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2} for more details.

You should have received a copy of the GNU {2} along with this {4}. If not, see {5}."""
# Headings of the short texts.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
# SPDX ids of each licence, and the names that notices call it by.
NAMES = {
    "MIT": (["MIT"], ["MIT License", "MIT License (MIT)", "terms of the MIT License", "MIT"]),
    "ISC": (["ISC"], ["ISC License", "terms of the ISC License"]),
    "Apache-2.0": (["Apache-2.0"], ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "terms of the Apache License, Version 2.0", "Apache 2.0"]),
    "BSD-2-Clause": (["BSD-2-Clause"], ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"]),
    "BSD-3-Clause": (["BSD-3-Clause"], ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Revised BSD License", "BSD-3-Clause"]),
    "MPL-2.0": (["MPL-2.0"], ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "terms of the Mozilla Public License, v. 2.0", "MPL 2.0"]),
    "Unlicense": (["Unlicense"], ["Unlicense"]),
    "CC0-1.0": (["CC0-1.0"], ["CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 Universal License", "Creative Commons CC0 1.0 Universal License", "CC0"]),
}
for _id, _long, _short, _versions in (
    ("GPL", "GNU General Public License", "GPL", ("2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", "LGPL", ("2.1", "3.0")),
    ("AGPL", "GNU Affero General Public License", "AGPL", ("3.0",)),
):
    for _v in _versions:
        _n = _v.removesuffix(".0")
        _ids = [f"{_id}-{_v}{x}" for x in ("", "-only", "-or-later", "+")]
        _names = [f"{x}{_long}{y}" for x in ("", "terms of the ") for y in (f", version {_n}", f" version {_n}", f" v{_v}", f" v{_n}", f", version {_n} or later", f", version {_n} or any later version", f" {_v}")]
        NAMES[f"{_id}-{_v}"] = (_ids, [*_names, f"GNU {_short} v{_n}", f"{_short} v{_n}", f"{_short}v{_n}", f"{_short}-{_v}", f"{_short} {_v}"])
CREATIVE = {
    "CC-BY": "Attribution", "CC-BY-SA": "Attribution-ShareAlike", "CC-BY-NC": "Attribution-NonCommercial", "CC-BY-ND": "Attribution-NoDerivatives",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _id, _long in CREATIVE.items():
    for _v, _law in (("3.0", "Unported"), ("4.0", "International")):
        _full = [f"Creative Commons {_long} {_v}{x}{y}" for x in ("", f" {_law}") for y in ("", " License")]
        NAMES[f"{_id}-{_v}"] = ([f"{_id}-{_v}"], [*_full, f"{_id.replace('-', ' ', 1)} {_v}", f"{_id}-{_v}", f"{_id.replace('-', ' ', 1)} {_v} {_law}", f"{_id.replace('-', ' ', 1)} {_v} License"])
SUBJECTS = ["", "This work is ", "This software is ", "This project is ", "This program is ", "This file is ", "This code is "]
VERBS = ["Licensed under", "Released under", "Distributed under"]
GNU_END = "END OF TERMS AND CONDITIONS"


def _bsd() -> list[tuple[str, str]]:
    """The BSD texts: with numbered items or not, items apart or on following lines."""
    out = []
    thirds = ["the copyright holder", "the University", "the <organization>", "the copyright holders"]
    for name, items in [("BSD-2-Clause", BSD_ITEMS)] + [("BSD-3-Clause", [*BSD_ITEMS, BSD_THIRD.format(x)]) for x in thirds]:
        for mark in (lambda i: f"{i}. ", lambda i: "* "):
            for gap in ("\n\n", "\n"):
                body = gap.join(mark(i) + x for i, x in enumerate(items, 1))
                out += [(name, f"{BSD_HEAD}\n\n{body}\n\n{BSD_TAIL.format(*p)}") for p in BSD_PARTIES]
    return out


def _published() -> list[tuple[str, str]]:
    """The texts in ``license_texts``, also with paragraphs on one line, also up to their end mark."""
    out = []
    for f in sorted(files("relsync.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        if f.name.endswith(".txt"):
            text, name = f.read_text(encoding="utf-8"), f.name.removesuffix(".txt")
            forms = [text]
            if GNU_END in text:
                forms.append(text[: text.index(GNU_END) + len(GNU_END)])
            for form in forms:
                out += [(name, form), (name, re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", form))]
    return out


def _notices() -> list[tuple[str, str]]:
    out = [("Apache-2.0", f"{APACHE_NOTICE.replace('http', x)}\n\n{APACHE_TAIL}") for x in ("http", "https")]
    # the address stands in a paragraph of its own
    out += [("Apache-2.0", re.sub(r" (https?:)", r"\n\n\1", t)) for _, t in out]
    out += [("MPL-2.0", MPL_NOTICE.format("https")), ("Unlicense", "For more information, please refer to <https://unlicense.org>")]
    out += [("Unlicense", f"{UNLICENSE}\n\nFor more information, please refer to <{x}>") for x in ("https://unlicense.org", "https://unlicense.org/", "http://unlicense.org/")]
    for name, kind, n in (
        ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"),
    ):
        later = f"either version {n} of the License, or (at your option) any later version."
        for what, kind_of in (("This program", "program"), ("This library", "library"), ("This software", "software")):
            for colon in (":", ";"):
                for version in (f"; {later}", f", {later}", f", version {n} of the License.", f", version {n}."):
                    out += [(name, GNU_NOTICE.format(what, colon, kind, version, kind_of, url)) for url in ("<https://www.gnu.org/licenses/>", "https://www.gnu.org/licenses")]
    for name, long in CREATIVE.items():
        for v, law in (("3.0", "Unported"), ("4.0", "International")):
            first = f"This work is licensed under the Creative Commons {long} {v} {law} License."
            visit = f"To view a copy of this license, visit http://creativecommons.org/licenses/{name.removeprefix('CC-').lower()}/{v}/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
            out += [(f"{name}-{v}", f"{x} {visit}") for x in (first, first.replace("the Creative", "a Creative"))]
    for name, (ids, names) in NAMES.items():
        out += [(name, f"SPDX-License-Identifier: {x}") for x in ids]
        for subject in SUBJECTS:
            for verb in VERBS:
                said = subject + (verb.lower() if subject else verb)
                out += [(name, f"{said} {article}{x}.") for x in names for article in ("", "the ", "a ") if article != "a " or x.startswith("Creative")]
    return out


def _table() -> list[tuple[str, str]]:
    short = [("MIT", MIT), ("ISC", ISC), ("ISC", ISC.replace("and/or", "and")), ("Unlicense", UNLICENSE), *_bsd()]
    headed = [(name, f"{h}\n\n{text}") for name, text in short for h in HEADINGS[name]]
    return list(dict.fromkeys([*LISTED, *short, *headed, *_published(), *_notices()]))


#: (licence, text), without repetitions.
KNOWN = _table()
