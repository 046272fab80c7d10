import re
import textwrap

import pytest

from tidemark.llm import license_scan as L


def cut(text):
    """Sentences by single steps over the lines of a text."""
    text = re.sub("\r\n?|[\x0b\x0c\x85\u2028\u2029\x01]", "\n", (text or "").lower())
    lines = []
    for line in text.split("\n"):
        line = re.sub(r"^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|<!--|%+)[ \t]*", "", line)
        lines.append(re.sub(r"[ \t]*(?:\*+/|-->)[ \t]*$", "", line))
    text = re.sub(r"\n[ \t]*\n[ \t\n]*", "\x01", "\n".join(lines))
    text = re.sub(r"(^|[\n\x01])[ \t]*[(]?(?:[0-9]{1,2}|[a-z])[.)][ \t]+", "\x01", text)
    text = re.sub(r"([:;.])[ \n]+[(]?[0-9]{1,2}[.)][ \t]+", "\\1\x01", text)
    return re.sub(r"([.!?])[\")]*[ \t\n]+([^0-9 \t\n])", "\\1\x01\\2", text).split("\x01")


def normal(sentence):
    return re.sub("[^a-z0-9.]+", " ", sentence).strip(" .")


def brute(text):
    known = {s: i for i, s in L.SENTENCES}
    ids = []
    for sentence in cut(text):
        if normal(sentence) in known:
            ids.append(known[normal(sentence)])
        else:
            ids += [known[normal(x)] for x in sentence.split("\n") if normal(x) in known]
    at, names, left = 0, [], []
    while at < len(ids):
        for name, rule in L.RULES:
            if tuple(ids[at : at + len(rule)]) == rule:
                names.append(name)
                at += len(rule)
                break
        else:
            left.append(ids[at])
            at += 1
    return ids, names, left, any(n not in L.PERMISSIVE for n in names) or bool(left)


BODY = {}
for ident, sentence in L.SENTENCES:
    BODY.setdefault(ident, sentence.capitalize() + ".")
APACHE = " ".join(BODY[i] for i in ("apache2-notice", "apache2-comply", "apache2-obtain", "apache2-as-is", "apache2-see"))
TEXTS = [
    None, "", "Licensed under the Apache License, Version 2.0.", "words. Released under the MIT License.\nmore",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", APACHE,
    APACHE.replace(" ", "\n  "), BODY["apache2-see"], f"{BODY['mit-grant']}\n\n{BODY['mit-include']} unknown sentence. {BODY['mit-as-is']}",
    f"{BODY['mit-as-is']} {BODY['mit-grant']}", " ".join(BODY[i] for i in ("bsd-intro", "bsd-source", "bsd-binary", "bsd-names", "mit-notice")),
    " ".join(BODY[i] for i in ("bsd-intro", "bsd-source", "bsd-binary")), "the license is nice", "x " * 50_000 + ". Released under the MIT license!",
    "Released under the MIT License.\n" * 2000,
]


def test_matches_brute_force(spark, frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[2]), (2, TEXTS[3]), (2, TEXTS[3])]
    got = [(r.doc_id, list(r.sentences), list(r.licenses), list(r.left_over), r.restricted) for r in L.scan(frame(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(i, *brute(t)) for i, t in rows]))


def test_tables():
    names = {i for i, _ in L.SENTENCES}
    assert all(set(rule) <= names for _, rule in L.RULES)
    assert all(re.search(L.ANCHORS, s) for _, s in L.SENTENCES)
    assert all(s == normal(s) and cut(s + ".") == [s + "."] for _, s in L.SENTENCES)  # what the cutter itself would give
    seen = []  # a rule before one that begins it would never let the longer one match
    for _, rule in L.RULES:
        assert not any(rule[: len(s)] == s for s in seen)
        seen.append(rule)


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{names}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
APACHE_HEADER = """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""


def _gnu(what, name, ending):
    return f"""This {what} is free software{";" if "2" in ending else ":"} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{";" if "2" in ending else ","} either version {ending} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this {what}.  If not, see <https://www.gnu.org/licenses/>."""


GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
OFFICIAL = {
    "MIT": MIT, "BSD-2-Clause": _BSD.format(names=""), "BSD-3-Clause": _BSD.format(names=_NAMES), "Apache-2.0": APACHE_HEADER,
    "GPL-3.0-or-later": _gnu("program", GPL, "3"), "GPL-2.0-or-later": _gnu("program", GPL, "2"), "MPL-2.0": MPL,
    "LGPL-2.1-or-later": _gnu("library", LGPL, "2.1"), "LGPL-3.0-or-later": _gnu("library", LGPL, "3"), "AGPL-3.0-or-later": _gnu("program", AGPL, "3"),
}


def wrapped(text, width, mark):
    lines = [line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""])]
    body = "\n".join(f"{mark} {x}".rstrip() if mark else x for x in lines)
    return f"/*\n{body}\n */\nint main;" if mark == " *" else body


@pytest.mark.parametrize("width,mark", [(10_000, ""), (80, ""), (72, "#"), (60, " *"), (75, "//")])
def test_official_texts(frame, width, mark):
    rows = [(i, "Some words before it.\n\n" + wrapped(text, width, mark) + "\n\nand after") for i, text in enumerate(OFFICIAL.values())]
    rows += [(100 + i, text.replace("\n", "\r\n")) for i, (_, text) in enumerate(rows)]
    got = {r.doc_id: (list(r.licenses), r.restricted) for r in L.scan(frame(rows)).collect()}
    for i, name in enumerate(OFFICIAL):
        loose = [n for n in got[i][0] if n == name]
        assert loose == [name] == got[i][0] and got[100 + i] == got[i], (name, got[i])
        assert name not in L.PERMISSIVE or width == 0 or got[i][1] == bool([x for x in brute(rows[i][1])[2]])


def test_a_notice_on_a_line_of_its_own(frame):
    rows = [(1, "A heading without a stop\nReleased under the MIT License\nand more words"), (2, "x v. 2.0. Licensed under CC BY 4.0.")]
    got = {r.doc_id: list(r.licenses) for r in L.scan(frame(rows)).collect()}
    assert got == {1: ["MIT"], 2: ["CC-BY-4.0"]}


def test_empty_table(frame):
    assert L.scan(frame([])).count() == 0
