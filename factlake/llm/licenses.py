"""License scans by canonical digest lookup, SQL only.

A text is put into a canonical form: copyright lines removed, lower case,
everything but letters, digits and the dots of version numbers turned into single
spaces, equivalent spellings unified. The digest of an entire text in this form is
looked up among the digests of known licences by a hash join. Entire texts are
looked up in three grains: whole documents; single lines, which is how notices
stand in prose; and passages, that is as many words of a document as a known text
of several lines has, from where its first words stand, however its lines are
broken. The table of known licences is fixed and small, so it is broadcast: short
texts and notices as texts, long ones by the digests of their canonical forms.

Documents are read once. Only documents and lines that hold a word which some
known text needs (``hint``, derived from the table) are put into canonical form.

Defined cases: null and empty texts and blank lines match nothing; a document
found by several lines or passages is reported for each licence and grain once,
with their number, and rows that repeat an id are counted together; a null id is
reported as null; a passage that is the whole document is a document only; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that licence matching treats as one (from, to).
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("authorisation", "authorization"), ("favour", "favor"), ("honour", "honor"),
    ("organisation", "organization"), ("noncommercial", "non commercial"), ("whilst", "while"), ("wilful", "willful"), ("owner", "holder"), ("owners", "holders"), ("http", "https"), ("version", "v"),
)
#: A line that only names who holds the copyright; the flags are the engine's.
COPYRIGHT = "^[ \t#*/;.-]*(copyright[ \t]*([(]c[)]|©|[0-9]{4}|by[ \t]|[:,])|[(]c[)][ \t]|©|all rights reserved)[^\n]*"
#: Words of an anchor, by which the place of a long text in a document is found.
ANCHOR = 8

#: Texts and notices of common licences (identifier, text).
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""
_GNU = """{0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.
{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
#: Texts of several lines, with and without their titles.
TEXTS = (
    ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n" + ISC),
    ("BSD-2-Clause", BSD_2 + BSD_END), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2 + BSD_END), ("BSD-3-Clause", BSD_3 + BSD_END), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3 + BSD_END),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n" + ZLIB), ("BSL-1.0", BOOST), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n" + BOOST), ("Unlicense", UNLICENSE),
    ("Apache-2.0", APACHE_NOTICE), ("MPL-2.0", MPL_NOTICE), *((f"{k}GPL-{v}", _GNU.format("This program", f"GNU {long}General Public License", v.removesuffix(".0"))) for k, long, versions in (("", "", ("2.0", "3.0")), ("L", "Lesser ", ("2.1", "3.0")), ("A", "Affero ", ("3.0",))) for v in versions),
)
#: Long texts by their canonical forms: licence, first words, words, SHA-256.
LONG = (
    ("Apache-2.0", "apache license v 2 january 2004 https www", 1593, "3fc9fee3783335b97a8050aa99059644cf26d2268fc238b6a9d78565bd7133df"),
    ("Artistic-1.0", "the artistic license preamble the intent of this", 983, "4830b8c89ffe1c2d5a0734390441c41e05f2ab57847fd3e8612e425d9af2c2fe"),
    ("CC0-1.0", "creative commons legal code cc0 1 universal creative", 1087, "3512520c505ce06f9cdd0c2d0ccd7ee93b73d2eef1fa46e46cb19450f28f371a"),
    ("GFDL-1.2", "gnu free documentation license v 1.2 november 2002", 3313, "f50330bccea40bbaf492d4a6ced5f40f86ff3773a5fb5fe6aab84c06f3d9df98"),
    ("GFDL-1.3", "gnu free documentation license v 1.3 3 november", 3729, "03e43747a1674f88031b084c216a341aa4daaba7af352c8cb151b11e96b284fe"),
    ("GPL-1.0", "gnu general public license v 1 february 1989", 2068, "f8e70ea21a138fd9ef91986f541cd15c343f63ccf88e76965763a69d81c2f0ed"),
    ("GPL-2.0", "gnu general public license v 2 june 1991", 2976, "46a43c788678ddb58ef50ad5010a7886dc14ba24b9cd6fe1c319f9d191420cb6"),
    ("GPL-3.0", "gnu general public license v 3 29 june", 5684, "bc8bb69aa8f949d94a3db853dcd0b0d9d1eae303796d5c80cb9fd5c6dab3ce1e"),
    ("LGPL-2.0", "gnu library general public license v 2 june", 4200, "f917eb230a461b72c0d7845f5737ef74651abb0524547082a9645bc154d5ecd4"),
    ("LGPL-2.1", "gnu lesser general public license v 2.1 february", 4398, "35405ba83e962c005dbb8271dee3c2554f56809a0167f61ba85f85d8ecab69b2"),
    ("LGPL-3.0", "gnu lesser general public license v 3 29", 1231, "99c1a85dc9c673acfd6a330c4a68bd319185c3d6b8f4888157bf159e2ee60285"),
    ("MPL-1.1", "mozilla public license v 1.1 1 definitions 1", 3697, "33c70de3a851dca88ec10777afe0d12dfc0d821f4de06cfbafafd15281f52a6e"),
    ("MPL-2.0", "mozilla public license v 2 1 definitions 1.1", 2358, "05cf1e832c2d215a8715a6887c20a0ab8640fe9dcae1ca1faff7b8c5552d117f"),
)
_WORK = ("This work is licensed under the {}.", "This work is licensed under {}.", "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.", "Distributed under {}.", "Published under the {}.", "Published under {}.", "License: {}", "{}")
#: Names under which notices cite licences.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License, version 2.0", "GNU General Public License v2.0", "GPL 2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License, version 3.0", "GNU General Public License v3.0", "GPL 3.0", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL 2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL 3.0", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL 3.0", "AGPLv3"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0"),
    "Unlicense": ("Unlicense",),
}
#: Creative Commons: elements and their long names; versions 1.0 to 4.0.
ELEMENTS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def names() -> list[tuple[str, str]]:
    """(licence, name) under which notices cite licences."""
    out = {k: list(v) for k, v in NAMES.items()}
    for short, long in ELEMENTS.items():
        for v in VERSIONS:
            out[f"CC-{short}-{v}"] = [f"CC {short} {v}", f"CC-{short}-{v}", f"Creative Commons {long} {v}", f"Creative Commons {long} {v} International License", f"Creative Commons {long} {v} License"]
    return [(k, n) for k, v in out.items() for n in v]


def known() -> list[tuple[str, str]]:
    """(licence, text): texts, and every phrase with every name."""
    phrases = [(k, phrase.format(n)) for k, n in names() for phrase in _WORK[:-1]]
    return [*TEXTS, *phrases, *((k, f"SPDX-License-Identifier: {k}") for k in dict(names())), *((k, n) for k, n in names() if " " in n or "-" in n)]


def canonical(text: str) -> str:
    """The canonical form of a known text; ``Dialect.canonical`` is the same in SQL."""
    t = re.sub("(?im)" + COPYRIGHT, " ", text).lower().replace("~", " ")
    t = re.sub("[^a-z0-9~ß-ɏ]+", " ", re.sub("([0-9])[.]([0-9])", r"\1~\2", t)).replace("~", ".")
    t = " " + " ".join(dict(EQUIVALENT).get(w, w) for w in t.strip(" ").split(" ")) + " "
    return re.sub("([0-9])[.]0 ", r"\1 ", re.sub(" v([0-9])", r" v \1", t)).strip(" ")


def digests() -> dict[str, str]:
    """Licence by the digest of a known text."""
    out: dict[str, str] = {}
    for name, text in known():
        out.setdefault(hashlib.sha256(canonical(text).encode()).hexdigest(), name)
    return out | {digest: name for name, _, _, digest in LONG}


def passages() -> list[tuple[str, int]]:
    """(first words, words) of the texts of several lines."""
    own = {(" ".join(w[:ANCHOR]), len(w)) for w in (canonical(t).split(" ") for _, t in TEXTS) if len(w) > ANCHOR}
    return sorted(own | {(anchor, n) for _, anchor, n, _ in LONG})


def hint() -> str:
    """A pattern that every known text matches in all its spellings: a word that
    most of them hold, else the name that it cites, under which it is cited."""
    common, edge = "licen[cs]e|permission|redistribution", "[^a-z0-9]"
    words: dict[bool, set[str]] = {False: set(), True: set()}
    for _, text in known():
        w = canonical(text).split(" ")
        if not re.search(common, text.lower()):
            under = "under" in w
            words[under].add(next(x for x in w[w.index("under") + 1 if under else 0 :] if x != "the"))
    cited, bare = ("|".join(sorted(re.escape(x) for x in words[k])) for k in (True, False))
    return f"(?i){common}|(^|{edge})under{edge}+(the{edge}+)?({cited})({edge}|$)|(^|{edge})({bare})({edge}|$)"


class Dialect:
    """The expressions of the scan in the SQL of one engine."""

    newline, group, flags, split, size, array, join, each, part, concat = "'\\n'", "$", "(?imd)", "split", "size", "array", "array_join", "transform({0}, {1} -> {2})", "slice({0}, {1}, {2})", "concat({0})"

    def literal(self, text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def replaced(self, text: str, pattern: str, to: str) -> str:
        return f"regexp_replace({text}, {self.literal(pattern)}, {self.literal(to.replace('$', self.group))})"

    def matches(self, text: str, pattern: str) -> str:
        return f"regexp_like({text}, {self.literal(pattern)})"

    def chosen(self, items: str, name: str, condition: str) -> str:
        return f"filter({items}, {name} -> {condition})"

    def sha256(self, text: str) -> str:
        return f"sha2({text}, 256)"

    def canonical(self, text: str) -> str:
        t = f"replace(lower({self.replaced(text, self.flags + COPYRIGHT, ' ')}), '~', ' ')"
        t = f"replace({self.replaced(self.replaced(t, '([0-9])[.]([0-9])', '$1~$2'), '[^a-z0-9~ß-ɏ]+', ' ')}, '~', '.')"
        word = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EQUIVALENT) + " ELSE w END"
        words = self.each.format(f"{self.split}(trim({t}), ' ')", "w", word)
        return f"trim({self.replaced(self.replaced(f"' ' || {self.join}({words}, ' ') || ' '", ' v([0-9])', ' v $1'), '([0-9])[.]0 ', '$1 ')})"

    def found_lines(self, text: str) -> str:
        """Digests of the lines that may be known."""
        lines = self.chosen(f"{self.split}({text}, {self.newline})", "l", self.matches("l", hint()))
        return self.each.format(lines, "l", self.sha256(self.canonical("l")))

    def pieces(self, whole: str, anchor: str) -> str:
        return f"{self.split}(' ' || {whole} || ' ', {self.literal(f' {anchor} ')})"

    def found_passages(self, whole: str) -> str:
        """Digests of as many words as a known text has from its first words on."""
        out = []
        for anchor, n in passages():
            pieces = self.pieces(whole, anchor.replace(".", "[.]") if self.group == "$" else anchor)
            rest = f"{self.join}({self.part.format(pieces, 'i', f'{self.size}({pieces})')}, {self.literal(f' {anchor} ')})"
            words = f"{self.split}(trim({rest}), ' ')"
            text = f"{self.literal(anchor + ' ')} || {self.join}({self.part.format(words, 1, n - ANCHOR)}, ' ')"
            here = f"contains(' ' || {whole} || ' ', {self.literal(f' {anchor} ')}) AND {self.size}({self.split}({whole}, ' ')) > {n}"
            out.append(f"CASE WHEN {here} THEN {self.each.format(self.places(pieces), 'i', self.sha256(text))} ELSE {self.none()} END")
        return self.concat.format(", ".join(out))

    def places(self, pieces: str) -> str:
        return f"sequence(2, size({pieces}))"

    def none(self) -> str:
        return "CAST(array() AS array<string>)"


SPARK = Dialect()


def lookup(spark: SparkSession) -> DataFrame:
    """The fixed table (digest, license)."""
    rows = ", ".join(f"('{d}', {SPARK.literal(k)})" for d, k in digests().items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(digest, license)")


def license_scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(document, licence, grain): documents, passages and lines that are, entirely,
    a known licence or notice, with how often."""
    table = F.broadcast(lookup(docs.sparkSession))  # a fixed table of about two thousand rows
    d = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).where(F.expr(SPARK.matches("_text", hint())))
    d = d.withColumn("_whole", F.expr(SPARK.canonical("_text")))
    grain = lambda name, found: F.transform(found, lambda x: F.struct(F.lit(name).alias("grain"), x.alias("digest")))
    units = F.concat(grain("document", F.array(F.sha2("_whole", 256))), grain("line", F.expr(SPARK.found_lines("_text"))), grain("passage", F.expr(SPARK.found_passages("_whole"))))
    found = d.select("_id", F.explode(units).alias("_u")).select("_id", "_u.grain", "_u.digest").join(table, "digest")
    return found.groupBy("_id", "license", "grain").agg(F.count("*").alias("n_matches")).withColumnRenamed("_id", key)
