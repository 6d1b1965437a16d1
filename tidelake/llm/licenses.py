"""Licence recognition by sentences and rules.

Sentences that mention a licence's vocabulary are normalised and looked up among known licence sentences. A document thereby becomes a
sequence of sentence identifiers, against which the ordered rules are matched from left to right: at each place the first rule
that fits takes its identifiers, and where none fits the place is passed over. Everything is DataFrame functions; the sequence is a
string of identifiers and the rules one alternation, whose branches are tried in order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, as licences and notices print them, by identifier.
SENTENCES = {
    "MITref": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "MITgrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MITnotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MITnowarranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "MITnoliability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache2ref": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");", "SPDX-License-Identifier: Apache-2.0"],
    "Apache2use": ["you may not use this file except in compliance with the License.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "Apache2copy": ["You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "Apache2nowarranty": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "Apache2see": ["See the License for the specific language governing permissions and limitations under the License."],
    "GPL3ref": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "GPL3plus": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL2ref": ["Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"],
    "GPL2plus": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPLnowarranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "GPLsee": ["See the GNU General Public License for more details."],
    "GPLcopy": ["You should have received a copy of the GNU General Public License along with this program.", "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."],
    "AGPL3ref": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "AGPL3plus": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "AGPLsee": ["See the GNU Affero General Public License for more details."],
    "AGPLcopy": ["You should have received a copy of the GNU Affero General Public License along with this program."],
    "LGPL21ref": ["Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only"],
    "LGPL21plus": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "LGPL3plus": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "LGPLnowarranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "LGPLsee": ["See the GNU Lesser General Public License for more details."],
    "LGPLcopy": ["You should have received a copy of the GNU Lesser General Public License along with this library."],
    "LGPL3ref": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "BSDref2": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSDref3": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSDgrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSDsource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSDbinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSDendorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSDnowarranty": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "BSDnoliability": ["IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "EPL2ref": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "Licensed under the Eclipse Public License 2.0.", "SPDX-License-Identifier: EPL-2.0"],
    "BSL1ref": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "Zlibnowarranty": ["This software is provided 'as-is', without any express or implied warranty."],
    "Zlibgrant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "ISCgrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "ISCnowarranty": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "MPL2copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "MPL2ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "ISCref": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC"],
    "CCBYNC4ref": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CCBY4ref": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CCBYSA4ref": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0ref": ["Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Ordered rules, each a licence and the identifiers that state it; more specific rules come first.
RULES = [
    ("MIT", ["MITgrant", "MITnotice", "MITnowarranty", "MITnoliability"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("Apache-2.0", ["Apache2ref", "Apache2use", "Apache2copy", "Apache2nowarranty", "Apache2see"]),
    ("Apache-2.0", ["Apache2use", "Apache2copy", "Apache2nowarranty", "Apache2see"]),
    ("GPL-3.0-or-later", ["GPL3plus", "GPLnowarranty", "GPLsee", "GPLcopy"]),
    ("GPL-2.0-or-later", ["GPL2plus", "GPLnowarranty", "GPLsee", "GPLcopy"]),
    ("AGPL-3.0-or-later", ["AGPL3plus", "GPLnowarranty", "AGPLsee", "AGPLcopy"]),
    ("LGPL-2.1-or-later", ["LGPL21plus", "LGPLnowarranty", "LGPLsee", "LGPLcopy"]),
    ("LGPL-3.0-or-later", ["LGPL3plus", "LGPLnowarranty", "LGPLsee", "LGPLcopy"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse", "BSDnowarranty", "BSDnoliability"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDnowarranty", "BSDnoliability"]),
    ("ISC", ["ISCgrant", "ISCnowarranty"]),
    ("Zlib", ["Zlibnowarranty", "Zlibgrant"]),
    ("MPL-2.0", ["MPL2ref", "MPL2copy"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("MIT", ["MITref"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("Apache-2.0", ["Apache2use"]),
    ("GPL-3.0-or-later", ["GPL3plus"]),
    ("GPL-3.0-only", ["GPL3ref"]),
    ("GPL-2.0-or-later", ["GPL2plus"]),
    ("GPL-2.0-only", ["GPL2ref"]),
    ("AGPL-3.0-or-later", ["AGPL3plus"]),
    ("AGPL-3.0-only", ["AGPL3ref"]),
    ("LGPL-2.1-or-later", ["LGPL21plus"]),
    ("LGPL-2.1-only", ["LGPL21ref"]),
    ("LGPL-3.0-or-later", ["LGPL3plus"]),
    ("LGPL-3.0-only", ["LGPL3ref"]),
    ("EPL-2.0", ["EPL2ref"]),
    ("BSL-1.0", ["BSL1ref"]),
    ("ISC", ["ISCgrant"]),
    ("BSD-3-Clause", ["BSDref3"]),
    ("BSD-2-Clause", ["BSDref2"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("ISC", ["ISCref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("Unlicense", ["Unlicense"]),
]

# A sentence without any of these words, in any case, is not a licence's.
CUE = "licen[cs]e|copy of the mpl|copyright|permission|redistribut|warrant|free software|public domain|liable|conditions|endorse|released under"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(sentence: str) -> str:
    """Lower case, one space for each run of other characters than letters and digits, American spelling."""
    s = re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(_UPPER, _LOWER))).strip()
    return s.replace("licence", "license")


KNOWN = {normal(s): name for name, sentences in SENTENCES.items() for s in sentences}
#: Rules that state the same identifiers twice cannot both be meant; the alternation tells a match's rule by its text.
PATTERN = "|".join("".join(f"<{i}>" for i in ids) for _, ids in RULES)
LICENCE_OF = {"".join(f"<{i}>" for i in ids): name for name, ids in reversed(RULES)}


_CUT = r"[.!?:](?=[ \t\n\x0B\f\r])"


def _inner_marks() -> dict[str, list[str]]:
    """What looks like an end of a sentence inside a known one: the words before it, as an expression, and those that may come after."""
    spelt = lambda part: "[^a-z0-9]+".join(normal(part).replace("license", "licen[cs]e").split())
    out: dict[str, list[str]] = {}
    for s in (s for v in SENTENCES.values() for s in v):
        for m in re.finditer(_CUT, s):
            rests = out.setdefault(spelt(s[: m.start()]), [])
            if (rest := spelt(s[m.end() :])) not in rests:
                rests.append(rest)
    return out


def _kept_together() -> str:
    """Matches a known sentence that holds what looks like an end of one, up to the mark there; group 1 is that part."""
    # The run of other characters is taken whole, so no place is tried twice.
    each = [f"{k}[^a-z0-9]*?{_CUT}(?=[^a-z0-9]+(?:{'|'.join(v)})(?![a-z0-9]))".replace("[^a-z0-9]+", "[^a-z0-9]++") for k, v in _inner_marks().items()]
    return f"(?i)(?<![a-z0-9])({'|'.join(each)})"


def kept_together_sql(text: str) -> str:
    """The same in SQL without looking around: once for each such beginning, twice over, as two in a row share the character between them."""
    for _ in range(2):
        for k, v in _inner_marks().items():
            pattern = f"(?i)(^|[^a-z0-9])({k}[^a-z0-9]*?[.!?:])([ \\t\\n\\v\\f\\r][^a-z0-9]*(?:{'|'.join(v)})(?:[^a-z0-9]|$))"
            text = f"regexp_replace({text}, '{pattern}', '\\1\\2-\\3', 'g')"
    return text


KEPT_TOGETHER = _kept_together()


def _normalised(s: Column) -> Column:
    return F.replace(F.trim(F.regexp_replace(F.translate(s, _UPPER, _LOWER), "[^a-z0-9]+", " ")), F.lit("licence"), F.lit("license"))


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def scan(docs: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, text) with the licences it states.

    A sentence ends at a full stop, colon, exclamation or question mark before white space, or at a blank line, so it may run over
    several lines; one that is not known is taken line by line. Such a mark inside a known sentence ('SPDX-License-Identifier: MIT',
    'v. 2.0') ends none. Returns doc_id, n_known (known licence sentences), sentence_ids
    (identifiers in order, each in angle brackets; lines with licence vocabulary that are not known stand as <?>), licenses (names stated by
    the rules, sorted, once each, joined by commas). Null and empty texts, and texts without such vocabulary, have 0 and ''.
    Repeated rows, and rows with a null doc_id, stay; an empty table gives an empty result. Other columns are ignored, whatever their
    names; whole texts are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_cue = lambda s: s.rlike(f"(?i){CUE}")
    # A mark that ends no sentence gets a hyphen, which counts as a space among words, so that no white space follows.
    whole = F.regexp_replace(text, KEPT_TOGETHER, "$1-")
    sentences = F.filter(F.split(F.regexp_replace(whole, r"([.!?:])[ \t\n\x0B\f\r]+", "$1\n\n"), "\n[ \t\r]*\n"), has_cue)
    known = _literal_map(KNOWN)
    by_line = lambda s: F.transform(F.filter(F.split(s, "\n"), has_cue), lambda line: F.coalesce(known[_normalised(line)], F.lit("?")))
    ids = F.flatten(F.transform(sentences, lambda s: F.when(known[_normalised(s)].isNotNull(), F.array(known[_normalised(s)])).otherwise(by_line(s))))
    # Most texts have no cue at all and are not split.
    marked = docs.select("doc_id", F.when(has_cue(text), ids).otherwise(F.array().cast("array<string>")).alias("ids"))
    sequence = F.concat(F.lit(""), F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    named = marked.select("doc_id", F.size(F.filter("ids", lambda i: i != "?")).cast("long").alias("n_known"), sequence.alias("sentence_ids"))
    stated = F.transform(F.regexp_extract_all("sentence_ids", F.lit(f"({PATTERN})"), F.lit(1)), lambda m: _literal_map(LICENCE_OF)[m])
    return named.withColumn("licenses", F.array_join(F.array_sort(F.array_distinct(stated)), ","))
