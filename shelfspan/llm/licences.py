"""Licence scans by sentences: known sentences get identifiers, rules match their sequence.

A text is cut into sentences, each is normalised, and those that equal a known
licence sentence get its identifier. Points, colons and semicolons before a
space end a sentence, as do lines; as licence files are often wrapped, the text
is cut a second time with only blank lines ending sentences. Marks of lists and
comments at the beginning of lines go. The known sentences are cut by the same
rules from the published texts below. A rule is an ordered list of identifiers;
it matches when they occur in this order, with any other text in between.
DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence texts and notices as they are published, without the lines that name an owner.
TEXTS = {
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "bsd-2-text": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "bsd-3-text": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "gpl-2.0-header": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}
# The licence that each text stands for.
LICENCES = {
    "apache-2.0-header": "Apache-2.0", "apache-2.0-notice": "Apache-2.0", "mit-text": "MIT", "mit-notice": "MIT", "mit-licensed": "MIT", "bsd-2-text": "BSD-2-Clause",
    "bsd-3-text": "BSD-3-Clause", "isc-text": "ISC", "gpl-3.0-header": "GPL-3.0-or-later", "gpl-2.0-header": "GPL-2.0-or-later", "gpl-3.0-notice": "GPL-3.0-only",
    "mpl-2.0-header": "MPL-2.0", "cc-by-nc-4.0-notice": "CC-BY-NC-4.0", "cc-by-nc-4.0-work": "CC-BY-NC-4.0", "cc-by-4.0-work": "CC-BY-4.0", "all-rights-reserved": "Proprietary",
}
#: Every text above holds one of these.
ANCHOR = r"(?i)licen|permission|copyright|rights|software|redistribut"
#: The cut, step by step: lines of marks alone, marks at the beginning of lines, ends of sentences within lines, blank lines, what isn't kept.
BARE = r"\n[ \t]*[#*/;|>\-]+[ \t]*\n"
MARKS = r"(^|\n)[ \t]*([#*/;|>\-]+|\(?[0-9a-z]{1,2}[.)])[ \t]+"
STOPS = r"[:;][ \t]*(\n|$)|[:;][ \t]+"
BLANK = r"\n[ \t]*\n[ \t\n]*"
DROP = r"[^a-z0-9.\-\n]+"


def cut_text(text: str) -> list[str]:
    """``sentences_of`` a wrapped text, for the texts above."""
    plain = re.sub(STOPS, r". \1", re.sub(MARKS, r"\1", re.sub(BARE, "\n\n", text.lower())))
    plain = re.sub(r" ?\n ?", " ", re.sub(DROP, " ", re.sub(BLANK, ". ", plain)))
    parts = [re.sub(r"^[ .\-]+|[ .\-]+$", "", s) for s in re.split(r"\n", re.sub(r"\.+ ", "\n", plain))]
    return [re.sub(r"[ .\-]* [ .\-]*", " ", s) for s in parts if s]


def _learned() -> tuple[dict[str, str], dict[str, tuple[str, list[str]]]]:
    """Identifiers of all sentences, and the rule of every text: its sentences in order."""
    names: dict[str, str] = {}
    rules = {}
    for rule, text in TEXTS.items():
        # Two words alone, such as a version number, tell nothing.
        wanted = [s for s in cut_text(text) if len(s.split()) > 2]
        for place, sentence in enumerate(wanted, 1):
            names.setdefault(sentence, rule if len(wanted) == 1 else f"{rule}-{place}")
        rules[rule] = (LICENCES[rule], [names[s] for s in wanted])
    return {name: sentence for sentence, name in names.items()}, rules


SENTENCES, RULES = _learned()


def within(short: list[str], long: list[str]) -> bool:
    """Whether all of ``short`` occurs in ``long`` in this order."""
    rest = iter(long)
    return all(x in rest for x in short)


def covering(rules: dict = RULES) -> dict[str, list[str]]:
    """For each rule the longer ones that hold it; where one of these matches the shorter says nothing."""
    return {r: [o for o, (_, longer) in rules.items() if len(longer) > len(wanted) and within(wanted, longer)] for r, (_, wanted) in rules.items()}


def sentences_of(text: Column, wrapped: bool = False) -> Column:
    """Normalised sentences of a text, in order.

    Lower case, without marks of lists and comments at line beginnings; a point,
    colon or semicolon before a space or line end ends a sentence, as a line
    does unless texts are ``wrapped``, where a blank line does; everything but
    letters, digits, points and hyphens becomes a space; spaces are squeezed,
    outer points and hyphens go.
    """
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), BARE, "\n\n"), MARKS, "$1"), STOPS, ". $1")
    plain = F.regexp_replace(plain, BLANK, ". ") if wrapped else plain
    plain = F.regexp_replace(plain, DROP, " ")
    plain = F.regexp_replace(plain, r" ?\n ?", " ") if wrapped else plain
    cut = F.split(F.regexp_replace(plain, r"\.+ ", "\n"), "\n")
    return F.transform(cut, lambda s: F.regexp_replace(F.regexp_replace(s, r"^[ .\-]+|[ .\-]+$", ""), r"[ .\-]* [ .\-]*", " "))


def known(sentences: dict[str, str] = SENTENCES) -> Column:
    """The identifiers by normalised sentence, as a constant map of bounded size."""
    pairs = [F.lit(x) for key, sentence in sentences.items() for x in (sentence, key)]
    return F.create_map(*pairs)


def in_order(found: Column, wanted: list[str]) -> Column:
    """Whether the identifiers occur in ``found`` in this order; one walk over the array."""
    steps = F.array(*[F.lit(w) for w in wanted])
    reached = F.aggregate(found, F.lit(0), lambda at, x: F.when(F.get(steps, at) == x, at + 1).otherwise(at))
    return reached == len(wanted)


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: dict = RULES) -> DataFrame:
    """``doc_id, sentence_ids, rule_ids, licences, n_sentences`` of every row.

    Null and empty texts have empty arrays. A rule that is part of a longer
    matching rule is not told. Equal rows give equal rows; no row moves.
    """
    look = known(sentences)

    def ids(wrapped: bool) -> Column:
        return F.filter(F.transform(sentences_of(F.col("text"), wrapped), lambda s: F.element_at(look, s)), lambda x: x.isNotNull())

    # Texts without any of these words hold no known sentence and are not cut up.
    some = F.coalesce(F.col("text").rlike(ANCHOR), F.lit(False))
    empty = F.array().cast("array<string>")
    found = docs.select("doc_id", *[F.when(some, ids(w)).otherwise(empty).alias(n) for n, w in (("_lines", False), ("_wrapped", True))])
    either = F.array(*[F.when(in_order(F.col("_lines"), w) | in_order(F.col("_wrapped"), w), F.lit(r)) for r, (_, w) in rules.items()])
    names = F.create_map(*[F.lit(x) for rule, (licence, _) in rules.items() for x in (rule, licence)])
    held = {r: longer for r, longer in covering(rules).items() if longer}
    over = F.create_map(*[x for r, longer in held.items() for x in (F.lit(r), F.array(*[F.lit(o) for o in longer]))]) if held else None
    matched = found.select(
        "doc_id",
        F.array_distinct(F.concat("_lines", "_wrapped")).alias("sentence_ids"),
        F.when(F.size("_lines") + F.size("_wrapped") > 0, F.filter(either, lambda x: x.isNotNull())).otherwise(empty).alias("rule_ids"),
    )
    if held:
        told = F.filter("rule_ids", lambda r: ~F.coalesce(F.arrays_overlap(F.element_at(over, r), F.col("rule_ids")), F.lit(False)))
        matched = matched.withColumn("rule_ids", told)
    return matched.withColumns({
        "licences": F.array_sort(F.array_distinct(F.transform("rule_ids", lambda r: F.element_at(names, r)))),
        "n_sentences": F.size("sentence_ids").cast("long"),
    })
