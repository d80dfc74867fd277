"""Licence scans by Dice coefficient over word bigrams (operator 6).

A text is a sequence of normalised words; any run of them, wherever its lines break, is
compared with licence templates: twice the common bigrams over the sum of both. The best
run of a template begins and ends with a bigram of the template, since any other end only
adds to the sum. So runs are anchored at the places where the text holds bigrams of the
template. A Dice value of t needs sizes within t / (2 - t) of each other, which ends runs, and
leaves out templates of which a text holds fewer bigrams than that.
"""

from __future__ import annotations

import math
import os
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns

LEAST_DICE = 0.8
WORD = re.compile(r"\w+")

# Notices by which works state their licence, and the texts of short licences.
# ``read_templates`` adds the texts of long ones.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}

MATCH = T.StructType([T.StructField("license_id", T.StringType()), T.StructField("line", T.IntegerType()),
                      T.StructField("lines", T.IntegerType()), T.StructField("dice", T.DoubleType())])


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    """Twice the common bigrams, repeats included, over the sum of both sizes."""
    if len(a) > len(b):
        a, b = b, a
    size = sum(a.values()) + sum(b.values())
    return 2 * sum(min(n, b[g]) for g, n in a.items()) / size if size else 0.0


def read_templates(folder: str) -> dict[str, list[str]]:
    """Templates from a folder of licence texts on the driver: a file per licence, named by
    it (an ending is cut off). Give ``{**TEMPLATES, **read_templates(folder)}`` to ``licenses``."""
    out = {}
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            with open(path, encoding="utf-8", errors="replace") as f:
                out[os.path.splitext(name)[0] if name.endswith((".txt", ".md")) else name] = [f.read()]
    return out


class Templates:
    """Templates by their bigrams. Those of one word have no bigram and never match."""

    def __init__(self, named: dict[str, list[str]], least: float = LEAST_DICE):
        self.least = least
        made = [(name, bigrams(WORD.findall(t.lower()))) for name, texts in named.items() for t in texts]
        self.rows = [(name, own, sum(own.values())) for name, own in made if own]
        ratio = least / (2 - least)
        #: Bigrams that a run must share with a template, and bigrams it may have (with room for rounding).
        self.needs = [max(1, math.ceil(n * ratio - 1e-9)) for _, _, n in self.rows]
        self.most = [math.floor(n / ratio + 1e-9) if ratio else math.inf for _, _, n in self.rows]
        holders = defaultdict(list)
        for k, (_, own, _) in enumerate(self.rows):
            for g in own:
                holders[g].append(k)
        self.holders = dict(holders)

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(licence, first line, lines, Dice value) of each licence in the text: its best
        run of words, of equals the one of fewest words, then the first."""
        words, ends = [], []
        for line in (text or "").lower().split("\n"):
            words += WORD.findall(line)
            ends.append(len(words))
        pairs = list(zip(words, words[1:]))
        anchors = defaultdict(list)
        for i, own in enumerate(map(self.holders.get, pairs)):
            if own:
                for k in own:
                    anchors[k].append(i)
        best: dict[str, tuple[float, int, int]] = {}
        for k, at in anchors.items():
            name, template, n = self.rows[k]
            need, most = self.needs[k], self.most[k]
            for a in range(len(at) - need + 1):
                first = at[a]
                if at[a + need - 1] - first >= most:  # too few anchors within the longest run
                    continue
                seen, common = {}, 0
                for last in at[a:]:
                    size = last - first + 1
                    if size > most:
                        break
                    g = pairs[last]
                    seen[g] = seen.get(g, 0) + 1
                    if seen[g] > template[g]:
                        continue  # the run that ends before is better
                    common += 1
                    value = 2 * common / (size + n)
                    key = (value, -size, -first)
                    if value >= self.least and (name not in best or key > best[name]):
                        best[name] = key
        out = []
        for name, (value, size, first) in sorted(best.items()):
            top, bottom = bisect_left(ends, -first + 1), bisect_left(ends, -first - size + 1)
            out.append((name, top, bottom - top + 1, value))
        return out


def licenses(docs: DataFrame, named: dict[str, list[str]] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, license_id, line, lines, dice): one row per document and licence that it
    states, with the lines its best run of words begins in (counted from 0) and covers.

    Case, punctuation and line breaks do not matter, and a notice may stand inside a line.
    Of runs with one value the one of fewest words counts, then the first. Null and empty
    texts and an empty table give no rows; repeated rows give repeated results; columns
    other than doc_id and text are ignored, whatever their names. Of two licences that match
    the same text both are given, with their values.
    """
    templates = Templates(TEMPLATES if named is None else named, least)

    def run(texts: pa.Array) -> list[pa.Array]:
        found = [[dict(zip(MATCH.names, m)) for m in templates.scan(t.as_py())] for t in texts]
        kind = pa.list_(pa.struct([("license_id", pa.string()), ("line", pa.int32()), ("lines", pa.int32()),
                                   ("dice", pa.float64())]))
        return [pa.array(found, kind)]

    scanned = add_columns(docs, ["text"], [T.StructField("_found", T.ArrayType(MATCH))], run, keep=["doc_id"])
    return scanned.select("doc_id", F.explode("_found").alias("m")).select("doc_id", "m.*")
