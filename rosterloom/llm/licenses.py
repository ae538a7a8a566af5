"""Licence scan: normalised passages against licence templates, by Dice over word bigrams.

Texts and templates are lower-cased and stripped of all but letters, digits and single spaces, and
compared as multisets of word bigrams: Dice is twice the shared bigrams over the sum of both sizes.
A passage is any run of words, wherever lines and paragraphs end; for each template the run with
the greatest Dice is found.  A run of n bigrams can only reach Dice d with a template of between
n d / (2 - d) and n (2 - d) / d bigrams, which bounds its length and the bigrams it must share, and
the best one begins and ends with shared bigrams, so only runs between these are scored.

Null and empty texts have no passage and no licence.  Ties go to the template that is named first.
Repeated rows are rows of the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read, slices

DICE = 0.8
#: Rounding must not rule out a passage that lies exactly on a bound.
SLACK = 1e-9
SLICE_BYTES = 4_000_000
OTHER = re.compile(r"[\W_]+")

# Notices as their licences word them.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version {0} of
the License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
http://mozilla.org/MPL/2.0/."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution. {0}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy
of the software and accompanying documentation covered by this license (the "Software") to use,
reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works
of the Software, and to permit third-parties to whom the Software is furnished to do so"""
LGPL = GPL.replace("This program", "This library").replace("GNU General", "GNU Lesser General")
AGPL = GPL.replace("GNU General", "GNU Affero General")
TEMPLATES = [
    ("MIT", MIT), ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC),
    ("Apache-2.0", APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-or-later", GPL.format(2)), ("GPL-3.0-or-later", GPL.format(3)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", MPL),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
                "or neighboring rights to this work."),
    ("BSD-3-Clause", BSD.format(BSD_3)), ("BSD-2-Clause", BSD.format("")),
    ("LGPL-2.1-or-later", LGPL.format("2.1")), ("LGPL-3.0-or-later", LGPL.format(3)),
    ("AGPL-3.0-or-later", AGPL.format(3)), ("Unlicense", UNLICENSE), ("Zlib", ZLIB),
    ("BSL-1.0", BOOST), ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
]


def normal(text: str) -> list[str]:
    return OTHER.sub(" ", text.lower()).split()


def bigrams(text: str) -> Counter:
    """The word bigrams of a normalised text; a single word counts as one."""
    words = normal(text)
    return Counter(zip(words, words[1:])) if len(words) != 1 else Counter([(words[0], "")])


def passages(text: str, known: Templates | None = None) -> set[str]:
    """The runs of words that are most like a template, for each that one may be like enough.

    Without templates these are the usual ones, and half the usual likeness is enough.
    """
    words = normal(text)
    known = known or Templates(TEMPLATES, DICE / 2)
    return {" ".join(words[a:b]) for a, b in known.runs(words)}


class Templates:
    def __init__(self, templates: list[tuple[str, str]], least: float) -> None:
        self.names = [name for name, _ in templates]
        self.own = [bigrams(text) for _, text in templates]
        self.sizes = [sum(b.values()) for b in self.own]
        self.least = least
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, own in enumerate(self.own):
            for b in own:
                self.holders.setdefault(b, []).append(i)
        self.low = min(self.sizes, default=0) * least / (2 - least) - SLACK
        self.high = max(self.sizes, default=0) * (2 - least) / least + SLACK

    def runs(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Begin and end of the run of words with the greatest Dice, for each template that
        reaches the least."""
        found: dict[int, list[int]] = {}
        for at, b in enumerate(zip(words, words[1:])):
            for i in self.holders.get(b, ()):
                found.setdefault(i, []).append(at)
        for i, hits in found.items():
            size, own = self.sizes[i], self.own[i]
            need = max(1, math.ceil(size * self.least / (2 - self.least) - SLACK))
            longest = math.floor(size * (2 - self.least) / self.least + SLACK)
            top, run = self.least - SLACK, None
            for k in range(len(hits) - need + 1):
                if hits[k + need - 1] - hits[k] >= longest:
                    continue
                shared, left = 0, dict(own)
                for at in hits[k:k + longest]:
                    n = at - hits[k] + 1
                    if n > longest:
                        break
                    b = words[at], words[at + 1]
                    if left[b]:
                        left[b] -= 1
                        shared += 1
                        if 2 * shared > top * (n + size):
                            top, run = 2 * shared / (n + size), (hits[k], at + 2)
                if top == 1:
                    break
            if run:
                yield run
        for at, word in enumerate(words):  # templates of a single word
            if (word, "") in self.holders:
                yield at, at + 1

    def best(self, passage: str) -> list[tuple[float, int]]:
        """(Dice, template) of all templates that reach the least Dice."""
        own = bigrams(passage)
        n = sum(own.values())
        if not self.low <= n <= self.high:
            return []
        shared: dict[int, int] = {}
        for b, count in own.items():
            for i in self.holders.get(b, ()):
                size = self.sizes[i]
                if size * self.least <= n * (2 - self.least) + SLACK and \
                        n * self.least <= size * (2 - self.least) + SLACK:
                    shared[i] = shared.get(i, 0) + min(count, self.own[i][b])
        scored = ((2 * s / (n + self.sizes[i]), i) for i, s in shared.items())
        return [x for x in scored if x[0] >= self.least]


def find(docs: DataFrame, keep: list[str], text: str = "text",
         templates: list[tuple[str, str]] | None = None, least: float = DICE) -> DataFrame:
    """The kept columns of every row, its best license and dice, and all licenses, sorted."""
    templates = TEMPLATES if templates is None else templates
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least)
        for part in slices(batches, "text", SLICE_BYTES):
            best, dice, all_ = [], [], []
            for text_ in part.column(len(keep)).to_pylist():
                found = [x for p in passages(text_ or "", known) for x in known.best(p)]
                top = max(found, key=lambda x: (x[0], -x[1]), default=None)
                best.append(known.names[top[1]] if top else None)
                dice.append(top[0] if top else None)
                all_.append(sorted({known.names[i] for _, i in found}))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(best, pa.string()),
                 pa.array(dice, pa.float64()), pa.array(all_, pa.list_(pa.string()))],
                [*part.schema.names[:len(keep)], "license", "dice", "licenses"])

    schema = "".join(f"k{i} {f.dataType.simpleString()}, "
                     for i, f in enumerate(chosen.schema.fields[:-1]))
    return chosen.mapInArrow(run, schema + "license string, dice double, licenses array<string>") \
        .withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = find(read(spark, folder, "documents", "doc_id", "text"), ["doc_id"])
    return found.withColumn("licenses", F.array_join("licenses", ","))
