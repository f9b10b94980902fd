"""License scans: lines, whole texts and windows of words against license templates.

Texts are normalised to lower-case words and compared with templates by the
Dice coefficient over distinct word bigrams.  A pair whose sizes differ too much
for the threshold is pruned before any bigram is compared.  Notices that are
wrapped over lines or stand inside a longer text are found by windows of
consecutive words: trimming a window to the template's first and last bigram in it
never lowers its Dice, so all windows that begin and end at one are all that count.
A window takes at most as many bigrams as the threshold allows, and runs of the template's
bigrams without enough of them ahead are skipped.  Two pointers with running counts of distinct
bigrams go through each run, so a text that repeats a license takes time by its length.  Everything is a column
expression on the row, so nothing is shuffled; the templates are part of the plan,
and their number is checked.

Defined results: a null or empty text has no license; the best match wins, ties
go to the first line, then to the template's name; a line with fewer than two
words has no bigram and matches nothing; the whole text counts as line -1, a window
as the line of its first word; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75
#: Templates are literals of the plan; more of them are refused.
MOST_TEMPLATES = 500

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_TERMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
_GPL_END = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."

#: Names, notices and, where they are short, whole texts of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", _GPL.format("Affero ", 3)),
    ("AGPL-3.0", f"{_GPL.format('Affero ', 3)} {_GPL_END.format('Affero ')}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", f"{_BSD_TERMS} {_BSD_END}"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_END}"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", _GPL.format("", 2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL.format("", 3)),
    ("GPL-3.0", f"{_GPL.format('', 3)} {_GPL_END.format('')} You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", _GPL.format("Lesser ", 3)),
    ("MIT", "Released under the MIT License."),
    ("MIT", f"{_MIT}."),
    ("MIT", f"{_MIT}, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)


def normalised(text: Column) -> Column:
    """Lower-case words with one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def words(text: Column) -> Column:
    return F.split(normalised(text), " ")


def _in_order(words: Column) -> Column:
    """Hashes of the bigrams of an array of words, one by one."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.xxhash64(a, b))


def bigrams(words: Column) -> Column:
    """Hashes of the distinct bigrams of an array of words."""
    return F.array_distinct(_in_order(words))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _line_at(text: Column, word: Column) -> Column:
    """The number of the line that holds a word of the text."""
    start = F.struct(F.lit(-1).alias("line"), F.lit(0).alias("seen"))

    def after(acc: Column, line: Column) -> Column:
        return F.struct((acc["line"] + 1).alias("line"), (acc["seen"] + F.size(F.array_remove(words(line), ""))).alias("seen"))

    return F.reduce(F.split(text, "\n"), start, lambda acc, line: F.when(acc["seen"] > word, acc).otherwise(after(acc, line)), lambda acc: acc["line"])


def _links(grams: Column) -> Column:
    """Of each bigram of a text, in order: its hash, and where the same one stands before (or -1) and after."""
    by_gram = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))

    def beside(own: Column, there: Column, none: int) -> Column:
        return F.when(there["gram"] == own["gram"], there["at"]).otherwise(F.lit(none))

    def linked(every: Column) -> Column:
        return F.transform(every, lambda x, j: F.struct(x["at"].alias("at"), x["gram"].alias("gram"), F.coalesce(beside(x, F.get(every, j - 1), -1), F.lit(-1)).alias("prev"), F.coalesce(beside(x, F.get(every, j + 1), 2**31 - 1), F.lit(2**31 - 1)).alias("next")))

    return F.array_sort(_let(by_gram, linked))


def _runs(own: Column, t: Column) -> Column:
    """Runs of neighbouring bigrams of a template, from and to, that may begin a window with enough of its bigrams."""
    apart = lambda a, b: F.coalesce(b["at"] - a["at"] != 1, F.lit(True))
    firsts = F.filter(F.transform(own, lambda h, k: F.when(apart(F.get(own, k - 1), h), F.struct(k.alias("k"), h["at"].alias("at")))), lambda x: x.isNotNull())
    lasts = F.filter(F.transform(own, lambda h, k: F.when(apart(h, F.get(own, k + 1)), h["at"])), lambda x: x.isNotNull())
    runs = F.zip_with(firsts, lasts, lambda x, y: F.struct(x["k"].alias("k"), x["at"].alias("from"), y.alias("to")))
    return F.filter(runs, lambda r: F.coalesce(F.get(own, r["k"] + t["need"] - 1)["at"] - r["to"] < t["span"], F.lit(False)))


def _best_of_runs(links: Column, t: Column, runs: Column) -> Column:
    """The best dice of the windows that begin in the runs, and the first start that has it.

    Two pointers go through each run: the end moves on by one bigram, and the start stays at the run's first
    until the window is as long as it may be, then follows.  Starts in between need not be tried: a window that
    begins after a neighbouring bigram of the template gets no worse if it begins there.  A bigram counts when it enters
    a window that does not hold it, and no longer when it leaves one that holds it once.
    """
    one = lambda condition: F.when(condition, 1).otherwise(0)

    def step(acc: Column, e: Column, run: Column) -> Column:
        start = F.greatest(run["from"], e - t["span"] + 1)
        leaving = F.get(links, F.when(e - t["span"] >= run["from"], e - t["span"]))
        entering = F.get(links, e)
        enters, leaves = entering["prev"] < start, F.coalesce(leaving["next"] >= e, F.lit(False))
        size = acc["size"] + one(enters) - one(leaves)
        both = acc["both"] + one(enters & F.array_contains(t["grams"], entering["gram"])) - one(leaves & F.array_contains(t["grams"], leaving["gram"]))
        return F.struct(size.alias("size"), both.alias("both"), start.alias("start"), acc["dice"].alias("dice"), acc["at"].alias("at"))

    def judged(acc: Column) -> Column:
        dice = 2.0 * acc["both"] / (acc["size"] + t["size"])
        better = dice > acc["dice"]
        return F.struct(acc["size"].alias("size"), acc["both"].alias("both"), acc["start"].alias("start"), F.when(better, dice).otherwise(acc["dice"]).alias("dice"), F.when(better, acc["start"]).otherwise(acc["at"]).alias("at"))

    def state(dice: Column, at: Column) -> Column:
        return F.struct(F.lit(0).alias("size"), F.lit(0).alias("both"), F.lit(0).alias("start"), dice.alias("dice"), at.alias("at"))

    def of_run(best: Column, run: Column) -> Column:
        ends = F.sequence(run["from"], F.least(F.size(links), run["to"] + t["span"]) - 1)
        return F.reduce(ends, state(best["dice"], best["at"]), lambda acc, e: _let(step(acc, e, run), judged))

    return F.reduce(runs, state(F.lit(0.0), F.lit(0)), of_run)


def _windows(text: Column, known: Sequence[tuple[str, list[int]]], threshold: float) -> Column:
    """Of each template, the best window of the text that meets the threshold: dice, first (minus the line), name."""
    ratio = threshold / (2 - threshold)
    # at least so many of its bigrams are in a window that matches, and at most so many bigrams are in it
    literal = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("size"), F.lit(max(1, math.ceil(len(g) * ratio - 1e-9))).alias("need"), F.lit(math.floor(len(g) / ratio + 1e-9)).alias("span"), F.array(*[F.lit(x).cast("long") for x in g]).alias("grams")) for name, g in known])
    every = sorted({x for _, g in known for x in g})
    nothing = F.array().cast("array<struct<dice:double,at:int,name:string>>")
    least = min(math.ceil(len(g) * ratio - 1e-9) for _, g in known)

    def met(links: Column, some: Column) -> Column:
        best = F.transform(some, lambda x: _let(_best_of_runs(links, x["t"], x["runs"]), lambda m: F.struct(m["dice"].alias("dice"), m["at"].alias("at"), x["t"]["name"].alias("name"))))
        return F.filter(best, lambda m: m["dice"] >= threshold)

    def of_hits(grams: Column, hits: Column) -> Column:
        def with_runs(t: Column) -> Column:
            own = F.filter(hits, lambda h: F.array_contains(t["grams"], h["gram"]))
            return _let(own, lambda own: F.struct(t.alias("t"), F.when(F.size(own) >= t["need"], _runs(own, t)).alias("runs")))

        some = F.filter(F.transform(literal, with_runs), lambda x: F.size(x["runs"]) > 0)
        found = lambda some: F.when(F.size(some) > 0, _let(_links(grams), lambda links: met(links, some))).otherwise(nothing)
        return F.when(F.size(hits) >= least, _let(some, found)).otherwise(nothing)

    def of_grams(grams: Column) -> Column:
        hits = F.filter(F.transform(grams, lambda g, i: F.when(g.isin(every), F.struct(i.alias("at"), g.alias("gram")))), lambda h: h.isNotNull())
        return _let(hits, lambda h: of_hits(grams, h))

    best = _let(_let(words(text), lambda w: _let(_in_order(w), of_grams)), lambda found: F.filter(found, lambda m: m["dice"] == F.array_max(F.transform(found, lambda x: x["dice"]))))
    return F.transform(best, lambda m: F.struct(m["dice"].alias("dice"), (-_line_at(text, m["at"])).alias("first"), m["name"].alias("name")))


def scan(docs: DataFrame, *, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the columns of ``docs``), license, dice and line; nulls without a match."""
    if not 0 < len(templates) <= MOST_TEMPLATES:
        raise ValueError(f"1 to {MOST_TEMPLATES} templates are supported")
    spark = docs.sparkSession
    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(notice).alias("notice")) for name, notice in templates])
    known = spark.range(1).select(F.inline(listed)).select("name", bigrams(words(F.col("notice"))).alias("grams")).collect()
    known = [(r["name"], sorted(r["grams"])) for r in known if r["grams"]]
    literal = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("size"), F.array(*[F.lit(x).cast("long") for x in g]).alias("grams")) for name, g in known])
    # Dice >= t needs sizes within t / (2 - t) of each other
    ratio = threshold / (2 - threshold)
    least, most = min(len(g) for _, g in known) * ratio, max(len(g) for _, g in known) / ratio

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.transform(F.split(whole, "\n"), lambda line, i: F.struct(i.alias("line"), line.alias("text")))
    units = F.when(F.instr(whole, "\n") > 0, F.concat(lines, F.array(F.struct(F.lit(-1).alias("line"), whole.alias("text"))))).otherwise(lines)
    # a unit of n words has at most n - 1 distinct bigrams, so short ones go early; long ones are judged by their bigrams
    units = F.filter(units, lambda u: F.length(u["text"]) > 2 * least)
    # step by step, as a lambda computes again whatever it names twice
    units = F.transform(units, lambda u: F.struct(u["line"].alias("line"), words(u["text"]).alias("words")))
    units = F.transform(units, lambda u: F.struct(u["line"].alias("line"), bigrams(u["words"]).alias("grams")))
    units = F.filter(units, lambda u: F.size(u["grams"]).between(least, most))

    def compared(u: Column) -> Column:
        near = F.filter(literal, lambda t: (F.size(u["grams"]) >= t["size"] * ratio) & (t["size"] >= F.size(u["grams"]) * ratio))
        return F.transform(near, lambda t: F.struct((2.0 * F.size(F.array_intersect(u["grams"], t["grams"])) / (F.size(u["grams"]) + t["size"])).alias("dice"), (-F.when(u["line"] < 0, F.lit(2**31 - 1)).otherwise(u["line"])).alias("first"), t["name"].alias("name")))

    found = F.concat(F.filter(F.flatten(F.transform("units", compared)), lambda m: m["dice"] >= threshold), F.col("windows"))

    def best_of(found: Column) -> Column:
        return F.reduce(found, F.get(found, F.lit(0)), lambda a, b: F.when((b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & ((b["first"] > a["first"]) | ((b["first"] == a["first"]) & (b["name"] < a["name"])))), b).otherwise(a))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), units.alias("units"), _windows(whole, known, threshold).alias("windows"))
    out = out.select("row", _let(found, best_of).alias("best"))
    line = F.when(F.col("best.first") == -(2**31 - 1), -1).otherwise(-F.col("best.first"))
    return out.select("row", F.col("best.name").alias("license"), F.round("best.dice", 9).alias("dice"), line.alias("line"))
