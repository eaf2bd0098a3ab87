"""License scans by the Dice coefficient over word bigrams, in DataFrame functions only.

Units of a text are its lines, and the whole text if it has several lines.  A unit is normalised
to lower-case words of a-z and 0-9; its bigrams are the distinct pairs of neighbouring words.
With A and B the bigrams of unit and template::

    dice = 2 |A and B| / (|A| + |B|)

As |A and B| is at most the smaller size, dice >= t needs |B| t / (2 - t) <= |A| <= |B| (2 - t) / t.
These bounds pick the candidate templates of every unit before anything is intersected; units
that no template's bounds admit go first, by their number of words.  And |A and B| >= |B| t / (2 - t)
means that a unit holds one of any |B| - that + 1 bigrams of the template (pigeonhole): one regular
expression over the longest bigrams of all templates, which are rare in other text, lets only those texts and
then those lines through that may match; nothing is split into words before.

Templates are a table of (license, text), by default the public notices below; it is the stated
query set, joined by bigram count; it is broadcast if it is small (``MAX_TEMPLATE_BYTES``).

``spans`` finds what lies inside a longer line or document, or goes over several lines.  A window is
a run of as many bigrams (repeats counted) as a template's bounds admit; each window of the whole
text that starts at a bigram of the template is compared, with the same Dice over distinct bigrams.
Hits of one license that overlap are one span, with the best window's template and dice; spans of
different licenses may overlap.  Its default templates are the notices and ``FULL_TEXTS``.  The
templates are held by every task.

Edge cases: null and empty texts have no units with bigrams and no matches; a unit or template
of fewer than two words has no bigrams and matches nothing; of templates with equal dice the one
with the smallest number wins; repeated rows repeat their matches; empty tables (of documents or
templates) give no matches; extra columns are left aside.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 0.8
MAX_TEMPLATE_BYTES = 4 << 20

#: Public licence notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("all-rights-reserved", "All rights reserved."),
)

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Whole licences whose notices above are only their opening paragraphs.
FULL_TEXTS = (
    ("MIT", _GRANT + ' The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)


def bigrams(of: Column) -> Column:
    return F.when(F.size(of) > 1, F.array_distinct(F.zip_with(F.slice(of, 1, F.size(of) - 1), F.slice(of, 2, F.size(of) - 1), lambda a, b: F.concat_ws(" ", a, b)))).otherwise(F.array().cast("array<string>"))


def openers(templates: list[list[str]], threshold: float) -> str:
    """A regular expression that finds, in lower-cased text, one of each template's bigrams that a match must hold some of.

    By the first letter of the first word, so that a place is left after a few comparisons."""
    chosen = set()
    for tb in templates:
        least = math.ceil(len(tb) * threshold / (2 - threshold) - 1e-9)
        chosen.update(sorted(tb, key=lambda g: (-len(g), g))[:len(tb) - max(1, least) + 1])
    by_letter: dict[str, list[str]] = {}
    for g in sorted(chosen):
        by_letter.setdefault(g[0], []).append(g[1:].replace(" ", "[^a-z0-9]++"))
    return "(?<![a-z0-9])(?:" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by_letter.items()) + ")(?![a-z0-9])"


def notices(spark) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(NOTICES)], "template int, license string, text string")


def scan(docs: DataFrame, templates: DataFrame | None = None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, line, license, template, dice, n_words): the best template of each unit; line 0 is the whole text."""
    templates = notices(docs.sparkSession) if templates is None else templates
    t = templates.select("template", "license", bigrams(words("text")).alias("tb")).where(F.size("tb") > 0)
    # bounds of |A| for each |B|, as whole numbers, and over all templates
    low, high = F.ceil(F.size("tb") * (threshold / (2 - threshold)) - 1e-9), F.floor(F.size("tb") * ((2 - threshold) / threshold) + 1e-9)
    t = t.withColumns({"low": low, "high": high})
    bounds = t.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if bounds.low is None:
        bounds = t.agg(F.lit(1).alias("low"), F.lit(0).alias("high")).first()
    spread = t.agg(F.coalesce(F.sum((F.col("high") - F.col("low") + 1) * F.octet_length(F.array_join("tb", " "))), F.lit(0)).alias("n")).first().n
    if 0 < spread <= MAX_TEMPLATE_BYTES:
        may_match = openers([r.tb for r in t.select("tb").collect()], threshold)
        docs = docs.where(F.lower(F.col(f"`{text}`")).rlike(may_match))
    else:
        may_match = None
    lines = F.split(F.col(f"`{text}`"), "\n")
    several = F.instr(F.col(f"`{text}`"), "\n") > 0
    units = docs.select(F.col(f"`{key}`").alias("__key"), F.posexplode(F.when(several, F.concat(F.array(F.col(f"`{text}`")), lines)).otherwise(F.concat(F.array(F.lit(None).cast("string")), lines))).alias("line", "unit"))
    units = units.where(F.lower("unit").rlike(may_match)) if may_match else units
    counted = units.where(F.col("unit").isNotNull()).select("__key", "line", words(F.col("unit")).alias("w")).where(F.size("w") > F.lit(bounds.low))
    # distinct bigrams never outnumber the words, but repeated words may make them fewer
    sized = counted.select("__key", "line", F.size("w").cast("long").alias("n_words"), bigrams(F.col("w")).alias("ub")).where(F.size("ub").between(bounds.low, bounds.high))
    sized = sized.withColumn("n", F.size("ub"))
    # the templates whose bounds admit each size, as one row a size
    by_size = t.select(F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))).alias("n"), F.struct("template", "license", "tb").alias("t")).groupBy("n").agg(F.collect_list("t").alias("ts"))
    pairs = sized.join(F.broadcast(by_size) if spread <= MAX_TEMPLATE_BYTES else by_size, "n")
    scored = F.transform("ts", lambda x: F.struct(
        (2.0 * F.size(F.array_intersect(F.col("ub"), x["tb"])) / (F.col("n") + F.size(x["tb"]))).alias("dice"), (-x["template"]).alias("order"), x["license"].alias("license"), x["template"].alias("template")))
    best = pairs.select(F.col("__key").alias(key), F.col("line").cast("long").alias("line"), "n_words", F.array_max(scored).alias("b"))
    return best.where(F.col("b.dice") >= threshold).select(key, "line", "b.license", "b.template", "b.dice", "n_words")


def spans(docs: DataFrame, templates: DataFrame | None = None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, start, end, license, template, dice, n_words): spans of words start <= i < end that hold a template."""
    if templates is None:
        rows = [(i, a, b) for i, (a, b) in enumerate((*NOTICES, *FULL_TEXTS))]
    else:
        rows = [tuple(r) for r in templates.where(F.col("text").isNotNull()).select("template", "license", "text").collect()]
    listed = []
    for number, name, of in rows:
        w = re.findall("[a-z0-9]+", of.lower())
        if m := len(tb := sorted({f"{a} {b}" for a, b in zip(w, w[1:])})):
            listed.append({"template": number, "license": name, "tb": tb, "m": m, "low": max(1, math.ceil(m * threshold / (2 - threshold) - 1e-9)), "high": math.floor(m * (2 - threshold) / threshold + 1e-9)})
    every = F.from_json(F.lit(json.dumps(sorted({g for t in listed for g in t["tb"]}))), "array<string>")
    ts = F.from_json(F.lit(json.dumps(listed)), "array<struct<template: int, license: string, tb: array<string>, m: int, low: int, high: int>>")
    # documents with enough of a template's bigrams, and those templates
    d = docs.select(F.col(f"`{key}`").alias("__key"), words(F.col(f"`{text}`")).alias("w")).where(F.size("w") > 1)
    d = d.withColumn("some", F.array_intersect(bigrams(F.col("w")), every)).where(F.size("some") >= min((t["low"] for t in listed), default=1))
    d = d.withColumn("ts", F.filter(ts, lambda t: F.size(F.array_intersect(F.col("some"), t["tb"])) >= t["low"])).where(F.size("ts") > 0)
    d = d.withColumn("__id", F.monotonically_increasing_id()).select("__id", "__key", "w", F.explode("ts").alias("t"))
    d = d.withColumn("g", F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))).drop("w")
    d = d.withColumn("hit", F.transform("g", lambda x: F.array_contains(F.col("t.tb"), x)))
    d = d.withColumn("at", F.filter(F.transform("hit", lambda h, i: F.when(h, i)), lambda i: i.isNotNull()))
    # a start has enough of the template's bigrams before its longest window ends
    d = d.withColumn("starts", F.filter("at", lambda s, j: F.coalesce(F.get("at", j + F.col("t.low") - 1) - s < F.col("t.high"), F.lit(False)))).where(F.size("starts") > 0)
    # how far back the same bigram stands (0: not within the longest window)
    d = d.withColumn("back", F.transform("g", lambda x, i: F.array_position(F.reverse(F.slice("g", F.greatest(i - F.col("t.high"), F.lit(0)) + 1, F.least(i, F.col("t.high")))), x).cast("int")))

    def best(s):
        """The best window from a start: distinct bigrams n, of them h in the template."""
        def step(x, i):
            new = (F.get("back", i) == 0) | (i - F.get("back", i) < s)
            n, h = x["n"] + new.cast("int"), x["h"] + (new & F.get("hit", i)).cast("int")
            dice = 2.0 * h / (n + F.col("t.m"))
            better = dice > x["dice"]
            return F.struct(n.alias("n"), h.alias("h"), F.when(better, dice).otherwise(x["dice"]).alias("dice"), F.when(better, i).otherwise(x["end"]).alias("end"))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("h"), F.lit(0.0).alias("dice"), s.alias("end"))
        x = F.aggregate(F.sequence(s, F.least(s + F.col("t.high"), F.size("g")) - 1), start, step)
        return F.struct(s.alias("start"), x["end"].alias("last"), x["dice"].alias("dice"))

    hits = d.select("__id", "__key", F.col("t.license").alias("license"), F.col("t.template").alias("template"), F.explode(F.transform("starts", best)).alias("b")).select("__id", "__key", "license", "template", "b.*").where(F.col("dice") >= threshold)
    order = Window.partitionBy("__id", "license").orderBy("start", "last", "template")
    far = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("new", F.coalesce((F.col("start") > far).cast("int"), F.lit(1))).withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = hits.groupBy("__id", "license", "span").agg(F.first("__key").alias(key), F.min("start").cast("long").alias("start"), (F.max("last") + 2).cast("long").alias("end"), F.max(F.struct("dice", (-F.col("template")).alias("order"))).alias("b"))
    return out.select(key, "start", "end", "license", (-F.col("b.order")).alias("template"), "b.dice", (F.col("end") - F.col("start")).alias("n_words"))
