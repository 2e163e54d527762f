"""Licence scans: Dice coefficient over word bigrams against templates, in built-in functions only.

A text is read as words, whatever its lines, so a notice wrapped over lines or standing within a longer line is found like
any other. A span of a text is compared with a template by its bigrams: 2 c / (n + m), with m distinct bigrams in the
template, c of them in the span, and n bigrams in the span, of which those of the template count once and others at each place. Dice of
at least t bounds sizes twice: c is at least m t / (2 - t), which prunes the templates of a text before any span is
looked at, and n at most m (2 - t) / t, which bounds the spans.

A span begins and ends with a bigram of the template. For each begin the best span counts (by Dice, then length, then licence
id); of spans that overlap in a text one stays if no better one overlaps it (by Dice, then length, then begin).

In steps: bigrams of texts meet the distinct bigrams of all templates in a broadcast join (the number of rows is checked against
``MAX_TEMPLATE_ROWS``); what met is written and pre-aggregated by (text, template); begins meet ends in an equality join
on blocks of positions, so the work grows with a text's length and not with its square.

Normalising lower-cases and reads words as maximal runs of letters and digits.

Defined cases: null texts, and texts of fewer than two words, match nothing; a notice that occurs several times in a text
is reported each time; rows that share a doc_id are judged one by one; equal licences of equal spans are reported once; an empty
table gives an empty result; columns besides key and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged
from .decontaminate import let, words_of

LEAST_DICE = 0.8
MAX_TEMPLATE_ROWS = 200_000

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_NO_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ANY_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_AUTHOR = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."

#: Licence notices, headers and whole texts, by SPDX id.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            _GRANT,
            f"{_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_NO_WARRANTY}"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     _REDISTRIBUTION, f"{_REDISTRIBUTION} 1. {_SOURCE} 2. {_BINARY} 3. {_ENDORSE} {_AS_IS}"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", f"{_REDISTRIBUTION} 1. {_SOURCE} 2. {_BINARY} {_AS_IS}"],
    "ISC": ["Licensed under the ISC License.", f"{_ANY_USE}, provided that the above copyright notice and this permission notice appear in all copies. {_AUTHOR}"],
    "0BSD": [f"{_ANY_USE}. {_AUTHOR}"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  f"This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. {_NO_WARRANTY}"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
}


def pairs_of(words: Column) -> Column:
    """The pairs of neighbouring words in order; empty for fewer than two."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def template_bigrams(df: DataFrame, templates: dict[str, list[str]], least: float) -> DataFrame:
    """t (number of the template), license_id, gram, m, need (least c) and reach (most n)."""
    rows = [(k, i, t) for k, (i, t) in enumerate((i, t) for i in sorted(templates) for t in templates[i])]
    own = df.sparkSession.createDataFrame(rows, "t int, license_id string, x string").select("t", "license_id", let(words_of(F.col("x")), lambda w: F.array_distinct(pairs_of(w))).alias("grams"))
    m = F.size("grams")
    return own.select(
        "t", "license_id", m.alias("m"), F.ceil(m * least / (2 - least) - 1e-9).cast("int").alias("need"), F.floor(m * (2 - least) / least + 1e-9).cast("int").alias("reach"), F.explode("grams").alias("gram"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """key, license_id, start (0-based word), n_words and dice of every span that matches a template."""
    templates = templates or TEMPLATES
    known = template_bigrams(docs, templates, least)
    small = sum(len(t) for ts in templates.values() for t in ts) <= MAX_TEMPLATE_ROWS  # letters, so more than bigrams
    sized = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    grams = known.select("gram").distinct()
    numbered = docs.select(F.monotonically_increasing_id().alias("r"), F.col(key).alias("_k"), F.col(text).alias("_t"))  # by document, before they are taken apart
    each = numbered.select("r", "_k", F.posexplode(let(words_of(F.col("_t")), pairs_of)).alias("at", "gram"))
    hits = staged(each.join(sized(grams), "gram"), "license-hits")

    # texts and templates that share enough bigrams
    shared = hits.select("r", "gram").distinct().join(sized(known.select("t", "gram", "need")), "gram").groupBy("r", "t", "need").agg(F.count("*").alias("n"))
    able = shared.where("n >= need").select("r", "t")
    own = hits.join(able, "r").join(sized(known), ["t", "gram"])
    own = own.withColumn("before", F.lag("at").over(W.partitionBy("r", "t", "gram").orderBy("at")))
    own = staged(own.select("r", "_k", "t", "license_id", "m", "reach", "at", "before", F.floor(F.col("at") / F.col("reach")).alias("block")), "license-able")

    begins = own.select("r", "_k", "t", "license_id", "m", "reach", F.col("at").alias("start"), F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("block"))
    ends = own.select("r", "t", "block", F.col("at").alias("end"), "before")
    spans = begins.join(ends, ["r", "t", "block"]).where("end >= start AND end < start + reach")
    upto = W.partitionBy("r", "t", "start").orderBy("end")
    first = (F.col("before").isNull() | (F.col("before") < F.col("start"))).cast("int")
    spans = spans.withColumns({"c": F.sum(first).over(upto), "k": F.count("*").over(upto)})
    n = F.col("end") - F.col("start") + 1 - F.col("k") + F.col("c")
    dice = F.round(2.0 * F.col("c") / (n + F.col("m")), 6)
    good = spans.withColumn("dice", dice).where(F.col("dice") >= least)
    # the best licence of each begin: by Dice, then length, then id
    best = good.groupBy("r", "start").agg(F.min(F.struct(
        (-F.col("dice")).alias("d"), (F.col("start") - F.col("end")).alias("l"), "license_id")).alias("b"), F.min("_k").alias("_k"))
    best = best.select("r", "_k", "start", (-F.col("b.d")).alias("dice"), (F.lit(2) - F.col("b.l")).alias("n_words"), F.col("b.license_id").alias("license_id"))
    best = staged(best, "license-spans")

    width = 4 * max((len(words) for ts in templates.values() for words in map(str.split, ts)), default=1) + 16  # no span is longer
    block = F.floor(F.col("start") / width)
    a = best.withColumn("block", block).alias("a")
    b = best.withColumn("block", F.explode(F.array(block - 1, block, block + 1))).alias("b")
    c = lambda x: F.col(x)
    overlap = (c("a.r") == c("b.r")) & (c("a.block") == c("b.block")) & (c("a.start") < c("b.start") + c("b.n_words")) & (c("b.start") < c("a.start") + c("a.n_words"))
    rank = lambda x: F.struct((-c(f"{x}.dice")).alias("d"), (-c(f"{x}.n_words")).alias("n"), c(f"{x}.start").alias("s"))
    kept = a.join(b, overlap & (rank("b") < rank("a")), "left_anti")
    return kept.select(c("a._k").alias(key), c("a.license_id").alias("license_id"), c("a.start").alias("start"), c("a.n_words").cast("int").alias("n_words"), c("a.dice").alias("dice"))
