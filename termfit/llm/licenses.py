"""License scans: MinHash bands over overlapping text windows, then exact shingle containment. Built-in functions only.

Each template length has its own windows: half as long again, and starting so often that every
run of the template's length lies wholly inside one of them. A window that holds the
template's share of shingles has a Jaccard similarity of at least J with it, and there are so
many bands that such a pair meets in one with a probability of at least CERTAINTY. What meets is
verified on whole shingle sets.

Texts that cannot contain a template are not cut into words at all. From each template a few words are chosen that lie in so many of its
shingles that the others alone fall short of the containment asked for: a text without any of these words contains no template. That test is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.llm.quality import once
from termfit.session import scratch_path

SHINGLE = 5
CONTAINMENT = 0.8
#: Least chance that a window which contains a template meets it in a band.
CERTAINTY = 0.9999

# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to '
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall "
    "be included in all copies or substantial portions of the Software.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MIT-license": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to '
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall "
    'be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.",
    "ISC-license": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
    '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
    "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
    'specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


@dataclass(frozen=True)
class Layout:
    """Windows for templates of ``words`` words: their length, their distance, and bands of ``rows`` hashes."""

    words: int
    window: int
    stride: int
    rows: int
    bands: int


def layout(words: int, size: int = SHINGLE, containment: float = CONTAINMENT, certainty: float = CERTAINTY) -> Layout:
    window = max(size, math.ceil(1.5 * words))
    own, all_ = words - size + 1, window - size + 1
    shared = max(1, math.ceil(containment * own))
    similarity = shared / (own + all_ - shared)
    best = None
    for rows in (1, 2):  # the cheaper of the two
        bands = 1 if similarity == 1 else math.ceil(math.log(1 - certainty) / math.log(1 - similarity**rows))
        if best is None or rows * bands < best.rows * best.bands:
            best = Layout(words, window, window - words + 1, rows, bands)
    return best


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


_MARK, _GAP = r"[^\p{L}\p{N}\p{M}\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
#: Between two words: white space with all marks around it, so that neither comment marks nor punctuation at a word's ends belong to it. The
#: look-behind starts at a run's first mark only, which keeps long runs linear.
BREAK = rf"(?<!{_MARK})(?:{_MARK}*+{_GAP}[^\p{{L}}\p{{N}}\p{{M}}]*+|{_MARK}++$|^[^\p{{L}}\p{{N}}\p{{M}}]++)"


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.col(text), BREAK), "")


def _word_keys(words: Column) -> Column:
    """Each word is hashed once; shingles are made of these."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(words: Column) -> Column:
    spots = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    made = F.transform(spots, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))))
    return F.when(F.size(words) >= SHINGLE, made).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column, plan: Column) -> Column:
    """One value for each band of ``plan``: from the band's number and its one or two least hashes."""

    def least(seed: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, seed)))

    def band(b: Column) -> Column:
        second = F.when(plan["rows"] == 2, least(2 * b + 1))
        return F.xxhash64(plan["words"], b, least(2 * b), second)

    return F.transform(F.sequence(F.lit(0), plan["bands"] - 1), band)


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license_id, n_words, words, template): words and distinct shingles of a configured list of templates, which must be short."""
    rows = spark.createDataFrame(sorted(templates.items()), "license_id string, text string")
    rows = rows.select("license_id", _lowered("text").alias("text")).select("license_id", once(_words("text")).alias("words"))
    rows = rows.select("license_id", "words", once(_word_keys(F.col("words"))).alias("w"))
    return rows.select("license_id", F.size("w").alias("n_words"), "words", F.array_distinct(_shingles(F.col("w"))).alias("template"))


def needed_words(words: list[str], containment: float = CONTAINMENT) -> list[str]:
    """A few words so that any ``containment`` share of the template's shingles holds one of them; long words, which are rare, first."""
    shingles = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
    spare = len(shingles) - math.ceil(containment * len(shingles))
    chosen: list[str] = []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(any(c in s for c in chosen) for s in shingles) > spare:
            break
        chosen.append(word)
    return chosen


def layouts_type(plans: list[Layout]) -> str:
    return "struct<" + ",".join(f"{k}:int" for k in vars(plans[0])) + ">"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """The templates that documents contain.

    Returns doc_id, license_id, containment (the best window's share of the template's shingles), n_windows
    and first_word, where the first of these windows begins (in words, comment marks not counted). One row per doc_id and template:
    rows with the same doc_id, repeated ones and those without it are taken together. A null or
    empty text contains nothing; a template of fewer than SHINGLE words is never found. Further columns are ignored. A text that may
    hold a template is held in one row with its windows, some 100 bytes of memory for each of its words and template length.
    """
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates).where("size(template) > 0")
    path = scratch_path(spark, "templates")
    known.write.parquet(path)
    known = spark.read.parquet(path)
    rows = known.select("n_words", "words").collect()  # the configured list
    plans = [layout(n, SHINGLE, containment) for n in sorted({r["n_words"] for r in rows})]
    kind = docs.schema["doc_id"].dataType.simpleString()
    if not plans:
        return spark.createDataFrame([], f"doc_id {kind}, license_id string, containment double, n_windows bigint, first_word int")
    needed = sorted({w for r in rows for w in needed_words(r["words"], containment)})
    step = docs.select("doc_id", once(_lowered("text")).alias("text"))
    step = step.where(reduce(or_, (F.contains("text", F.lit(w)) for w in needed))).select("doc_id", once(_words("text")).alias("w"))
    step = step.select("doc_id", once(_word_keys(F.col("w"))).alias("w"))
    step = step.select("doc_id", once(_shingles(F.col("w"))).alias("shingles"))
    layouts = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in vars(p).items())) for p in plans))
    by_words = spark.createDataFrame([(p.words, tuple(vars(p).values())) for p in plans], "n_words int, plan " + layouts_type(plans))
    signed = known.join(by_words, "n_words").select(
        "license_id", "template", F.explode(_signature(F.col("template"), F.col("plan"))).alias("band")
    )
    step = step.where("size(shingles) > 0").select("doc_id", "shingles", F.explode(layouts).alias("plan"))
    stride, inside = F.col("plan.stride"), F.col("plan.window") - SHINGLE + 1  # shingles of a window
    last = F.greatest(F.lit(0), F.ceil((F.size("shingles") - inside) / stride).cast("int"))
    # cut inside the row, so that a window's row holds its own shingles only
    cut = F.transform(F.sequence(F.lit(0), last), lambda n: F.array_distinct(F.slice("shingles", n * stride + 1, inside)))
    windows = step.select("doc_id", "plan", F.posexplode(cut).alias("number", "window"))
    windows = windows.select("doc_id", "plan", (F.col("number") * stride).alias("first_word"), "window").where("size(window) > 0")
    met = windows.select("doc_id", "first_word", "window", F.explode(_signature(F.col("window"), F.col("plan"))).alias("band"))
    met = met.join(F.broadcast(signed), "band").drop("band")  # a configured list: bands x templates rows
    shared = F.size(F.array_intersect("window", "template")) / F.size("template")
    met = met.select("doc_id", "license_id", "first_word", shared.alias("share")).where(F.col("share") >= containment)
    return met.groupBy("doc_id", "license_id").agg(
        F.max("share").alias("containment"), F.count_distinct("first_word").alias("n_windows"), F.min("first_word").alias("first_word")
    )
