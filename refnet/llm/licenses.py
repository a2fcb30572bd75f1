"""License scans by diagonal voting.

Every rolling word k-gram of every text is joined, as 64-bit hashes, to the places of the same k-gram in the templates. A
match votes for its diagonal, the place in the text minus the place in the template. Votes are summed by diagonal, and
neighbouring diagonals that follow each other in the text (words added or left out) are merged. A merged span is verified
by the share of the template's words that its k-grams cover, and by its length. Of verified spans that overlap in a chain, as those
of a licence and its variant with one word more do, the ones with the most words found stay. The fixed short phrases are templates of
one k-gram, as long as the phrase, so each vote is a place where the phrase stands.

The templates are a parameter of bounded size and are broadcast. Matches alone are shuffled, by text, once.

Defined results: null text is empty; each row has its own result; a text without words has n_words 0, no label, score 0;
overlapping places all count; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import extended, pieces, utf8
from refnet.llm.words import ALNUM, ngram_hashes, text_words, word_hashes

GRAM = 4
ROW_GRAMS = 1 << 16  # of a very long text in one row
MAX_TEMPLATE_WORDS = 1_000_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # found only where all its words stand consecutively


# The phrases of the contract.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
# Passages of public licences, an entry for each paragraph or clause, so that a part of a licence is found too.
NOTICES = (
    # MIT
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("mit", "Released under the MIT License"),
    # ISC
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    # BSD
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    Template("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    # zlib, Boost, Unlicense
    Template("zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    Template("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    # Apache
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    Template("apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form"),
    Template("apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work"),
    # GNU
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("gpl", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    Template("gpl", "The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program"),
    Template("gpl", "When we speak of free software, we are referring to freedom, not price. Our General Public Licenses are designed to make sure that you have the freedom to distribute copies of free software (and charge for them if you wish), that you receive source code or can get it if you want it"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    Template("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    Template("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    # Mozilla, Eclipse
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    # Creative Commons
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    Template("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
    # Disclaimers that several licences share
    Template("no-warranty", "The software is provided as is, without warranty of any kind, express or implied"),
    Template("no-warranty", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    Template("no-warranty", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    Template("no-warranty", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
)


def _plan(templates: Sequence[Template]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, str, bool, int]]]:
    """(k, hash, template, place) of every k-gram, and (template, label, phrase, n_words)."""
    grams, about = [], []
    for t, template in enumerate(templates):
        words = text_words(template.text)
        if not len(words):
            raise ValueError(f"a template without words: {template.label}")
        k = len(words) if template.phrase else min(GRAM, len(words))
        grams += [(k, int(h), t, i) for i, h in enumerate(ngram_hashes(words, k).view(np.int64).tolist())]
        about.append((t, template.label, template.phrase, len(words)))
    if len(grams) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to broadcast")
    return grams, about


def text_grams(docs: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """``keep``, _row, n_words and (k, start, hashes): for each text one row of k 0 and rows of all its k-grams."""
    schema = extended(docs, keep, "_row long, n_words long, k int, start int, hashes array<long>")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "_utf8", 1 << 20):
            words, at = word_hashes(part.column("_utf8"), ALNUM)
            words_of = np.diff(at)
            of, ks, starts, bounds, values, total = [np.arange(part.num_rows)], [np.zeros(part.num_rows, int)], [np.zeros(part.num_rows, int)], [np.arange(1, part.num_rows + 1)], [np.zeros(part.num_rows, np.int64)], part.num_rows
            for k in sizes:
                hashes = ngram_hashes(words, k).view(np.int64)
                for i in np.flatnonzero(words_of >= k).tolist():
                    n = int(words_of[i]) - k + 1
                    for a in range(0, n, ROW_GRAMS):
                        b = min(n, a + ROW_GRAMS)
                        of.append([i]), ks.append([k]), starts.append([a])
                        values.append(hashes[at[i] + a : at[i] + b])
                        total += b - a
                        bounds.append([total])
            of = pa.array(np.concatenate(of), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.concatenate(bounds)], pa.int32()), pa.array(np.concatenate(values), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(of) for c in [*keep, "_row"]), pa.array(words_of).take(of), pa.array(np.concatenate(ks), pa.int32()), pa.array(np.concatenate(starts), pa.int32()), lists],
                names=[*keep, "_row", "n_words", "k", "start", "hashes"],
            )

    return docs.select(*keep, F.monotonically_increasing_id().alias("_row"), utf8("text").alias("_utf8")).mapInArrow(grams, schema)


def scan_licenses(
    docs: DataFrame, keep: list[str], templates: Sequence[Template] = PHRASES + NOTICES, drift: int = 3, gap: int = 4, min_cover: float = 0.75
) -> DataFrame:
    """``keep`` columns of every row, n_words, and: n_phrases, first_word, last_word and phrase_labels of the phrases;
    labels (all), score (largest share of a template found), spans (start, length, label, cover) of verified notices."""
    spark = docs.sparkSession
    grams, about = _plan(templates)
    places = spark.createDataFrame([*grams, (0, 0, -1, 0)], "k int, hash long, template int, place int")
    known = spark.createDataFrame([*about, (-1, "", True, 1)], "template int, label string, phrase boolean, size int")
    rolled = text_grams(docs, keep, sorted({g[0] for g in grams})).select(*keep, "_row", "n_words", "k", "start", F.posexplode("hashes").alias("i", "hash"))
    # Each text has a row of k 0, which matches the template -1: so texts without a match stay.
    votes = rolled.join(F.broadcast(places), ["k", "hash"]).select(*keep, "_row", "n_words", "k", "template", "place", (F.col("start") + F.col("i")).alias("at"))
    votes = votes.repartition("_row")
    own = ["_row", "template"]
    diagonals = votes.groupBy(*own, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        *(F.first(c).alias(c) for c in [*keep, "n_words"]),
        F.min("at").alias("first"),
        (F.max("at") + F.max("k")).alias("end"),
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("place"), F.col("place") + F.greatest(F.col("k"), F.lit(1)) - 1)))).alias("cover"),
    )
    diagonals = diagonals.join(F.broadcast(known), "template")
    order = Window.partitionBy(*own).orderBy("first", "diagonal")
    before = F.lag("diagonal").over(order)
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = before.isNull() | F.col("phrase") | (F.abs(F.col("diagonal") - before) > drift) | (F.col("first") - reach > gap)
    merged = (
        diagonals.withColumn("_new", apart.cast("int"))
        .withColumn("span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*own, "span")
        .agg(
            *(F.first(c).alias(c) for c in [*keep, "n_words", "label", "phrase", "size"]),
            F.min("first").alias("first"),
            F.max("end").alias("end"),
            (F.size(F.array_distinct(F.flatten(F.collect_list("cover")))) / F.first("size")).alias("cover"),
        )
    )
    found = F.col("template") >= 0
    phrase = found & F.col("phrase")
    verified = found & ~F.col("phrase") & (F.col("cover") >= min_cover) & (F.col("end") - F.col("first") <= 2 * F.col("size"))
    # Verified spans that overlap, one after another, are a chain.
    order = Window.partitionBy("_row").orderBy("first", "end", "template", "span")
    reach = F.max(F.when(verified, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    chain = F.sum((verified & (reach.isNull() | (F.col("first") >= reach))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    words = F.round(F.col("cover") * F.col("size"))
    ranked = merged.withColumn("_verified", verified).withColumn("_chain", chain)
    most = F.max(F.when(F.col("_verified"), words)).over(Window.partitionBy("_row", "_chain"))
    merged = ranked.withColumn("_kept", F.col("_verified") & (words >= most))
    verified = F.col("_kept")
    labels = lambda which: F.array_sort(F.collect_set(F.when(which, F.col("label"))))
    return (
        merged.groupBy("_row")
        .agg(
            *(F.first(c).alias(c) for c in [*keep, "n_words"]),
            F.count(F.when(phrase, 1)).alias("n_phrases"),
            F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(phrase, F.col("first"))).cast("long").alias("last_word"),
            labels(phrase).alias("phrase_labels"),
            labels(phrase | verified).alias("labels"),
            F.coalesce(F.max(F.when(found, F.least(F.col("cover"), F.lit(1.0)))), F.lit(0.0)).alias("score"),
            F.array_sort(F.collect_list(F.when(verified, F.struct(F.col("first").alias("start"), (F.col("end") - F.col("first")).alias("length"), "label", "cover")))).alias("spans"),
        )
        .drop("_row")
    )
