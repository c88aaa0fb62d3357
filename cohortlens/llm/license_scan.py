"""Licence scans in DataFrame functions: a trained paragraph classifier with template comparison.

A paragraph is a line of a text, and a block of lines up to a blank one, so
hard-wrapped headers and licence texts are judged whole as well. Its features
are the word 1..3-grams that the given texts hold (notices, headers and
paragraphs of the licences, near-miss sentences), and its length. Whether it
states a licence is a logistic regression of the given texts (notices with
words left out and with words around, licences whole and in pieces) against
every corpus paragraph; which family it states, a multinomial one among the
given texts. N-grams that no given text holds could only tell corpus
paragraphs apart, so the vectors stay short and are written once for every
step. The probability from which a family is believed is calibrated on all
held-out corpus paragraphs. A prediction is confirmed by the share of a
template's n-grams that the paragraph has. Every paragraph is scored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.quantile import exact_quantiles
from cohortlens.llm.common import once, stored

#: Corpus paragraphs that hold one of these are no training examples of unknown.
ANCHORS = r"(?i)licen[cs]|copyright|all rights reserved|public domain|creative commons|spdx|\bcc[ -](?:by|0)|\bcc0\b|\ba?l?gpl\b|permission|redistribut|warrant|hereby"
NGRAMS = 3
SEPARATOR = r"[^\p{L}\p{N}]+"
UNKNOWN = "unknown"
#: The smallest believed probability.
LEAST_PROBABILITY = 0.5
#: Of squared standardised weights.
PENALTY = 0.002
#: Held-out unknown paragraphs that may be taken for a licence.
FALSE_SHARE = 0.005
#: Share of a template's n-grams that confirms a prediction.
CONFIRMED = 0.6

#: Notices by family: how projects state their licence.
NOTICES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
            "Licensed under the MIT License; see the LICENSE file for details.", "Distributed under the MIT licence."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Released under the Apache License 2.0.",
                   "You may not use this file except in compliance with the Apache License, Version 2.0.", "This project is licensed under the Apache 2.0 license."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL version 2 or later.",
            "SPDX-License-Identifier: GPL-3.0-or-later", "You can redistribute it under the terms of the GNU General Public License.",
            "Released under the GPL license, version 3."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only",
             "This library is released under the GNU Lesser General Public License.", "Distributed under the LGPL license."],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
             "Released under the terms of the GNU Affero General Public License.", "Distributed under the AGPL license."],
    "BSD": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-2-Clause", "Released under the simplified BSD license.",
            "Use of this source code is governed by a BSD-style license.", "Distributed under the new BSD licence."],
    "MPL-2.0": ["This file is subject to the terms of the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
                "Licensed under the Mozilla Public License 2.0."],
    "ISC": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC", "Released under the terms of the ISC licence."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0", "Text available under the Creative Commons Attribution License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License.",
                 "Available under the Creative Commons BY-NC license."],
    "CC0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0", "This work is in the public domain.",
            "To the extent possible under law, the author has waived all copyright under CC0."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Copyright 2021 Example Corp. All rights reserved.",
                    "Confidential and proprietary. All rights reserved. No part may be reproduced without permission.",
                    "Unauthorised copying of this file is prohibited under copyright law."],
}
_AS_IS = ("is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, "
          "fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or "
          "other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or "
          "other dealings in the software.")


def _gnu(name: str, version: str) -> list[str]:
    return [f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
            f"Foundation, either version {version} of the License, or (at your option) any later version.",
            f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
            f"or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.",
            f"You should have received a copy of the GNU {name} along with this program. If not, see the web site of the GNU project."]


#: Standard headers and paragraphs of the licences.
BODIES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "The software " + _AS_IS],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
                   "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
                   "and limitations under the License."],
    "GPL": _gnu("General Public License", "3"),
    "LGPL": _gnu("Lesser General Public License", "2.1"),
    "AGPL": _gnu("Affero General Public License", "3"),
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission.",
            "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited "
            "to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or "
            "contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages however caused and on any theory of "
            "liability, arising in any way out of the use of this software, even if advised of the possibility of such damage."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies.",
            "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of "
            "merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages "
            "whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action."],
    "CC0": ["To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to "
            "this work."],
}
#: Words of the pieces of a header or paragraph that are trained on, and how far they are apart.
PIECE, PIECE_STEP = 12, 6
#: Sentences that hold an anchor and state no licence.
NEAR_MISSES = [
    "She renewed her driving licence last week.", "The license plate of the car was missing.", "The pub lost its licence to sell alcohol.",
    "He wrote a long essay about the history of copyright law.", "Fishing requires a license in this state.", "The licensing fee rose by ten percent.",
    "A dispute about copyright ended in court.", "The doctor was licensed to practise in three countries.", "The path crosses the public domain of the city.",
    "The company sells licences for its database product.", "Poetic license is allowed here.", "They argued whether copyright should expire sooner.",
]
#: Words that notices are trained with around them: six before, or six behind.
AROUND = ["this is the code of our", "see the notes below for more", "with all the texts and pictures"]
#: From 2^4 words on, each power of two that a paragraph's length reaches is a feature.
FIRST_POWER, POWERS = 4, 12
#: What all corpus paragraphs together weigh at most in the fit, beside a weight of 1 for each given text.
CORPUS_WEIGHT = 2000
#: A corpus paragraph is learnt from or held out for the threshold; one that may state a licence is neither.
NEITHER, LEARNT, HELD = 0, 1, 2
#: A match of ``ANCHORS`` holds one of these, which are quicker to look for.
STEMS = ("licen", "copyright", "reserved", "domain", "commons", "spdx", "permission", "redistribut", "warrant", "hereby", "gpl", "cc")
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Vocabulary:
    """Terms by number: words, pairs, threes, threes of notices and licences (from ``first_of_licence``), powers of two (from ``first_power``)."""
    terms: list[str]
    first_of_licence: int
    first_power: int

    @staticmethod
    def of(notices: dict[str, list[str]] | None = None) -> "Vocabulary":
        """The n-grams of all texts that are given to learn from."""
        bodies = BODIES if notices is None else {}
        notices = notices or NOTICES
        runs = lambda texts, k: {" ".join(w[i:i + k]) for t in texts for w in [_WORD.findall(t.lower())] for i in range(len(w) - k + 1)}
        given = [t for _, t in _given(notices, bodies)]
        of_licence = runs([t for d in (notices, bodies) for ts in d.values() for t in ts], NGRAMS)
        terms = [t for k in range(1, NGRAMS + 1) for t in sorted(runs(given, k) - of_licence)]
        first = len(terms)
        terms += sorted(of_licence)
        return Vocabulary(terms + [f"#{2 ** (FIRST_POWER + i)}" for i in range(POWERS)], first, len(terms))

    def vectors(self, lines: DataFrame) -> DataFrame:
        """``lines`` with the terms of ``text`` as a sparse 0/1 vector ``features``, and the number of its ``words``."""
        out = RegexTokenizer(inputCol="text", outputCol="__w1", pattern=SEPARATOR, gaps=True, minTokenLength=1, toLowercase=True).transform(lines)
        for k in range(2, NGRAMS + 1):
            out = NGram(n=k, inputCol="__w1", outputCol=f"__w{k}").transform(out)
        made = [f"__w{k}" for k in range(1, NGRAMS + 1)]
        # a length of 2^k words has k + 1 binary digits
        reached = F.greatest(F.lit(0), F.least(F.lit(POWERS), F.length(F.bin(F.size("__w1"))) - FIRST_POWER))
        powers = F.slice(F.array(*map(F.lit, self.terms[self.first_power:])), 1, reached)
        out = out.select(*lines.columns, F.size("__w1").alias("words"), F.concat(*made, powers).alias("__terms"))
        return CountVectorizerModel.from_vocabulary(self.terms, inputCol="__terms", outputCol="features").setBinary(True).transform(out).drop("__terms")


@dataclass
class LicenceModel:
    """``licence``: whether a paragraph states one; ``family``: which one, among those that do."""
    vocabulary: Vocabulary
    licence: LogisticRegressionModel
    family: LogisticRegressionModel
    families: list[str]
    least: float
    templates: DataFrame


def _terms() -> Column:
    """The numbers of the terms of a row's ``features``."""
    return F.unwrap_udt("features").getField("indices")


def _given(notices: dict[str, list[str]], bodies: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(family, text) to learn from: notices whole, with each word left out and with words around; headers and paragraphs whole and in pieces; near misses."""
    known = [(f, t) for f, ts in notices.items() for t in ts]
    body = [(f, t) for f, ts in bodies.items() for t in ts]
    left_out = [(f, " ".join(w[:i] + w[i + 1:])) for f, t in known for w in [t.split(" ")] if len(w) > 3 for i in range(len(w))]
    around = [(f, t) for i, (f, n) in enumerate(known) for a in [AROUND[i % len(AROUND)]] for t in (f"{a} {n}", f"{n} {a}")]
    pieces = [(f, " ".join(w[i:i + PIECE])) for f, t in body for w in [t.split(" ")] for i in range(0, max(1, len(w) - PIECE + 1), PIECE_STEP)]
    near = [(UNKNOWN, t) for m in NEAR_MISSES for t in (m, f"also {m}")]
    return known + left_out + around + body + pieces + near


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, block, paragraph, whole, text): non-empty lines, and blocks of several lines joined.

    ``paragraph`` is the number of the (first) line in its text, from 0;
    ``block`` that of the block's first line, ``copy`` a hash of the text.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.split(F.col("text").cast("string"), r"\r\n|\r|\n").alias("l")).where("l is not null")
    empty = lambda i: F.coalesce(F.trim(F.get("l", i)) == "", F.lit(True))
    places = F.sequence(F.lit(0), F.size("l") - 1)
    starts, ends = F.filter(places, lambda i: ~empty(i) & empty(i - 1)), F.filter(places, lambda i: ~empty(i) & empty(i + 1))
    blocks = split.select("*", F.explode(F.arrays_zip(starts.alias("s"), ends.alias("e"))).alias("b")).select(
        "doc_id", "copy", F.col("b.s").alias("block"), F.slice("l", F.col("b.s") + 1, F.col("b.e") - F.col("b.s") + 1).alias("l"))
    unit = lambda i, whole, t: F.struct((F.col("block") + i).alias("paragraph"), F.lit(whole).alias("whole"), t.alias("text"))
    lines = F.transform("l", lambda t, i: unit(i, False, t))
    whole = F.when(F.size("l") > 1, F.array(unit(F.lit(0), True, F.array_join("l", " ")))).otherwise(F.slice(lines, 1, 0))
    return blocks.select("doc_id", "copy", "block", F.explode(F.concat(lines, whole)).alias("u")).select("doc_id", "copy", "block", "u.*")

def featured(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every paragraph of ``docs`` with its vector, cut and written once: all later steps read these rows.

    ``kind`` is ``NEITHER`` for a paragraph with an anchor or with pieces of a
    licence (two of its runs of three words, or one where there are three at
    most); of the others ``HELD`` for a quarter by hash of the text, else ``LEARNT``.
    """
    low = F.lower("text")
    anchor = F.when(reduce(or_, [low.contains(s) for s in STEMS]), F.col("text").rlike(ANCHORS)).otherwise(False)
    rows = vocabulary.vectors(paragraphs(docs).withColumn("anchor", anchor).withColumn("quarter", F.pmod(F.xxhash64("text"), F.lit(4)))).drop("text")
    shared = F.size(F.filter(_terms(), lambda i: (i >= vocabulary.first_of_licence) & (i < vocabulary.first_power)))
    piece = (shared > 1) | (shared == 1) & (F.col("words") < NGRAMS + 3)
    kind = F.when(F.col("anchor") | piece, NEITHER).when(F.col("quarter") == 0, HELD).otherwise(LEARNT)
    return stored(rows.select("doc_id", "copy", "block", "paragraph", "whole", kind.alias("kind"), "features"))


def train(docs: DataFrame, notices: dict[str, list[str]] | None = None, rows: DataFrame | None = None) -> LicenceModel:
    """Fit on the notices, the licences' paragraphs (of the default families), near misses and every learnt corpus paragraph.

    ``rows`` may give ``featured(docs, Vocabulary.of(notices))``. All corpus
    paragraphs weigh the same, together ``CORPUS_WEIGHT`` at most.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.of(notices)
    bodies = BODIES if notices is None else {}
    notices = notices or NOTICES
    families = list(notices)
    rows = featured(docs, vocabulary) if rows is None else rows
    counts = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = stored(vocabulary.vectors(spark.createDataFrame(_given(notices, bodies), "family string, text string")))
    stated = F.col("family") != UNKNOWN
    licence = _fit_licence(given.select(stated.cast("double").alias("label"), "features"), rows, counts.get(LEARNT, 0))
    index = F.array_position(F.array(*(F.lit(f) for f in families)), F.col("family")) - 1
    family = LogisticRegression(maxIter=40, regParam=PENALTY, family="multinomial").fit(given.where(stated).withColumn("label", index.cast("double")))
    texts = [(f, t) for d in (notices, bodies) for f, ts in d.items() for t in ts]
    templates = vocabulary.vectors(spark.createDataFrame(texts, "family string, text string")).select(
        "family", F.filter(_terms(), lambda i: i < vocabulary.first_power).alias("template")).where("size(template) > 0")
    model = LicenceModel(vocabulary, licence, family, families, LEAST_PROBABILITY, stored(templates))
    # of the held-out paragraphs, FALSE_SHARE at most may reach the threshold
    over = stored(believed(rows.where(F.col("kind") == HELD), model).select("probability"))
    n, spare = over.count(), int(FALSE_SHARE * counts.get(HELD, 0))
    if n > spare:
        at = exact_quantiles(over, ["probability"], [(n - 1 - spare) / (n - 1) if n > 1 else 0.0])["probability"][0]
        model.least = max(LEAST_PROBABILITY, at * (1 + 1e-9))
    return model


def _fit_licence(given: DataFrame, rows: DataFrame, learnt: int) -> LogisticRegressionModel:
    """Whether a licence is stated: ``given`` (label, features) against every learnt one of ``rows``."""
    weight = min(1.0, CORPUS_WEIGHT / max(1, learnt))
    corpus = rows.where(F.col("kind") == LEARNT).select(F.lit(0.0).alias("label"), "features", F.lit(weight).alias("weight"))
    return LogisticRegression(maxIter=40, regParam=PENALTY, family="binomial", weightCol="weight").fit(given.withColumn("weight", F.lit(1.0)).unionByName(corpus))


def believed(rows: DataFrame, model: LicenceModel) -> DataFrame:
    """(doc_id, copy, block, paragraph, whole, family, probability, terms) of every paragraph whose likeliest family reaches ``model.least``."""
    only = lambda m: m.copy({m.rawPredictionCol: "", m.predictionCol: "", m.probabilityCol: "__p"})
    place = ["doc_id", "copy", "block", "paragraph", "whole"]
    any_licence = F.get(vector_to_array("__p"), F.lit(1))
    # no family is likelier than that there is one; written here, so that only these are asked for their family
    maybe = stored(only(model.licence).transform(rows).where(any_licence >= model.least).select(*place, "features", any_licence.alias("any")))
    best = only(model.family).transform(maybe).select(*place, "any", _terms().alias("terms"), _best_family(model.families).alias("b"))
    return best.select(*place, F.col("b.family").alias("family"), (F.col("any") * F.col("b.p")).alias("probability"), "terms").where(F.col("probability") >= model.least)


def _best_family(families: list[str]) -> Column:
    """The likeliest family: struct (p, family).

    Exploded from an array of one: the probabilities are computed once per row, not
    once per family and use.
    """
    best = lambda p: F.array_max(F.array(*(F.struct(F.get(p, F.lit(i)).alias("p"), F.lit(f).alias("family")) for i, f in enumerate(families))))
    return F.explode(F.array(once(vector_to_array("__p"), best)))


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """Rows (doc_id, paragraph, family, probability, similarity, confirmed) for the paragraphs that state a licence.

    ``similarity`` is the largest share of a template of the predicted family
    that the paragraph contains. A block has the number of its first line.
    Predictions below the calibrated probability
    are unknown and not returned. Null and empty texts have no paragraphs;
    repeated rows are each reported; rows with a null doc_id are kept.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = featured(docs, model.vocabulary if model else Vocabulary.of())
    model = model or train(docs, rows=rows)
    found = believed(rows, model)
    by_family = model.templates.groupBy("family").agg(F.collect_list("template").alias("t"))
    like = F.array_max(F.transform("t", lambda t: F.size(F.array_intersect("terms", t)) / F.size(t)))
    out = found.join(F.broadcast(by_family), "family").withColumn("similarity", like).withColumn("confirmed", F.col("similarity") >= CONFIRMED)       # a row per family
    # a block is reported beside its lines only where it confirms what no line does
    block = Window.partitionBy("doc_id", "copy", "block")
    lines = [F.coalesce(F.max(F.when(~F.col("whole"), c)).over(block), F.lit(False)) for c in (F.lit(True), F.col("confirmed"))]
    out = out.withColumn("any_line", lines[0]).withColumn("sure_line", lines[1]).where("not whole or not sure_line and (confirmed or not any_line)")
    return out.select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed")
