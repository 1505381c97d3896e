"""License scans with a positional index of rare licence words, in DataFrame operations only.

Templates (whole texts of public licences, the notices that files carry, and one-sentence forms) are
indexed by their rarer words with positions. One pass over the texts keeps, per document, the licence
words that occur and where. The document frequency of those words in the whole corpus gives their
weights (IDF), and each file's distinct licence words are ranked by them.

A template is a candidate of a file that holds all words of its mandatory key phrases. The
first word of the file's ranking that belongs to them is looked up: every occurrence in the file fixes
a start, the template's postings are intersected with the file's by relative position, and a match
needs every indexed word of the key phrases in its place and a share of the template's IDF weight: all of it for a one-sentence
form (a bare name or phrase decides nothing), ``TEXT_SHARE`` for a whole text, whose words may
stand up to ``DRIFT`` places off (numbers of clauses, names that were put in).

A match holds its key phrases and so the looked-up word in its place: the look-up loses
none. The neighbourhood that is compared is at most twice as long as the template, so the work per
document is linear in its licence words. The vocabulary is fixed, so the frequencies that the
driver reads have a proven bound.

Edge cases: null and empty texts have no words, no places, null first and last words, empty
labels and score 0; repeated rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.common import stage, table

#: Characters between words (after lower-casing A-Z, what is no digit, no a-z and no character beyond U+007F).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: One-sentence forms of public licences. (label, mandatory key phrases, wording)
NOTICES = (
    ("mit", ("mit license",), "Released under the MIT License"),
    ("mit", ("permission is hereby granted",), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", ("apache license",), "Licensed under the Apache License, Version 2.0"),
    ("gpl", ("general public license",), "GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", ("lesser general public license",), "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", ("affero general public license",), "GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", ("source and binary forms",), "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", ("bsd license",), "Released under the BSD License"),
    ("bsd", ("bsd license",), "Licensed under the BSD License"),
    ("isc", ("isc license",), "Released under the ISC License"),
    ("isc", ("isc license",), "Licensed under the ISC License"),
    ("mpl", ("mozilla public license",), "Released under the Mozilla Public License"),
    ("mpl", ("mozilla public license",), "Licensed under the Mozilla Public License"),
    ("unlicense", ("unencumbered software released",), "This is free and unencumbered software released into the public domain"),
    ("cc", ("creative commons attribution",), "Licensed under a Creative Commons Attribution"),
    ("cc", ("cc by",), "Licensed under CC BY"),
    ("proprietary", ("no part of this publication may be reproduced",), "All rights reserved. No part of this publication may be reproduced"),
    ("proprietary", ("proprietary and confidential",), "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential"),
)

#: Whole texts of public licences and of the notices that files carry.
TEXTS = (
    ("mit", ("permission is hereby granted",),
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
     "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
     "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", ("permission to use copy modify",),
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
     "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
     "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
     "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd", ("redistributions of source code",),
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("zlib", ("altered source versions",),
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
     "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
     "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
     "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
     "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
     "software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense", ("unencumbered software released",),
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
     "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
     "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software "
     "to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."),
    ("apache", ("apache license",),
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
     "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
     "the License for the specific language governing permissions and limitations under the License."),
    *(
        (label, (f"{kind} public license".strip(),),
         f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free "
         f"Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is distributed in the hope that it "
         "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
        for label, kind, thing, version in (
            ("gpl", "general", "program", "3"),
            ("lgpl", "lesser general", "library", "2.1"),
            ("agpl", "affero general", "program", "3"),
        )
    ),
    ("mpl", ("mozilla public license",),
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
     "can obtain one at http://mozilla.org/MPL/2.0/."),
)

#: Words of the templates that are too common to index.
COMMON = frozenset(
    "a all an and any anyone appear are as at be being but by can case charge claim data deal domain either even files following for free freely from held hope "
    "if in including into is it large later laws list loss made make may means must no not of on one or other our out persons person product see so such "
    "terms that the then this to under use useful v was way we will with without would you your subject thing whom wrote".split()
)

#: The share of its IDF weight that a whole text needs, and how far its words may be displaced.
TEXT_SHARE = 0.6
DRIFT = 4
#: Score of a base phrase without a match of the method's own.
BASE_SCORE = 0.5


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


class Template:
    """Postings of one template: its words with their places (None: not indexed), and the places of
    its key phrases."""

    def __init__(self, label: str, keys: tuple[str, ...], text: str, need: float, drift: int):
        self.label, self.need, self.drift = label, need, drift
        words = template_words(text)
        self.words = [None if w in COMMON else w for w in words]
        self.key: dict[int, str] = {}
        for phrase in keys:
            k = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(k)] == k)
            self.key |= {i: words[i] for i in range(at, at + len(k)) if self.words[i]}


INDEX = [Template(*t, 1.0, 0) for t in NOTICES] + [Template(*t, TEXT_SHARE, DRIFT) for t in TEXTS]
VOCABULARY = sorted({w for t in INDEX for w in t.words if w} | {w for p, _ in BASE for w in p.split()})


def licence_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, hits): hits are the licence words with their places, in order."""
    parts = docs.select("doc_id", F.split(F.coalesce("text", F.lit("")), SEPARATORS).alias("parts"))
    # A separator at either end leaves one empty part there.
    ends = parts.select(
        "doc_id",
        "parts",
        F.when(F.get("parts", F.lit(0)) == "", 1).otherwise(0).alias("lead"),
        F.when((F.size("parts") > 1) & (F.element_at("parts", -1) == ""), 1).otherwise(0).alias("trail"),
    )
    found = F.filter(
        F.transform("parts", lambda w, i: F.struct(F.lower(w).alias("w"), i.alias("p"), (F.octet_length(w) == F.length(w)).alias("ascii"))),
        lambda h: h["ascii"] & h["w"].isin(VOCABULARY),  # lower() is plain A-Z for ASCII words
    )
    return ends.select(
        "doc_id",
        (F.size("parts") - F.col("lead") - F.col("trail")).cast("long").alias("n_words"),
        F.transform(found, lambda h: F.struct(h["w"].alias("w"), (h["p"] - F.col("lead")).cast("long").alias("p"))).alias("hits"),
    )


def _places(phrase: str) -> Column:
    """Starts of the places where the phrase's words stand consecutively."""
    words = phrase.split()

    def here(h: Column, i: Column) -> Column:
        ok = h["w"] == words[0]
        for k, w in enumerate(words[1:], 1):
            nxt = F.get("hits", i + k)
            ok = ok & (nxt["w"] == w) & (nxt["p"] == h["p"] + k)
        return F.coalesce(ok, F.lit(False))

    return F.transform(F.filter("hits", here), lambda h: h["p"])


def _best_share(t: Template, idf: dict[str, float]) -> Column:
    """The largest share of the template's weight at any start that holds its key phrases; null
    without one."""
    keys = sorted(set(t.key.values()))
    own = F.array_intersect("ranked", F.array(*map(F.lit, keys)))  # in the order of the file's ranking
    looked_up = F.get(own, F.lit(0))
    first_place = F.get(F.array(*[F.lit(min(i for i, w in t.key.items() if w == k)) for k in keys]), F.array_position(F.array(*map(F.lit, keys)), looked_up).cast("int") - 1)
    words = F.array(*[F.lit(w).cast("string") for w in t.words])
    weights = F.array(*[F.lit(idf[w] if w else 0.0) for w in t.words])
    total = sum(idf[w] for w in t.words if w)
    span = len(t.words) + t.drift

    def share(h: Column, i: Column) -> Column:
        near = F.slice("hits", F.greatest(F.lit(1), i + 1 - span), F.lit(2 * span + 1))
        start = h["p"] - first_place

        def place(n: Column) -> Column:
            """The posting that the word stands for: the least displaced one."""
            at = (n["p"] - start).cast("int")
            return F.coalesce(*[F.when(F.get(words, at + d) == n["w"], at + d) for d in sorted(range(-t.drift, t.drift + 1), key=lambda d: (abs(d), d))])

        key_places = F.filter(near, lambda n: (n["p"] - start).isin(list(t.key)) & (F.get(words, (n["p"] - start).cast("int")) == n["w"]))
        places = F.array_distinct(F.filter(F.transform(near, place), lambda k: k.isNotNull()))
        weight = F.aggregate(places, F.lit(0.0), lambda a, k: a + F.get(weights, k))
        return F.when(F.size(key_places) == len(t.key), weight / total)

    shares = F.filter(F.transform("hits", lambda h, i: F.when(h["w"] == looked_up, share(h, i))), lambda s: s.isNotNull())
    return F.when(F.size(own) == len(keys), F.array_max(shares))


def scan(docs: DataFrame) -> DataFrame:
    """Per document: words, base places, labels, and the best match's share as a score."""
    hits = stage(licence_words(docs), "licence-words")
    n = hits.count()
    # At most one row for each word of the fixed vocabulary.
    seen = dict(hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").count().collect())
    idf = {w: math.log((n + 1) / (seen.get(w, 0) + 1)) + 1.0 for w in VOCABULARY}

    none = F.array().cast("array<string>")
    base = hits.select("doc_id", "n_words", "hits", *[_places(p).alias(f"base{i}") for i, (p, _) in enumerate(BASE)])
    some = F.size("hits") > 0
    # Each file's distinct licence words, the highest IDF first.
    order = F.array(*[F.lit(w) for w in sorted(VOCABULARY, key=lambda w: (-idf[w], w))])
    base = base.withColumn("ranked", F.when(some, F.array_intersect(order, F.transform("hits", lambda h: h["w"]))))
    base = base.select("*", *[F.when(some, _best_share(t, idf)).alias(f"share{i}") for i, t in enumerate(INDEX)])
    places = F.flatten(F.array(*[f"base{i}" for i in range(len(BASE))]))
    base_labels = F.concat(*[F.when(F.size(f"base{i}") > 0, F.array(F.lit(label))).otherwise(none) for i, (_, label) in enumerate(BASE)])
    enough = [F.col(f"share{i}") >= t.need - 1e-9 for i, t in enumerate(INDEX)]
    own = F.concat(*[F.when(ok, F.array(F.lit(t.label))).otherwise(none) for ok, t in zip(enough, INDEX)])
    score = F.greatest(F.lit(0.0), F.lit(0.0), *[F.when(ok, F.col(f"share{i}")) for i, ok in enumerate(enough)])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return base.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, own)).alias("labels"),
        F.least(F.lit(1.0), F.greatest(score, F.when(F.size(places) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)))).alias("score"),  # sums round
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
