"""License scans by a positional index of rare words, with DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words; a place is a word's number, from 0. Base labels come from three fixed phrases whose
words stand one after another. The method knows templates: short notices (NOTICES) and the paragraphs of whole licence texts (TEXTS;
more can be given, see paragraphs()). Of each template's words those with the highest inverse document frequency over all
templates are its index words (INDEX_WORDS of them, at their places in the template). The rarest of them, as many as hold more than the
share that may be missing, point: where a document has such a word, the template would begin so many words before. From there its other index
words are looked up at their places. A template is found where the idf of those that match reaches SUPPORT of its total and each of
its mandatory phrases stands at its place. Its label joins the base ones.

The score is the best support of a found template, 0.5 if only base phrases were found, else 0.

Everything happens within a row, so nothing is shuffled and no group of rows forms; a document without any of the words
that matter costs one look at its words, and the places to look at are numbers, told apart by hashing: the cost is linear in a
text's words. Defined results: a null or empty text has no words, no places, empty labels and
score 0; all rows are kept, and repeated ones each.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases and labels of the contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short notices as (label, words, mandatory phrases within them).
NOTICES = [
    ("mit", "released under the mit license", ["the mit license"]),
    ("mit", "licensed under the mit license", ["the mit license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
]

# Texts of licences, or the notice that a licence asks to put into files, paragraph by paragraph.
TEXTS = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required."""),
    ("bsl-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"""),
    ("unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.

Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."""),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("gpl", """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    ("agpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("epl-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""),
]
#: Mandatory phrases of paragraphs that another licence's differ from in a few words only.
DECISIVE = {"gpl-3.0": "either version 3 of the license", "gpl-2.0": "either version 2 of the license", "lgpl": "gnu lesser general public license", "agpl-3.0": "gnu affero general public license"}
INDEX_WORDS = 8
SUPPORT = 0.6
Template = tuple[str, str, list[str]]


def _words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def paragraphs(label: str, text: str, least_words: int = 8) -> list[Template]:
    """Templates of a licence's text, one for each paragraph of at least so many words; the middle 4 words are mandatory, or what DECISIVE names."""
    out = []
    for own in map(_words, re.split(r"\n\s*\n", text)):
        if len(own) >= least_words:
            mid = (len(own) - 4) // 2
            words, key = " ".join(own), DECISIVE.get(label, "")
            out.append((label, words, [key if key and f" {key} " in f" {words} " else " ".join(own[mid : mid + 4])]))
    return out


TEMPLATES: list[Template] = [*NOTICES, *(x for label, text in TEXTS for x in paragraphs(label, text))]


def notices(templates: list[Template] = TEMPLATES, index_words: int = INDEX_WORDS) -> list[dict]:
    """For each template: label, index [(word, place, idf)], how many of them point, total idf, and phrases [(place, words)]."""
    rows = [(label, text.split(), phrases) for label, text, phrases in templates]
    held = [set(words) for _, words, _ in rows]
    out = []
    for label, words, phrases in rows:
        idf = {w: round(math.log((1 + len(rows)) / sum(w in other for other in held)), 6) for w in words}
        rare = sorted(idf, key=lambda w: (-idf[w], words.index(w)))[:index_words]
        index = [(w, words.index(w), idf[w]) for w in rare]
        total = round(sum(x[2] for x in index), 6)
        # If none of these stands at its place, the others can't reach SUPPORT.
        point = next(n for n in range(1, len(index) + 1) if total - sum(x[2] for x in index[:n]) < (SUPPORT - 1e-6) * total)
        spots = []
        for p in phrases:
            own = p.split()
            spots.append((next(i for i in range(len(words)) if words[i : i + len(own)] == own), own))
        out.append({"label": label, "index": index, "point": point, "total": total, "phrases": spots})
    return out


def words_of(text_col: str = "text") -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), upper, upper.lower()), F.lit(WORD), F.lit(0))


def _strings(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in items])


#: A place to look at is template << 32 | beginning + _FAR: beginnings may lie before the text.
_FAR = 1 << 24


def scan(docs: DataFrame, text_col: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """docs, without the text, with n_words, n_base, first_word, last_word, base_labels, labels and score (in place of columns with these names)."""
    known = notices(templates)
    heads = [p.split() for p in PHRASES]
    postings: dict[str, list[int]] = {}
    for n, t in enumerate(known):
        for word, place, _ in t["index"][: t["point"]]:
            postings.setdefault(word, []).append((n << 32) + _FAR - place)
    # A document is looked at closely if it has the first word of a phrase or a word that points.
    keys = sorted({h[0] for h in heads} | set(postings))
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    plain = [c for c in without(docs, [*added, "lic__w"]).columns if c != text_col]
    cut = docs.select(*[F.col(f"`{c}`") for c in plain], words_of(text_col).alias("lic__w"))
    near = cut.select(*plain, F.size("lic__w").cast("long").alias("n_words"), F.when(F.arrays_overlap("lic__w", _strings(keys)), F.col("lic__w")).alias("lic__w"))

    w = F.col("lic__w")
    is_word = lambda i, word: F.coalesce(F.get(w, i) == word, F.lit(False))

    def base_label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for words, label in zip(heads, PHRASES.values(), strict=True):
            there = is_word(i, words[0])
            for k, word in enumerate(words[1:], 1):
                there = there & is_word(i + k, word)
            out = F.when(there, F.lit(label)).otherwise(out)
        return out

    where = F.filter(F.transform(w, lambda x, i: F.when(x.isin(keys), i)), lambda i: i.isNotNull())
    spotted = near.select(*plain, "n_words", "lic__w", where.alias("lic__at"))
    at = F.col("lic__at")
    places = F.filter(F.transform(at, lambda i: F.struct(i.alias("i"), base_label(i).alias("label"))), lambda s: s["label"].isNotNull())

    posts = F.from_json(F.lit(json.dumps(postings)), "map<string, array<bigint>>")  # constants: the optimizer folds them
    none = F.array().cast("array<bigint>")
    pointed = F.array_distinct(F.flatten(F.transform(at, lambda i: F.transform(F.coalesce(F.element_at(posts, F.get(w, i)), none), lambda code: code + i))))

    spots = [[{"word": x, "place": p + k} for p, ws in t["phrases"] for k, x in enumerate(ws)] for t in known]
    index = [[{"word": x, "place": p, "idf": idf} for x, p, idf in t["index"]] for t in known]
    rows = [{"label": t["label"], "total": t["total"], "index": i, "spots": s} for t, i, s in zip(known, index, spots, strict=True)]
    facts = F.from_json(F.lit(json.dumps(rows)), "array<struct<label: string, total: double, index: array<struct<word: string, place: int, idf: double>>, spots: array<struct<word: string, place: int>>>>")

    def looked_up(b: Column) -> Column:
        t, start = F.get(facts, F.shiftright(b, 32).cast("int")), (b.bitwiseAND(F.lit((1 << 32) - 1)) - _FAR).cast("int")
        got = F.aggregate(t["index"], F.lit(0.0), lambda sum_, x: sum_ + F.when(is_word(start + x["place"], x["word"]), x["idf"]).otherwise(0.0))
        whole = F.forall(t["spots"], lambda x: is_word(start + x["place"], x["word"]))
        return F.struct(t["label"].alias("label"), F.when(whole, got / t["total"]).otherwise(F.lit(0.0)).alias("support"))

    found = F.filter(F.transform(pointed, looked_up), lambda s: s["support"] >= SUPPORT)
    looked = spotted.select(*plain, "n_words", places.alias("lic__base"), found.alias("lic__found"))
    base, more = F.col("lic__base"), F.col("lic__found")
    none_s = F.array().cast("array<string>")
    base_labels = F.coalesce(F.array_sort(F.array_distinct(base["label"])), none_s)
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.array_distinct(more["label"]), none_s)))
    n_base = F.when(base.isNotNull(), F.size(base)).otherwise(0)
    best = F.coalesce(F.array_max(more["support"]), F.lit(0.0))
    return looked.select(
        *plain,
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.get(base["i"], F.lit(0)).cast("long").alias("first_word"),
        F.array_max(base["i"]).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(best > 0, F.least(best, F.lit(1.0))).when(n_base > 0, F.lit(0.5)).otherwise(F.lit(0.0)).alias("score"),
    )


def sql() -> str:
    """DuckDB SQL for the rows of the query, by joins of words with postings and phrase words; ids must be unique."""
    known = notices()
    values = lambda rows: ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    posts = values([(n, w, p, i) for n, t in enumerate(known) for w, p, i in t["index"]])
    spots = values([(n, p + k, w) for n, t in enumerate(known) for p, ws in t["phrases"] for k, w in enumerate(ws)])
    names = values([(n, t["label"], t["total"], sum(len(ws) for _, ws in t["phrases"])) for n, t in enumerate(known)])
    heads = values([(n, k, w, label, len(p.split())) for n, (p, label) in enumerate(PHRASES.items()) for k, w in enumerate(p.split())])
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d
), posts(n, word, place, idf) AS (VALUES {posts}), spots(n, place, word) AS (VALUES {spots}),
names(n, label, total, need) AS (VALUES {names}), heads(n, k, word, label, need) AS (VALUES {heads}),
base AS (
  SELECT doc_id, pos - k AS spot, label FROM words JOIN heads USING (word) GROUP BY doc_id, pos - k, heads.n, label, need HAVING count(*) = need
), bases AS (
  SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_sort(list(DISTINCT label)) AS base_labels FROM base GROUP BY doc_id
), pointed AS (
  SELECT doc_id, n, pos - place AS spot, sum(idf) AS got FROM words JOIN posts USING (word) GROUP BY ALL
), whole AS (
  SELECT p.doc_id, p.n, p.spot, p.got, count(*) AS met FROM pointed p JOIN spots s ON s.n = p.n JOIN words v ON v.doc_id = p.doc_id AND v.pos = p.spot + s.place AND v.word = s.word GROUP BY ALL
), found AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(got / total) AS support FROM whole JOIN names USING (n) WHERE met = need AND got / total >= {SUPPORT} GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(more, [])))), ','), '') AS labels,
       round(CASE WHEN support > 0 THEN least(support, 1.0) WHEN n_base > 0 THEN 0.5 ELSE 0 END, 6)::DOUBLE AS score
FROM d LEFT JOIN bases USING (doc_id) LEFT JOIN found USING (doc_id)
"""
