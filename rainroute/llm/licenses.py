"""License scans by diagonal voting, in DataFrame functions only.

Every run of ``K`` words of a document is hashed and joined to the places of the same run
in the license templates. A match votes for its diagonal, document place less template place.
Votes are counted per document, template and diagonal; diagonals at most ``DRIFT`` apart are merged, so
a few words put in or left out do not break a span. A span is kept if its votes,
checked against the template's words, cover enough of the template.

The base phrases are looked up word by word; their labels always stay.

Defined cases: null and empty texts have no words, labels or spans and score 0; texts shorter
than a run have no votes; rows alike in id and text get equal results; an empty table gives
no rows; further columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .repeats import key_columns

K = 4
DRIFT = 3
COVER = 0.5  # share of a template's runs that a span must hold

#: Separators of words (fixed value).
_SEPARATORS = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: Phrases and labels of the base (fixed values).
BASE = (
    (("mit", "license"), "mit"),
    (("apache", "license"), "apache"),
    (("general", "public", "license"), "gpl"),
)

#: Wording of public license notices (fixed values).
TEMPLATES = (
    ("mit", "Licensed under the MIT License."),
    ("mit", "This project is released under the MIT License. See the LICENSE file for details."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    ),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at",
    ),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights."),
)


#: Whole texts of public licenses, without titles and copyright lines (fixed values).
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the Software), to deal in the Software without restriction, including without limitation"
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
    " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions"
    " of the Software."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,"
    " INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF"
    " SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
    " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING"
    " IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
WHOLE = (
    (
        "mit",
        _MIT_GRANT + " THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT"
        " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
        " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN"
        " AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE"
        " OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("bsd", _BSD_TWO + _BSD_DISCLAIMER),
    ("bsd", _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE"
        " SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
        " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely,"
        " subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must"
        " not claim that you wrote the original software. If you use this software in a product, an acknowledgment in"
        " the product documentation would be appreciated but is not required. 2. Altered source versions must be"
        " plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not"
        " be removed or altered from any source distribution.",
    ),
    (
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute,"
        " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit"
        " third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices"
        " in the Software and this entire statement, including the above license grant, this restriction and the"
        " following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative"
        " works of the Software, unless such copies or derivative works are solely in the form of machine-executable"
        " object code generated by a source language processor. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY"
        " KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING"
        " THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright"
        " laws, the author or authors of this software dedicate any and all copyright interest in the software to the"
        " public domain. We make this dedication for the benefit of the public at large and to the detriment of our"
        " heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all"
        " present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT"
        " WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,"
        " FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,"
        " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
        " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
)


def words(body: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    body = F.coalesce(body, F.lit(""))
    lowered = F.translate(body, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, _SEPARATORS.replace("\\\\", "\\")), "")


def runs(found: str) -> str:
    """Hash and first word of every run of K words."""
    parts = ", ".join(f"{found}[i + {j}]" if j else f"{found}[i]" for j in range(K))
    return (
        f"if(size({found}) >= {K}, transform(sequence(0, size({found}) - {K}),"
        f" i -> named_struct('hash', xxhash64({parts}), 'word', {found}[i])),"
        " cast(array() as array<struct<hash: bigint, word: string>>))"
    )


def template_places(spark: SparkSession, templates=TEMPLATES + WHOLE) -> DataFrame:
    """hash, template, label, n (runs of the template), t (place) and word: a few thousand rows."""
    given = [F.struct(F.lit(label).alias("label"), F.lit(body).alias("body")) for label, body in templates]
    rows = spark.range(1).select(F.posexplode(F.array(*given)).alias("template", "t"))
    listed = rows.select("template", "t.label", words(F.col("t.body")).alias("found"))
    return listed.select(
        "template",
        "label",
        (F.size("found") - (K - 1)).alias("n"),
        F.posexplode(F.expr(runs("found"))).alias("t", "run"),
    ).select("template", "label", "n", "t", F.col("run.hash").alias("hash"), F.col("run.word").alias("t_word"))


def spans(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified spans: k1, k2, label, first, last (words) and cover; ``rows``: k1, k2, found (words)."""
    votes = (
        rows.select("k1", "k2", F.posexplode(F.expr(runs("found"))).alias("place", "run"))
        .select("k1", "k2", "place", F.col("run.hash").alias("hash"), F.col("run.word").alias("word"))
        .join(F.broadcast(templates), "hash")  # the constant lists above: a few thousand rows
        .where("word = t_word")
        .withColumn("diagonal", F.col("place") - F.col("t"))
    )
    diagonals = votes.groupBy("k1", "k2", "template", "label", "n", "diagonal").agg(
        F.countDistinct("t").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    # At most one row per diagonal of one document and template.
    order = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    merged = (
        diagonals.withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int"))
        .withColumn("band", F.sum(F.coalesce("apart", F.lit(0))).over(order))
        .groupBy("k1", "k2", "template", "label", "n", "band")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    cover = F.least(F.lit(1.0), F.col("votes") / F.col("n"))
    # Words put in must not outnumber the template's own.
    return (
        merged.withColumn("cover", cover)
        .where((F.col("cover") >= COVER) & (F.col("last") - F.col("first") < 2 * F.col("n") + 2 * K))
        .select("k1", "k2", "label", "first", (F.col("last") + K - 1).alias("last"), "cover")
    )


def _places(phrase: tuple[str, ...]) -> str:
    same = " and ".join(f"found[i + {j}] = '{w}'" if j else f"found[i] = '{w}'" for j, w in enumerate(phrase))
    n = len(phrase)
    return (
        f"if(array_contains(found, '{phrase[0]}') and size(found) >= {n},"
        f" filter(sequence(0, size(found) - {n}), i -> {same}), cast(array() as array<int>))"
    )


def scan(docs: DataFrame, templates=TEMPLATES + WHOLE, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, words, base places and labels, all labels, score and verified spans of every row."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        *key_columns(F.col(id_column), F.col(column)),
        words(F.col(column)).alias("found"),
    )
    found = spans(rows.drop("doc_id"), template_places(docs.sparkSession, templates))
    per_doc = found.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "label", "cover"))).alias("spans"),
        F.max("cover").alias("cover"),
    )
    base = rows.select(
        "doc_id",
        "k1",
        "k2",
        F.size("found").cast("long").alias("n_words"),
        *[F.expr(_places(phrase)).alias(f"at_{label}") for phrase, label in BASE],
    )
    base = base.select(
        "doc_id",
        "k1",
        "k2",
        "n_words",
        F.concat(*[f"at_{label}" for _, label in BASE]).alias("places"),
        F.array_compact(F.array(*[F.when(F.size(f"at_{label}") > 0, label) for _, label in BASE])).alias("base"),
    )
    joined = base.join(per_doc, ["k1", "k2"], "left")
    extra = F.coalesce(F.transform("spans", lambda s: s["label"]), F.expr("cast(array() as array<string>)"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", extra)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce(
            "spans", F.expr("cast(array() as array<struct<first: int, last: int, label: string, cover: double>>)")
        ).alias("spans"),
    )


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places and labels of every text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).drop("spans")
