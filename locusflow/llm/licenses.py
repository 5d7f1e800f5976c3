"""Licence scans: stretches of text against licence templates.

Text is normalised to lower-case ASCII words, so that line breaks, paragraphs
and punctuation don't matter, and a licence is found wherever it stands in a
text. For each template, a window begins at every bigram that the template has
and reaches to the last one within the template's length. Window and template
are compared by the Dice coefficient over their word bigrams,
2 * common / (own + template's); of the template's bigrams repeats count once.

The coefficient of n and m bigrams is at most 2 min(n, m) / (n + m), so a window
needs at least t / (2 - t) of the template's bigrams. This prunes twice: a text
is dropped before anything is shuffled if it has fewer different bigrams of the
templates, without those of two very common words, than any template would need;
and a template is a candidate of a text only if the whole text has as many of
its bigrams as a window needs.

A text keeps the best window of each template. Where windows of two licences
share words, the better one stays, so that a licence is not reported as its
sibling. Everything is DataFrame functions; the templates' bigrams are a fixed
small table and are broadcast.

Defined cases: null and empty texts, and texts of one word, have no licence; of
equal coefficients the first licence by name stays, then the first window; texts
of any length are read whole; repeated rows give repeated results; a null id is
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.llm.common import column, texts_of

THRESHOLD = 0.75
NULL_ID = -(1 << 63)
#: Words so common that a bigram of two of them tells nothing.
COMMON_WORDS = "a an and any are as at be by for from have if in is it not of on or that the this to was which with you your".split()

#: Licence notices and texts (fixed public wording), by SPDX name.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> "
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION "
        '1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of '
        'this document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.',
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        'documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS '
        'IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE "
        'IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)",
        "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization "
        "obtaining a copy of the software and accompanying documentation covered by this license",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
        'Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, '
        "REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, "
        "Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
        "allowed.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is "
        "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the '
        "creation of, or owns Covered Software.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
}


def words_in(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """The different word bigrams of a text, in order."""
    words = words_in(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def template_rows() -> list[tuple[int, str, int, int, int, str]]:
    """(template, licence, different bigrams, bigrams in all, code of the bigram, bigram) of all templates."""
    rows = []
    number = 0
    for name, own in sorted(TEMPLATES.items()):
        for text in own:
            found = bigrams(text)
            rows += [(number, name, len(found), len(words_in(text)) - 1, code, b) for code, b in enumerate(found)]
            number += 1
    return rows


def needed(size: int, threshold: float) -> int:
    """So many of a template's bigrams a window must have."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9)


def telling_bigrams(threshold: float) -> tuple[list[str], int]:
    """(bigrams of all templates that are not of two common words, so many of them at least are in a text that holds a licence)."""
    common = set(COMMON_WORDS)
    telling, least = set(), []
    for own in TEMPLATES.values():
        for text in own:
            found = bigrams(text)
            some = {b for b in found if not set(b.split()) <= common}
            telling |= some
            least.append(needed(len(found), threshold) - (len(found) - len(some)))
    return sorted(telling), max(1, min(least))


def best_windows(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tk, template, license, first, last, dice): the best window of each template that reaches the threshold.

    ``tk`` is a hash of the text, so that repeated ids stay apart; a null id is
    ``NULL_ID``; first and last number the window's bigrams in the text.
    """
    rows = template_rows()
    templates = F.broadcast(docs.sparkSession.createDataFrame(rows, "template int, license string, size int, length int, code int, bigram string"))
    telling, least = telling_bigrams(threshold)
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    source = texts_of(docs, id_col, text_col)
    # a generator keeps words and bigrams from being made again for each use
    worded = source.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(text).alias("tk"), F.explode(F.array(words)).alias("words")).filter(F.size("words") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat(F.get("words", i - 1), F.lit(" "), F.get("words", i)))
    paired = worded.select("doc_id", "tk", F.explode(F.array(pairs)).alias("pairs"))
    likely = paired.filter(F.size(F.array_distinct(F.filter("pairs", lambda b: b.isin(telling)))) >= least).dropDuplicates(["doc_id", "tk"])
    hits = likely.select("doc_id", "tk", F.posexplode("pairs").alias("pos", "bigram")).join(templates, "bigram").drop("bigram")
    key = ["doc_id", "tk", "template"]
    share = threshold / (2 - threshold)
    enough = hits.groupBy(*key, "size").agg(F.count_distinct("code").alias("n")).filter(F.col("n") >= F.col("size") * share - 1e-9).select(*key)
    ahead = Window.partitionBy(*key).orderBy("pos").rangeBetween(0, max(r[3] for r in rows) - 1)
    seen = hits.join(enough, key).withColumn("seen", F.collect_list(F.struct("pos", "code")).over(ahead))
    own = F.filter("seen", lambda h: h["pos"] < F.col("pos") + F.col("length"))
    windows = seen.select(*key, "license", "size", "pos", own.alias("own"))
    windows = windows.withColumn("common", F.size(F.array_distinct("own.code"))).withColumn("last", F.array_max("own.pos"))
    n = F.col("last") - F.col("pos") + 1 - (F.size("own") - F.col("common"))
    scored = windows.withColumn("dice", 2.0 * F.col("common") / (n + F.col("size"))).filter(F.col("dice") >= threshold)
    best = F.min(F.struct((-F.col("dice")).alias("d"), F.col("pos").alias("first"), "last")).alias("m")
    return scored.groupBy(*key, "license").agg(best).select(*key, "license", "m.first", "m.last", (-F.col("m.d")).alias("dice"))


def matches(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``best_windows`` without those that share words with a better one of another licence. A text has at most one row for each template."""
    found = best_windows(docs, threshold, id_col, text_col)
    other = found.select("doc_id", "tk", F.struct("license", "first", "last", "dice").alias("o"))
    ahead = (F.col("o.dice") > F.col("dice")) | ((F.col("o.dice") == F.col("dice")) & (F.col("o.license") < F.col("license")))
    meets = (F.col("o.license") != F.col("license")) & (F.col("o.first") <= F.col("last")) & (F.col("first") <= F.col("o.last"))
    better = found.join(other, ["doc_id", "tk"]).filter(ahead & meets).select("doc_id", "tk", "template").distinct()
    return found.join(better, ["doc_id", "tk", "template"], "left_anti")


def scan(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its best licence (null if none), that coefficient, all licences, templates that match."""
    best = F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("m")
    per_text = matches(docs, threshold, id_col, text_col).groupBy("doc_id", "tk").agg(F.array_sort(F.collect_set("license")).alias("licenses"), F.count("*").alias("n_matches"), best)
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    ids = docs.select(F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(text).alias("tk"))
    return ids.join(per_text, ["doc_id", "tk"], "left").select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"),
        F.col("m.license").alias("license"),
        (-F.col("m.d")).alias("dice"),
        F.array_join(F.coalesce("licenses", F.array().cast("array<string>")), ",").alias("licenses"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
    )


def scan_sql(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL with the rows of ``scan`` over the view ``documents``; without the first pruning, which changes no row."""
    values = ", ".join(f"({t}, '{name}', {n}, {length}, {code}, '{b}')" for t, name, n, length, code, b in template_rows())
    return f"""
WITH templates(template, license, size, length, code, bigram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
pairs AS (SELECT rn, unnest(range(1, len(w))) AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM d WHERE len(w) > 1),
hits AS (SELECT rn, pos, template, license, size, length, code FROM pairs JOIN templates USING (bigram)),
enough AS (SELECT rn, template FROM hits GROUP BY rn, template, size HAVING count(DISTINCT code) >= size * {threshold} / (2 - {threshold}) - 1e-9),
spans AS (
  SELECT a.rn, a.template, a.license, a.size, a.pos AS first, max(b.pos) AS last, count(*) AS seen, count(DISTINCT b.code) AS common
  FROM hits a JOIN enough USING (rn, template) JOIN hits b ON a.rn = b.rn AND a.template = b.template AND b.pos >= a.pos AND b.pos < a.pos + a.length
  GROUP BY a.rn, a.template, a.license, a.size, a.pos),
scored AS (SELECT *, 2.0::DOUBLE * common / (last - first + 1 - (seen - common) + size) AS dice FROM spans),
best AS (SELECT * FROM scored WHERE dice >= {threshold} QUALIFY row_number() OVER (PARTITION BY rn, template ORDER BY dice DESC, first) = 1),
kept AS (
  SELECT * FROM best a WHERE NOT EXISTS (
    SELECT 1 FROM best o WHERE o.rn = a.rn AND o.license <> a.license AND o.first <= a.last AND a.first <= o.last
      AND (o.dice > a.dice OR (o.dice = a.dice AND o.license < a.license)))),
docs AS (
  SELECT rn, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice,
         string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_matches
  FROM kept GROUP BY rn)
SELECT d.doc_id, docs.license, docs.dice, coalesce(docs.licenses, '') AS licenses, coalesce(docs.n_matches, 0) AS n_matches
FROM d LEFT JOIN docs USING (rn)
"""
