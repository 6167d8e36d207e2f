"""Licence scan: Dice coefficient over word bigrams against licence texts, in DataFrame functions alone.

A document is scanned line by line, by blocks between blank lines and by runs of such blocks, so that
one-line notices, texts set over several lines and whole licences of several paragraphs are each
seen whole. A unit is normalised to lower-case words and their distinct pairs. Dice is at least t
only if the smaller of two sets has at least t / (2 - t) times the larger's pairs: units whose size
fits no template go no further, a unit is compared just with the templates whose size fits its own,
and one that has none of the words in which a template's pairs lie shares too few of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored

#: Least Dice coefficient of a match.
THRESHOLD = 0.8
#: Words of a run of blocks at most; the longest template has a fifth of that.
RUN_WORDS = 1000

# Words that any text has.
COMMON = frozenset(
    "the of to and in a an or is be for any this that by on you it with as are not under from at all no other use may must "
    "shall which if into out 0 1 2 3 4 copy work works such following above but only how one".split()
)

# Licence names and the words of public licence notices and texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MIT-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        'persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        'distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        'THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
        "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative "
        "works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE "
        'IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS "
        "OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "PostgreSQL",
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and "
        "without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the "
        "following two paragraphs appear in all copies. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE TO ANY PARTY FOR DIRECT, "
        "INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS "
        "SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE COPYRIGHT HOLDER HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. THE "
        "COPYRIGHT HOLDER SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN \"AS IS\" BASIS, AND "
        "THE COPYRIGHT HOLDER HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS.",
    ),
    (
        "WTFPL",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
        "allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, "
        "DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
        "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for "
        "the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
        "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License "
        "for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under the CC0 1.0 Universal license."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _words(unit: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _pairs(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.size(words)
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))


def templates(spark: SparkSession) -> DataFrame:
    """``template, license, pair, n_template`` of the fixed list, which fixes its size too."""
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    each = spark.createDataFrame(rows, "template int, license string, text string")
    each = each.withColumn("pairs", _pairs(_words(F.col("text")))).withColumn("n_template", F.size("pairs"))
    return each.select("template", "license", "n_template", F.explode("pairs").alias("pair"))


def telling_words(threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit that is near a template has at least one.

    A unit within the threshold shares threshold / (2 - threshold) of the template's pairs. Words that
    are not common ones are taken, first those that are in most pairs, until of no template so many
    pairs are left without one.
    """
    left, needed = [], []
    for _, text in TEMPLATES:
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        left.append(set(zip(words, words[1:])))
        needed.append(threshold / (2 - threshold) * len(left[-1]))
    chosen: list[str] = []
    while any(len(pairs) >= n - 1e-9 for pairs, n in zip(left, needed)):
        counts = Counter(w for pairs, n in zip(left, needed) if len(pairs) >= n - 1e-9 for p in pairs for w in set(p) if w not in COMMON)
        best = max(counts, key=lambda w: (counts[w], w))
        chosen.append(best)
        left = [{p for p in pairs if best not in p} for pairs in left]
    return chosen


def _telling(text: Column, words: list[str]) -> Column:
    any_of = "|".join(map(re.escape, words))
    return F.rlike(F.lower(text), F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{any_of})(?![\p{{L}}\p{{N}}])"))


_BLANK_LINES = r"\n[ \t\r\f\x0B]*(?:\n[ \t\r\f\x0B]*)+"


def _units(text: Column) -> Column:
    """The units of a text that are one piece: its lines, and its blocks of several lines."""
    unit = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("unit_no"), F.lit(1).alias("n_blocks"), x.alias("unit"))
    blocks = F.filter(F.transform(F.split(text, _BLANK_LINES), unit("block")), lambda b: F.contains(b["unit"], F.lit("\n")))
    return F.concat(F.transform(F.split(text, "\n"), unit("line")), blocks)


def _runs(docs: DataFrame, telling: list[str]) -> DataFrame:
    """``doc_id, row, kind, unit_no, n_blocks, words``: two or more blocks after one another, each with a telling
    word, of no more than RUN_WORDS words."""
    blocks = docs.select("doc_id", "row", F.split("text", _BLANK_LINES).alias("blocks")).where(F.size("blocks") > 1)
    blocks = blocks.withColumn("tells", F.transform("blocks", lambda x: _telling(x, telling))).where(F.exists("tells", lambda t: t))
    # what tells nothing is in no run, so it needs no words
    words = F.zip_with("blocks", "tells", lambda x, t: F.when(t, _words(x)).otherwise(F.array().cast("array<string>")))
    blocks = blocks.select("doc_id", "row", "tells", words.alias("blocks"))
    first = blocks.select("*", F.explode(F.sequence(F.lit(0), F.size("blocks") - 2)).alias("unit_no")).where("tells[unit_no] and tells[unit_no + 1]")
    silent = F.expr("array_position(slice(tells, unit_no + 1, size(tells)), false)")
    last = F.when(silent == 0, F.size("tells") - 1).otherwise(F.col("unit_no") + silent - 2)
    each = first.withColumn("last", last).select("*", F.explode(F.sequence(F.col("unit_no") + 1, F.col("last").cast("int"))).alias("end"))
    run = F.flatten(F.slice("blocks", F.col("unit_no") + 1, F.col("end") - F.col("unit_no") + 1))
    sizes = F.aggregate(F.slice("blocks", F.col("unit_no") + 1, F.col("end") - F.col("unit_no") + 1), F.lit(0), lambda n, x: n + F.size(x))
    each = each.where(sizes <= RUN_WORDS)
    return each.select("doc_id", "row", F.lit("run").alias("kind"), F.col("unit_no").cast("int"), (F.col("end") - F.col("unit_no") + 1).cast("int").alias("n_blocks"), run.alias("words"))


def scanned(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, kind, unit_no, n_blocks, license, dice, n_pairs`` for each unit of ``docs(doc_id, text)`` that is a licence text.

    ``kind`` is line, block or run: blocks lie between blank lines, a run is made of ``n_blocks`` of
    them one after another, as whole licences are, each of which has a telling word, and of up to
    RUN_WORDS words. ``unit_no`` counts lines or blocks from 0. A document of one unit has it as a line. A unit has the best template's licence,
    at a tie the first by name. Of runs that overlap, of one another or of a block, only those come
    out that none of the others is better than, the shorter and earlier one at a tie. Null, empty and
    one-word texts have no pairs and no row. Repeated rows each have their own result; a null doc_id
    stays. An empty table gives an empty result. The template side is a fixed list, so it is broadcast.

    Units without any of the templates' telling words can't be near one, so most texts are neither
    cut nor normalised; the others are normalised once per unit.
    """
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    known = templates(docs.sparkSession)
    sizes = {r[0] for r in known.select("n_template").distinct().collect()}
    fits = [(math.ceil(n * low - 1e-9), math.floor(n * high + 1e-9)) for n in sorted(sizes)]
    longest, telling = max(b for _, b in fits), telling_words(threshold)
    some = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").where(_telling(F.col("text"), telling))
    units = some.select("doc_id", "row", F.explode(_units(F.col("text"))).alias("u")).select("doc_id", "row", "u.*")
    units = units.where(_telling(F.col("unit"), telling))
    units = units.select("doc_id", "row", "kind", "unit_no", "n_blocks", _words(F.col("unit")).alias("words"))
    rows = units.unionByName(_runs(some, telling)).where(F.size("words") >= 2)
    rows = rows.select("doc_id", "row", "kind", "unit_no", "n_blocks", _pairs(F.col("words")).alias("pairs")).withColumn("n_pairs", F.size("pairs"))
    possible = F.lit(False)
    for a, b in fits:
        possible = possible | F.col("n_pairs").between(a, b)
    rows = rows.where((F.col("n_pairs") <= longest) & possible)
    place = ["row", "kind", "unit_no", "n_blocks"]
    met = rows.select("doc_id", *place, "n_pairs", F.explode("pairs").alias("pair")).join(F.broadcast(known), "pair")
    met = met.where(F.col("n_pairs").between(F.ceil(F.col("n_template") * low - 1e-9), F.floor(F.col("n_template") * high + 1e-9)))
    shared = met.groupBy(*place, "template", "license", "n_template", "n_pairs").agg(F.count("*").alias("common"), F.first("doc_id").alias("doc_id"))
    dice = (2 * F.col("common") / (F.col("n_pairs") + F.col("n_template"))).alias("dice")
    close = shared.select(*place, "doc_id", "license", "n_pairs", dice).where(F.col("dice") >= threshold)
    best = F.min(F.struct((-F.col("dice")).alias("lack"), "license"))
    out = close.groupBy(*place).agg(best.alias("best"), F.first("doc_id").alias("doc_id"), F.first("n_pairs").cast("long").alias("n_pairs"))
    out = out.select("row", "doc_id", "kind", "unit_no", "n_blocks", F.col("best.license").alias("license"), (-F.col("best.lack")).alias("dice"), "n_pairs")
    return _best_runs(stored(out)).drop("row")


def _best_runs(found: DataFrame) -> DataFrame:
    """``found`` less the runs that overlap a better run or block of their text."""
    a, b = found.where("kind = 'run'"), found.where("kind <> 'line'").select(*(F.col(c).alias(f"o_{c}") for c in ("row", "unit_no", "n_blocks", "dice")))
    overlap = F.expr("row = o_row AND unit_no < o_unit_no + o_n_blocks AND o_unit_no < unit_no + n_blocks")
    better = F.expr("o_dice > dice OR o_dice = dice AND (o_n_blocks < n_blocks OR o_n_blocks = n_blocks AND o_unit_no < unit_no)")
    return found.where("kind <> 'run'").unionByName(a.join(b, overlap & better, "left_anti"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(documents(spark, sf_dir))


def _sql_templates() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))


_SQL_WORDS = r"string_split(trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
OP7_SQL = f"""
WITH tpl(template, license, body) AS (VALUES {_sql_templates()}),
tw AS (SELECT template, license, {_SQL_WORDS.format('body')} AS w FROM tpl),
tp AS (SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT template, license, w, unnest(range(1, len(w))) AS i FROM tw)),
tn AS (SELECT template, count(*) AS n_template FROM tp GROUP BY 1),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents WHERE text IS NOT NULL),
blocks AS MATERIALIZED (
  SELECT row_no, doc_id, unit_no, unit, {_SQL_WORDS.format('unit')} AS w FROM (
    SELECT row_no, doc_id, unnest(range(len(l))) AS unit_no, unnest(l) AS unit
    FROM (SELECT row_no, doc_id, regexp_split_to_array(text, '\\n[ \\t\\r\\f\\x0B]*(?:\\n[ \\t\\r\\f\\x0B]*)+') AS l FROM numbered))
),
telling AS MATERIALIZED (
  SELECT *, unit_no - row_number() OVER (PARTITION BY row_no ORDER BY unit_no) AS stretch FROM blocks
  WHERE list_has_any(w, [{", ".join(f"'{word}'" for word in telling_words())}])
),
runs AS (
  SELECT a.row_no, a.doc_id, a.unit_no, b.unit_no - a.unit_no + 1 AS n_blocks, flatten(list(c.w ORDER BY c.unit_no)) AS w
  FROM telling a JOIN telling b ON a.row_no = b.row_no AND a.stretch = b.stretch AND a.unit_no < b.unit_no
  JOIN telling c ON c.row_no = a.row_no AND c.unit_no BETWEEN a.unit_no AND b.unit_no
  GROUP BY ALL HAVING sum(len(c.w)) <= {RUN_WORDS}
),
lines AS (
  SELECT row_no, doc_id, unnest(range(len(l))) AS unit_no, unnest(l) AS unit FROM (SELECT row_no, doc_id, string_split(text, chr(10)) AS l FROM numbered)
),
uw AS MATERIALIZED (
  SELECT row_no, doc_id, 'line' AS kind, unit_no, 1 AS n_blocks, {_SQL_WORDS.format('unit')} AS w FROM lines
  UNION ALL SELECT row_no, doc_id, 'block', unit_no, 1, w FROM blocks WHERE contains(unit, chr(10))
  UNION ALL SELECT row_no, doc_id, 'run', unit_no, n_blocks, w FROM runs
),
up AS (SELECT DISTINCT row_no, doc_id, kind, unit_no, n_blocks, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS i FROM uw)),
un AS (SELECT row_no, kind, unit_no, n_blocks, count(*) AS n_pairs FROM up GROUP BY ALL),
hits AS (
  SELECT up.row_no, up.doc_id, up.kind, up.unit_no, up.n_blocks, tp.template, tp.license, count(*) AS common
  FROM up JOIN tp USING (pair) GROUP BY ALL
),
scored AS (
  SELECT h.row_no, h.doc_id, h.kind, h.unit_no, h.n_blocks, h.license, n_pairs, 2.0::DOUBLE * common / (n_pairs + n_template) AS dice
  FROM hits h JOIN un USING (row_no, kind, unit_no, n_blocks) JOIN tn USING (template)
),
best AS (
  SELECT * FROM scored WHERE dice >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY row_no, kind, unit_no, n_blocks ORDER BY dice DESC, license) = 1
)
SELECT doc_id, kind, CAST(unit_no AS INTEGER) AS unit_no, CAST(n_blocks AS INTEGER) AS n_blocks, license, dice, CAST(n_pairs AS BIGINT) AS n_pairs
FROM best a WHERE kind <> 'run' OR NOT EXISTS (
  SELECT 1 FROM best b WHERE b.kind <> 'line' AND a.row_no = b.row_no AND a.unit_no < b.unit_no + b.n_blocks AND b.unit_no < a.unit_no + a.n_blocks
    AND (b.dice > a.dice OR b.dice = a.dice AND (b.n_blocks < a.n_blocks OR b.n_blocks = a.n_blocks AND b.unit_no < a.unit_no)))
"""
