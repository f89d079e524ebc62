"""Licence scans: Dice coefficient of word bigrams against templates.

Texts are normalised to lower-case words.  Lines, paragraphs and the whole text are compared with
each template whose number of bigrams lets the coefficient reach the threshold: with sizes a and b
it is at most 2 min(a, b) / (a + b).  So are all windows of a template's number of words, wherever
they start.  With c shared bigrams, b >= c, so the threshold t needs c >= a t / (2 - t): of any
a - c + 1 bigrams of a template (its `anchors`) a match has one, so texts without any are done after
one pass, and windows without one are not compared.  Everything is one projection of built-in
functions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.higher import let

THRESHOLD = 0.8

# Notices and short texts of public licences.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    # whole texts and file headers
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


def normal_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes that can reach the threshold against a template of `size` bigrams."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def anchors(template: str, threshold: float) -> list[str]:
    """Bigrams of a template of which every match has one: the longest, which are the rarest."""
    own = bigrams(normal_words(template))
    shared = math.ceil(len(own) * threshold / (2 - threshold) - 1e-9)
    return sorted(own, key=lambda b: (-len(b), b))[: len(own) - shared + 1]


def _constant(templates, threshold: float) -> Column:
    """The templates as one constant array, so that expressions over them are built once."""
    rows = []
    for k, (_, text) in enumerate(templates):
        words = normal_words(text)
        own = bigrams(words)
        low, high = size_bounds(len(own), threshold)
        listed = [f"split('{'|'.join(x)}', '[|]')" for x in (own, anchors(text, threshold))]  # letters and digits
        rows.append(
            f"named_struct('k', {-k}, 'n', {len(words)}, 'size', {len(own)}, 'low', {low - 1e-9}D, "
            f"'high', {high + 1e-9}D, 'own', {listed[0]}, 'anchors', {listed[1]})"
        )
    return F.expr(f"array({', '.join(rows)})")


def _dice(pairs: Column, t: Column) -> Column:
    return F.lit(2.0) * F.size(F.array_intersect(pairs, t["own"])) / (F.size(pairs) + t["size"])


def _window_matches(words: Column, hits: Column, constant: Column, threshold: float) -> Column:
    """(dice, -place, start) of the windows that reach the threshold; hits are the places of anchors."""

    def of(pairs: Column) -> Column:
        def matches(t: Column) -> Column:
            last = F.size(pairs) - (t["n"] - 1)  # the start of the last window
            first = lambda i: F.greatest(F.lit(0), i - (t["n"] - 2))

            def scored(start: Column) -> Column:
                window = F.array_distinct(F.slice(pairs, start + 1, t["n"] - 1))
                return F.struct(let(window, lambda p: _dice(p, t)).alias("d"), t["k"].alias("k"), start.alias("s"))

            own = F.filter(
                hits, lambda i: F.array_contains(t["anchors"], F.get(pairs, i)) & (first(i) <= F.least(i, last))
            )
            starts = F.flatten(F.transform(own, lambda i: F.sequence(first(i), F.least(i, last))))
            return F.filter(F.transform(F.array_distinct(starts), scored), lambda x: x["d"] >= threshold)

        return F.flatten(F.transform(constant, matches))

    at = F.sequence(F.lit(0), F.size(words) - 2)
    return let(F.transform(at, lambda i: F.concat_ws(" ", words[i], words[i + 1])), of)


def _unit_matches(unit: Column, constant: Column, templates, threshold: float) -> Column:
    """The best (dice, -place) among the templates for a normalised unit, or null."""
    words = F.array_remove(F.split(unit, " "), "")

    def pairs(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 2)
        return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", w[i], w[i + 1])))

    def best(p: Column) -> Column:
        fitting = F.filter(constant, lambda t: F.size(p).between(t["low"], t["high"]))
        scored = F.transform(fitting, lambda t: F.struct(_dice(p, t).alias("d"), t["k"].alias("k")))
        return F.array_max(F.filter(scored, lambda x: x["d"] >= threshold))

    bounds = [size_bounds(len(bigrams(normal_words(t))), threshold) for _, t in templates]
    least, most = min(b[0] for b in bounds), max(b[1] for b in bounds)
    # distinct bigrams are fewer than the words and at least the distinct words less one
    possible = lambda w: (
        (F.size(w) > F.greatest(F.lit(1.0), F.lit(least - 1e-9)))
        & (F.size(F.array_distinct(w)) - 1 <= most + 1e-9)
    )
    return let(words, lambda w: F.when(possible(w), let(pairs(w), best)))


def scan(
    docs: DataFrame,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(<id_col>, license, dice, n_matches, n_windows), one row per row of docs, over whole texts.

    license: the best template of any unit or window, of equals the first in `templates`, null if
    none reaches the threshold; dice: its coefficient, else null; n_matches: lines, paragraphs of
    more than one line and whole texts of more than one paragraph that reach it; n_windows: pairs of
    a template and a first word whose window of as many words as the template reaches it.  Null and
    empty texts match nothing; repeated rows stay repeated; other columns are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flat = lambda x: F.translate(x, "\n", " ")
    out = docs.select(F.col(id_col), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ").alias("__clean"))
    clean = F.col("__clean")
    out = out.select(id_col, clean, F.array_remove(F.split(flat(clean), " "), "").alias("__words"))
    wanted = sorted({a for _, t in templates for a in anchors(t, threshold)})
    hits = F.expr(
        "filter(sequence(0, greatest(0, size(__words) - 2)), i -> concat_ws(' ', get(__words, i), get(__words, i + 1)) IN ("
        + ", ".join(f"'{w}'" for w in wanted)  # words of letters and digits only
        + "))"
    )
    out = out.select(id_col, "__clean", "__words", hits.alias("__hits"))
    constant = _constant(templates, threshold)
    parts = F.filter(F.split(clean, r"\n *\n[ \n]*"), lambda x: F.trim(flat(x)) != "")
    lines = F.filter(F.split(clean, "\n"), lambda x: x != "")
    several = F.filter(parts, lambda x: F.trim(x, F.lit(" \n")).contains("\n"))
    whole = F.when(F.size(parts) > 1, F.array(clean)).otherwise(F.array().cast("array<string>"))
    units = F.concat(lines, F.transform(several, flat), F.transform(whole, flat))
    matched = F.filter(
        F.transform(units, lambda u: _unit_matches(u, constant, templates, threshold)), lambda m: m.isNotNull()
    )
    both = F.struct(
        matched.alias("m"),
        _window_matches(F.col("__words"), F.col("__hits"), constant, threshold).alias("w"),
    )
    names = F.array(*[F.lit(name) for name, _ in templates])
    out = out.select(id_col, F.when(F.size("__hits") > 0, both).alias("__f"))
    best = F.transform("__f.w", lambda x: F.struct(x["d"].alias("d"), x["k"].alias("k")))
    out = out.select(
        id_col,
        F.array_max(F.concat("__f.m", best)).alias("__b"),
        F.coalesce(F.size("__f.m"), F.lit(0)).alias("__n"),
        F.coalesce(F.size("__f.w"), F.lit(0)).alias("__w"),
    )
    return out.select(
        id_col,
        F.get(names, -F.col("__b.k")).alias("license"),
        F.col("__b.d").alias("dice"),
        F.greatest("__n", F.lit(0)).cast("long").alias("n_matches"),
        F.greatest("__w", F.lit(0)).cast("long").alias("n_windows"),
    )


def scan_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same result over `documents` as SQL for DuckDB."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(
        f"({k}, {quoted(name)}, [{', '.join(map(quoted, bigrams(normal_words(text))))}], {len(normal_words(text))})"
        for k, (name, text) in enumerate(templates)
    )
    return rf"""
    WITH t(k, name, own, size) AS (VALUES {rows}),
    d AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')
                 AS clean FROM documents),
    s AS (SELECT doc_id, clean, list_filter(regexp_split_to_array(clean, '\n *\n[ \n]*'),
                 lambda x: trim(replace(x, chr(10), ' ')) <> '') AS parts FROM d),
    u AS (SELECT doc_id, unnest(string_split(clean, chr(10))) AS unit FROM s
          UNION ALL SELECT doc_id, p FROM (SELECT doc_id, unnest(parts) AS p FROM s)
                    WHERE contains(trim(p, ' ' || chr(10)), chr(10))
          UNION ALL SELECT doc_id, clean FROM s WHERE len(parts) > 1),
    w AS (SELECT doc_id, list_filter(string_split(replace(unit, chr(10), ' '), ' '), lambda x: x <> '') AS w
          FROM u),
    b AS (SELECT row_number() OVER () AS n, doc_id,
                 list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
          FROM w WHERE len(w) > 1),
    m AS (SELECT n, doc_id, k, name, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS dice
          FROM b JOIN t ON len(b) <= len(own) * {(2 - threshold) / threshold + 1e-9}
                       AND len(b) >= len(own) * {threshold / (2 - threshold) - 1e-9}),
    f AS (SELECT * FROM m WHERE dice >= {threshold}),
    l AS (SELECT doc_id, list_filter(regexp_split_to_array(clean, '[ \n]+'), lambda x: x <> '') AS w FROM d),
    a AS (SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS pairs
          FROM l WHERE len(w) > 1),
    o AS (SELECT k, size, len(own) AS a, unnest(own) AS pair FROM t),
    -- the numbers of a document's pairs that stand in a template, then the windows that hold enough of them
    p AS (SELECT * FROM (SELECT doc_id, len(pairs) AS n, unnest(pairs) AS pair, generate_subscripts(pairs, 1) - 1 AS i FROM a)
          JOIN o USING (pair)),
    starts AS (SELECT doc_id, k, unnest(range(greatest(0, i - size + 2), least(i, n - size + 1) + 1)) AS s, pair, a FROM p),
    e AS (SELECT doc_id, k, s FROM starts GROUP BY doc_id, k, s
          HAVING count(DISTINCT pair) >= any_value(a) * {threshold / (2 - threshold)} - 1e-9),
    v AS (SELECT doc_id, k, s, own, list_distinct(pairs[s + 1 : s + size - 1]) AS b
          FROM e JOIN a USING (doc_id) JOIN t USING (k)),
    x AS (SELECT doc_id, k, s, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS dice FROM v),
    y AS (SELECT * FROM x WHERE dice >= {threshold}),
    r AS (SELECT doc_id, k, dice FROM f UNION ALL SELECT doc_id, k, dice FROM y),
    g AS (SELECT doc_id, max(dice) AS dice FROM r GROUP BY doc_id),
    h AS (SELECT r.doc_id, min(r.k) AS k FROM r JOIN g ON r.doc_id = g.doc_id AND r.dice = g.dice GROUP BY r.doc_id),
    c AS (SELECT doc_id, count(DISTINCT n) AS n_matches FROM f GROUP BY doc_id),
    z AS (SELECT doc_id, count(*) AS n_windows FROM y GROUP BY doc_id)
    SELECT d.doc_id, t.name AS license, g.dice, coalesce(n_matches, 0) AS n_matches, coalesce(n_windows, 0) AS n_windows
    FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN c USING (doc_id)
    LEFT JOIN z USING (doc_id) LEFT JOIN t ON t.k = h.k
    """
