"""Licence scan: lines, whole texts and word windows against licence templates by the Dice
coefficient over word bigrams, in Spark expressions only and inside the row (no shuffle).

Normalised: A-Z lower-cased, everything but a-z and 0-9 a separator, so that line ends, indents and
comment signs of a wrapped notice do not count. Units are each line, the text as a whole, and for
every template the windows of as many words as it has, beginning at a bigram that it has (a window
at the end of the text may be shorter): licence files among other text, headers above code and
notices inside a sentence. A unit has the set of its word bigrams. Dice of at least ``threshold``
needs ``threshold / (2 - threshold) <= |unit| / |template| <= (2 - threshold) / threshold`` and the
first of these shares of the template's bigrams inside the unit, so also inside the text: templates
that fail this are pruned before any line or window is looked at.

Defined results: a null or empty text has no units that match; units of fewer than two words have
no bigrams and match nothing; of equal Dice values the template first in ``TEMPLATES`` wins, then the
whole text, then the first line or window; repeated rows each get their own result; an empty table
gives an empty result; a text of any length is scanned whole, in memory that grows with its length;
other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oeeflow.llm.common import let

_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
               "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
               "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
               "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
               "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
               "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
               "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
               "DAMAGE.")
_SOURCE_AND_BINARY = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                      "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                      "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                      "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                      "documentation and/or other materials provided with the distribution. ")
_NO_ENDORSEMENT = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission. ")
_GPL_NO_WARRANTY = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public "
                    "License for more details. You should have received a copy of the GNU {0}General Public License along with "
                    "this program. If not, see <https://www.gnu.org/licenses/>.")

#: Licence notices and short licences in full, by SPDX identifier (several wordings each).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
            "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
            "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
            "DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", _SOURCE_AND_BINARY + _DISCLAIMER),
    ("BSD-3-Clause", _SOURCE_AND_BINARY + _NO_ENDORSEMENT + _DISCLAIMER),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that "
             "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
             "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
             "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
             "altered from any source distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version." + _GPL_NO_WARRANTY.format("")),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation; either version 2 of the "
                         "License, or (at your option) any later version." + _GPL_NO_WARRANTY.format("")),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                          "Affero General Public License as published by the Free Software Foundation, either version 3 of "
                          "the License, or (at your option) any later version." + _GPL_NO_WARRANTY.format("Affero ")),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                          "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                          "the License, or (at your option) any later version." + _GPL_NO_WARRANTY.format("Lesser ")),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]++", " "), " "), "")


def _sequence(words: Column) -> Column:
    """All bigrams in order, repeats included."""
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(
        F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
                   lambda a, b: F.concat(a, F.lit(" "), b)))


def _bigrams(text: Column) -> Column:
    return let(_words(text), lambda w: F.array_distinct(_sequence(w)))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                  templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row: id, ``n_lines``; ``n_matches`` (lines and whole text that reach ``threshold`` with any
    template), and of the best ``license``, ``dice`` and ``line`` (from 0; -1 for the whole text);
    ``n_windows`` (windows that reach it, for each template), and of the best ``window_license``,
    ``window_dice`` and ``window_word`` (its first word, from 0)."""
    known = [(name, template_bigrams(text), len(template_words(text))) for name, text in templates]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    rules = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(len(b)).alias("n"), F.lit(w - 1).alias("w"),
                               F.array(*[F.lit(x) for x in b]).alias("b")) for k, (_, b, w) in enumerate(known)])
    any_of = F.array(*[F.lit(x) for x in sorted({x for _, b, _ in known for x in b})])
    reached = F.lit(threshold) - 1e-9

    def dice(own: Column, t: Column) -> Column:
        return F.lit(2.0) * F.size(F.array_intersect(own, t["b"])) / (F.size(own) + t["n"])

    def fitting(own: Column, near: Column) -> Column:
        n = F.size(own)
        return F.filter(near, lambda t: (n >= t["n"] * low - 1e-9) & (n <= t["n"] * high + 1e-9))

    def best(own: Column, at: Column, near: Column) -> Column:
        return F.array_max(F.transform(fitting(own, near), lambda t: F.struct(
            dice(own, t).alias("dice"), (-t["k"]).alias("k"), (-at).alias("at"))))

    def windows(every: Column, t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(every) - 1), lambda i: F.array_contains(t["b"], F.get(every, i)))
        scored = F.transform(starts, lambda i: F.struct(
            dice(F.array_distinct(F.slice(every, i + 1, t["w"])), t).alias("dice"), (-t["k"]).alias("k"), (-i).alias("at")))
        return F.filter(scored, lambda u: u["dice"] >= reached)

    text = F.coalesce(F.col(text_col), F.lit(""))
    unit = "struct<dice:double,k:int,at:int>"
    none = F.array().cast(f"array<{unit}>")

    def found(lines: Column, every: Column, own: Column, near: Column) -> Column:
        units = F.concat(F.transform(lines, lambda x, i: let(_bigrams(x), lambda o: best(o, i, near))),
                         F.array(best(own, F.lit(-1), near)))
        hits = F.filter(units, lambda u: u["dice"] >= reached)
        inside = F.flatten(F.transform(near, lambda t: windows(every, t)))
        return F.struct(F.when(F.size(near) > 0, hits).otherwise(none).alias("h"),
                        F.when(F.size(near) > 0, inside).otherwise(none).alias("i"))

    def scan(every: Column) -> Column:
        def pruned(own: Column) -> Column:
            def survivors(shared: Column) -> Column:
                return F.filter(rules, lambda t: (F.size(shared) >= t["n"] * low - 1e-9) & (
                    F.size(F.array_intersect(shared, t["b"])) >= t["n"] * low - 1e-9))
            near = let(F.array_intersect(own, any_of), survivors)
            return let(near, lambda t: found(F.split(text, "\n"), every, own, t))
        return let(F.array_distinct(every), pruned)

    names = F.array(*[F.lit(name) for name, _, _ in known])
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return (docs.select(F.col(id_col), lines.alias("n_lines"),
                        let(let(_words(text), _sequence), scan).alias("_f"))
            .select(id_col, "n_lines", F.size("_f.h").cast("long").alias("n_matches"), F.array_max("_f.h").alias("_h"),
                    F.size("_f.i").cast("long").alias("n_windows"), F.array_max("_f.i").alias("_i"))
            .select(id_col, "n_lines", "n_matches", F.get(names, -F.col("_h.k")).alias("license"),
                    F.col("_h.dice").alias("dice"), (-F.col("_h.at")).cast("long").alias("line"),
                    "n_windows", F.get(names, -F.col("_i.k")).alias("window_license"),
                    F.col("_i.dice").alias("window_dice"), (-F.col("_i.at")).cast("long").alias("window_word")))
