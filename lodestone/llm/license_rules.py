"""Licence scans by sentence and rule.

Texts are cut into sentences, which are normalised (lower case, every run of
other characters than letters and digits one blank, a mark such as ``(a)`` or
``1)`` at the beginning left out) and mapped to identifiers of known licence sentences. A licence rule is an ordered list of identifiers;
it matches where a document's known sentences hold that list in order, with at
most ``gap`` unknown sentences (clause numbers, say) between one and the next. A
match inside a longer one is dropped. Two readings of a text are scanned: ``lines``, in which each line
break ends a sentence, and ``flow``, in which sentences run on over line breaks
(hard-wrapped licence texts), ended by a blank line or a full stop.

DataFrame functions only, one pass and no shuffle: the sentence and rule tables
are small fixed values and travel as literals.

Defined results: a null text counts as empty; texts without a known sentence
have empty results; a null id is an id; repeated rows each get a row; an empty
table gives an empty result; other columns pass through under any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known licence sentences (fixed values).
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-terms": "This project is licensed under the terms of the MIT license.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files (the \"Software\"), to deal in the Software without "
                 "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                 "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                 "Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "mit-asis": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                "NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
                     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-head": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the "
                   "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the "
                  "License.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gnu-free": "This program is free software:",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation; either version 2 of the License, or (at your option) "
                  "any later version.",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License "
                         "as published by the Free Software Foundation;",
    "gpl2-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                  "any later version.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                   "License as published by the Free Software Foundation, either version 3 of the License, or (at "
                   "your option) any later version.",
    "gnu-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gnu-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl2-version": "2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
                 "https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc-zero": "Licensed under CC0 1.0.",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this "
                      "software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
                  "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented;",
    "zlib-marked": "Altered source versions must be plainly marked as such, and must not be misrepresented as being "
                   "the original software.",
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0.",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                 "software and accompanying documentation covered by this license (the \"Software\") to use, "
                 "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
                 "of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
                 "subject to the following:",
    "gnu-library": "This library is free software;",
    "lgpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                         "License as published by the Free Software Foundation;",
    "lgpl21-later": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
                   "as published by the Free Software Foundation, either version 3 of the License, or (at your "
                   "option) any later version.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse "
                  "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-made": "This program and the accompanying materials are made available under the terms of the Eclipse "
                 "Public License v.",
    "epl2-at": "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse "
                  "Public License v1.0 which accompanies this distribution, and is available at "
                  "http://www.eclipse.org/legal/epl-v10.html",
    "apache-title": "Apache License",
    "apache-version": "Version 2.0, January 2004",
    "apache-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "version-2": "Version 2, June 1991",
    "version-21": "Version 2.1, February 1999",
    "version-3": "Version 3, 29 June 2007",
    "version-3-affero": "Version 3, 19 November 2007",
    "spdx": "SPDX-License-Identifier:",
}

#: Licences that a line ``SPDX-License-Identifier: <name>`` can name (fixed values).
SPDX = [
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
]
SENTENCES |= {f"spdx {name}": name for name in SPDX}

#: Licence rules: identifier of the licence, and its sentences in order (fixed values).
RULES = [
    ("MIT", ["mit-released"]), ("MIT", ["mit-licensed"]), ("MIT", ["mit-terms"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis", "mit-liability"]), ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-notice"]), ("Apache-2.0", ["apache-head"]),
    ("Apache-2.0", ["apache-head", "apache-comply", "apache-copy", "apache-asis", "apache-see"]),
    ("GPL-2.0-only", ["gpl2-notice"]), ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-2.0-or-later", ["gnu-free", "gpl2-terms"]),
    ("GPL-2.0-or-later", ["gnu-free", "gpl2-redistribute", "gpl2-later"]),
    ("GPL-2.0-or-later", ["gnu-free", "gpl2-redistribute", "gpl2-later", "gnu-hope", "gnu-implied"]),
    ("GPL-3.0-or-later", ["gnu-free", "gpl3-terms"]),
    ("GPL-3.0-or-later", ["gnu-free", "gpl3-terms", "gnu-hope", "gnu-implied"]),
    ("AGPL-3.0-or-later", ["gnu-free", "agpl3-terms"]),
    ("AGPL-3.0-or-later", ["gnu-free", "agpl3-terms", "gnu-hope", "gnu-implied"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-version", "mpl2-copy"]),
    ("Unlicense", ["unlicense"]),
    ("CC-BY-4.0", ["cc-by"]), ("CC-BY-SA-4.0", ["cc-by-sa"]), ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]), ("CC0-1.0", ["cc-zero"]),
    ("Zlib", ["zlib-asis", "zlib-liability", "zlib-grant", "zlib-origin"]), ("Zlib", ["zlib-marked", "zlib-notice"]),
    ("BSL-1.0", ["bsl-notice"]), ("BSL-1.0", ["bsl-title"]), ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-title", "bsl-grant"]),
    ("LGPL-2.1-or-later", ["gnu-library", "lgpl-redistribute", "lgpl21-later"]),
    ("LGPL-3.0-or-later", ["gnu-free", "lgpl3-terms"]), ("LGPL-3.0-or-later", ["gnu-library", "lgpl3-terms"]),
    ("EPL-1.0", ["epl1-terms"]), ("EPL-2.0", ["epl2-terms"]), ("EPL-2.0", ["epl2-made", "epl2-at"]),
    ("Apache-2.0", ["apache-title", "apache-version"]),
    ("Apache-2.0", ["apache-title", "apache-version", "apache-terms"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("GPL-2.0-only", ["gpl-title", "version-2"]), ("GPL-3.0-only", ["gpl-title", "version-3"]),
    ("LGPL-2.1-only", ["lgpl-title", "version-21"]), ("LGPL-3.0-only", ["lgpl-title", "version-3"]),
    ("AGPL-3.0-only", ["agpl-title", "version-3-affero"]),
]
RULES += [(name, ["spdx", f"spdx {name}"]) for name in SPDX]

BLANK = r"[ \t\r\f]"
OTHER = r"[^\p{L}\p{N}]+"
#: A clause mark that a sentence begins with.
CLAUSE = r"^[ \t\r\f]*\(?([A-Za-z]|[0-9]{1,3}|[ivx]{1,4})\)[ \t\r\f]+"


def normalise(sentence: str) -> str:
    """What a known sentence looks like after normalisation."""
    kept = "".join(c if c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def _norm(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(s, CLAUSE, "")), OTHER, " "))


def readings(text: Column) -> tuple[Column, Column]:
    """Arrays of normalised, non-empty sentences: by lines, and flowing."""
    ended = F.regexp_replace(text, rf"([.!?;:])[ \t\r\f\n]+", "$1\n\n")
    lines = F.split(ended, "\n")
    flow = F.split(ended, rf"\n{BLANK}*\n")
    return tuple(F.filter(F.transform(a, _norm), lambda s: s != "") for a in (lines, flow))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named inside."""
    return F.get(F.transform(F.array(value), use), 0)


def _matches(sentences: Column, known: Column, rules: Column, longest: int, gap: int) -> Column:
    """Array of (first, last, license), in order of place.

    A match takes neighbouring known sentences, ``longest`` at most, so whether
    it stands inside a longer one is told by the rules that match at its own
    place and at the few places before: the work grows with the text alone."""
    numbered = F.transform(sentences, lambda s, i: F.struct(F.element_at(known, s).alias("id"), i.alias("at")))
    ids = F.filter(numbered, lambda k: k["id"].isNotNull())

    def at_place(found, k):
        def held(r):
            part = F.slice(found, k + 1, F.size(r["ids"]))
            near = F.transform(part, lambda p, i: F.coalesce(p["at"] - F.get(part, i - 1)["at"] <= gap + 1, F.lit(True)))
            return (F.get(r["ids"], 0) == F.get(found, k)["id"]) \
                & (F.transform(part, lambda p: p["id"]) == r["ids"]) & F.forall(near, lambda x: x)
        return F.transform(F.filter(rules, held), lambda r: F.struct(F.size(r["ids"]).alias("n"), r["license"].alias("license")))

    def search(found):
        places = F.sequence(F.lit(0), F.size(found) - 1)
        return _once(F.transform(places, lambda k: at_place(found, k)), lambda every: _once(
            F.transform(every, lambda m: F.coalesce(F.array_max(F.transform(m, lambda r: r["n"])), F.lit(0))),
            lambda reach: F.flatten(F.transform(every, lambda m, k: outer(found, m, reach, k)))))

    def outer(found, m, reach, k):
        n = F.get(reach, k)
        inside = F.lit(False)
        for j in range(1, longest):  # a match that begins j known sentences earlier
            inside = inside | F.coalesce(F.get(reach, k - j) - j >= n, F.lit(False))
        whole = F.filter(m, lambda r: (r["n"] == n) & ~inside)
        return F.array_distinct(F.transform(whole, lambda r: F.struct(
            F.get(found, k)["at"].alias("first"), F.get(found, k + n - 1)["at"].alias("last"), r["license"].alias("license"))))

    none = F.array().cast("array<struct<first:int,last:int,license:string>>")
    return _once(ids, lambda found: F.when(F.size(found) > 0, search(found)).otherwise(none))


def annotate(docs: DataFrame, text_col: str = "text", gap: int = 2,
             sentences: dict[str, str] | None = None,
             rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """(row, n_sentences, licenses, line_matches, flow_matches): ``row`` is the
    whole input row; licenses is a sorted array, a match is (first, last,
    license) with sentence places counted from 0 in its reading."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    number = {name: i + 1 for i, name in enumerate(sentences)}
    known = F.create_map(*[F.lit(v) for name, s in sentences.items() for v in (normalise(s), number[name])])
    table = F.array(*[F.struct(F.lit(lic).alias("license"), F.array(*[F.lit(number[s]) for s in ids]).alias("ids"))
                      for lic, ids in rules])
    longest = max(len(ids) for _, ids in rules)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    lines, flow = readings(F.coalesce(F.col("row")[text_col], F.lit("")))
    return (whole.select("row", lines.alias("lines"), flow.alias("flow"))
            .select("row", F.size("lines").cast("long").alias("n_sentences"),
                    _matches(F.col("lines"), known, table, longest, gap).alias("line_matches"),
                    _matches(F.col("flow"), known, table, longest, gap).alias("flow_matches"))
            .select("row", "n_sentences", F.array_sort(F.array_union(
                F.transform("line_matches", lambda m: m["license"]),
                F.transform("flow_matches", lambda m: m["license"]))).alias("licenses"),
                "line_matches", "flow_matches"))
