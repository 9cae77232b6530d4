"""Licences of files, in DataFrame operations only.

Headers (comment blocks, paragraphs and runs of lines around a licence cue,
without comment marks) and whole licence files are compared with the standard
headers of known licences by the cosine of sparse TF-IDF vectors; terms are
weighted by their frequency over all headers and files of the corpus. A text
must also name what tells a licence from its likes: of a family's names the
first one in the text decides, with the version number bound to it, and a
clause that only a relative has rules a licence out. A
file without a licence of its own takes that of the licence file in its
nearest ancestor directory, found by joining the directories' ancestor paths.

Equal headers are scored once, however many files hold them. Ancestors are
joined per directory, not per file. The notices are a fixed table and the only
thing broadcast by name.

A licence file in which no licence is recognised is the nearest one all the
same: files below it get a null license, origin "inherited" and its path, and
it has itself a null license, origin "file" and its own path.

Defined results: a null or empty text has no header and is no licence file; a
source file named like one (license.py) counts only if a licence is recognised
in it; a file without path keeps
its own licence and inherits nothing; of equally similar notices the first in
``NOTICES`` counts, of several licence files in a directory the most similar,
then the smallest path; repeated rows each get the same result; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import ascii_lower, stage, table

THRESHOLD = 0.6
LICENCE_FILE = r"(?i)(?:^|/)(?:licen[cs]e|copying|unlicense|notice)(?:[._-][^/]*)?$"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Sources whose names look like a licence file's; they speak for their directory only if a licence is recognised in them.
CODE_FILE = r"(?i)[.](?:py|js|ts|jsx|tsx|java|go|c|h|cc|cpp|hpp|cs|rb|rs|php|pl|sh|sql|kt|swift|scala|css|json|ya?ml|xml)$"
#: What a comment puts before its lines, and a run of such lines (possessive, so that long runs need no deep recursion).
MARK = r"(?:/\*+|\*+/|\*+|//+|#+|;+|--+|%+|<!--|-->|\"{3}|'{3}|dnl\b|REM\b)"
LEADER = rf"(?m)^[ \t]*+(?:{MARK}[ \t]*+)*+"
COMMENT = rf"(?m)(?:^[ \t]*+{MARK}[^\n]*+(?:\n|\z))++"
#: Lines on each side of a cue that are compared with it, and the length from which a line is cut to sentences.
AROUND = (0, 1, 3, 9, 27)
LONG_LINE = 200


def gnu(work: str, name: str, version: str) -> list[str]:
    """The standard header of a GNU licence: its grant alone, whole, and for one version only."""
    old = not version.startswith("3")
    stop = ";" if old else ":"
    grant = f"This {work} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation"
    rest = (f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            f"FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this {work}")
    rest += "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA." if old else ". If not, see <https://www.gnu.org/licenses/>."
    later = f"{grant}{';' if old else ','} either version {version} of the License, or (at your option) any later version."
    only = f"{grant}, version {version} of the License."
    return [later, f"{later} {rest}", only, f"{only} {rest}",
            f"This {work} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} version {version} as published by the Free Software Foundation."]


NO_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
               "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
               "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
BSD_TWO = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form "
           "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
           "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
           "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
           "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
           "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
MIT_REST = (" (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
APACHE_GRANT = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."

#: The other Creative Commons licences of version 4.0: name, short and long elements.
CC_MORE = [("CC-BY-ND-4.0", "ND", "NoDerivatives"), ("CC-BY-NC-SA-4.0", "NC-SA", "NonCommercial-ShareAlike"), ("CC-BY-NC-ND-4.0", "NC-ND", "NonCommercial-NoDerivatives")]

#: Fixed: the licences' standard headers as their own texts tell to place them, the texts of the short licences, and common short forms.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", APACHE_GRANT),
    ("Apache-2.0", APACHE_GRANT + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
     "governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information "
     "regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", MIT_GRANT),
    ("MIT", MIT_GRANT + MIT_REST),
    ("MIT", f"{MIT_GRANT}{MIT_REST} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {NO_WARRANTY}"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    *[("GPL-3.0", x) for x in gnu("program", "General Public License", "3")],
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    *[("GPL-2.0", x) for x in gnu("program", "General Public License", "2")],
    *[("GPL-1.0", x) for x in gnu("program", "General Public License", "1")],
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    *[("LGPL-3.0", x) for x in gnu("library", "Lesser General Public License", "3")],
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    *[("LGPL-2.1", x) for x in gnu("library", "Lesser General Public License", "2.1")],
    ("LGPL-2.0", "This library is licensed under the GNU Library General Public License, version 2."),
    *[("LGPL-2.0", x) for x in gnu("library", "Library General Public License", "2")],
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    *[("AGPL-3.0", x) for x in gnu("program", "Affero General Public License", "3")],
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", BSD_GRANT),
    ("BSD-3-Clause", BSD_GRANT + BSD_TWO + BSD_THIRD + BSD_END),
    ("BSD-2-Clause", BSD_GRANT + BSD_TWO + BSD_END),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("ISC", ISC_GRANT),
    ("ISC", ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
     "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
     "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
     "THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    *[x for name, short, long in CC_MORE for x in (
        (name, f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License."), (name, f"Licensed under CC BY-{short} 4.0."),
        (name, f"Creative Commons Attribution-{long} 4.0 International Public License"))],
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and dedicated this work to the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is "
     "distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
     "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
     "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
     "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + NO_WARRANTY
     + " For more information, please refer to <https://unlicense.org/>"),
]

#: A version's number stands behind one of these, within so many characters of the licence's name.
VERSION = r"(?:\b(?:version|ver|v)[.]?\s*|licen[cs]e[\s,-]+|(?:gpl|apache|mpl)[\s/-]*v?)(?=[0-9])"
NEAR = 200
#: The names of one family, of which a text's first decides; longer ones hold the shorter ones.
PUBLIC = r"(?:general\s+public\s+licen[cs]e|gpl)"
GNU = rf"(?:(?:affero|lesser|library)\s+{PUBLIC}|general\s+public\s+licen[cs]e|\b[al]?gpl)"
APACHE = r"(?:apache(?:\s+software)?\s+licen[cs]e|apache[.]org/licen[cs]es/|\bapache[\s-]+(?=v?[0-9]))"
MOZILLA = r"(?:mozilla\s+public\s+licen[cs]e|\bmpl(?=[\s/-]*v?[0-9]))"
#: The elements of a Creative Commons name, and the words between it and its number.
ELEMENT = {"nc": r"[\s-]+(?:nc\b|non-?commercial)", "sa": r"[\s-]+(?:sa\b|share-?alike)", "nd": r"[\s-]+(?:nd\b|no-?deriv[a-z]*)"}
CC = rf"(?:attribution|\bcc[\s-]+by|licenses/by)(?:{'|'.join(ELEMENT.values())})*+"
CC_NUMBER = r"(?:\s+(?:international|unported|public|licen[cs]e))*+[\s/,-]*+(?:v(?:ersion|[.])?\s*)?(?=[0-9])"


def number(n: str) -> str:
    """This version and no longer one: 2 is 2.0, but not 2.1 and not 20."""
    return re.escape(n) + r"(?:[.]0)*+(?![.]?[0-9])"


def versioned(name: str, family: str, n: str) -> str:
    """The first name out of ``family`` in the text is ``name``, and the number before or behind it is ``n``."""
    before = r"\bversion\s+{}\s+of\s+(?:the\s+)?(?:gnu\s+)?"
    some = rf"(?:{before.format('[0-9.]+')})?{family}"
    return rf"\A(?:(?!{some}).)*+(?:{before.format(number(n))}{name}|(?={name})(?:(?!{VERSION}).){{0,{NEAR}}}+{VERSION}{number(n)})"


def creative(*elements: str, n: str = "4") -> str:
    """The first Creative Commons name with a number has these elements and this number."""
    has = "(?:attribution|\\bcc[\\s-]+by|licenses/by)" + "".join(ELEMENT[e] for e in elements)
    return rf"\A(?:(?!{CC}{CC_NUMBER}).)*+{has}{CC_NUMBER}{number(n)}"


LESSER = rf"(?:(?:lesser|library)\s+{PUBLIC}|\blgpl)"
GENERAL = r"(?:general\s+public\s+licen[cs]e|\bgpl)"
#: What a text must name besides being similar: licences that share their wording differ in a name, a number or a clause.
#: All are matched from the start of the text, so that what must not be there is looked for in all of it.
MUST = {
    "Apache-2.0": versioned(APACHE, APACHE, "2"), "MPL-2.0": versioned(MOZILLA, MOZILLA, "2"),
    "GPL-1.0": versioned(GENERAL, GNU, "1"), "GPL-2.0": versioned(GENERAL, GNU, "2"), "GPL-3.0": versioned(GENERAL, GNU, "3"),
    "LGPL-2.0": versioned(LESSER, GNU, "2"), "LGPL-2.1": versioned(LESSER, GNU, "2.1"), "LGPL-3.0": versioned(LESSER, GNU, "3"),
    "AGPL-3.0": versioned(rf"(?:affero\s+{PUBLIC}|\bagpl)", GNU, "3"),
    "MIT": r"\A(?!.*(?:mit\s+no\s+attribution|\bmit-0\b)).*(?:\bmit\b|hereby\s+granted,\s+free\s+of\s+charge)",
    "BSD-3-Clause": r"\A(?!.*(?:advertising\s+materials|\b(?:2|two)[\s-]clause|simplified\s+bsd)).*(?:neither\s+the\s+name|names?\s+of|bsd[\s-]+style|\b(?:3|three)[\s-]clause|(?:new|modified|revised)\s+bsd)",
    "BSD-2-Clause": r"\A(?!.*(?:advertising\s+materials|neither\s+the\s+name|names?\s+of|\b[34][\s-]clause)).*redistributions?\s+in\s+binary\s+form\s+must",
    "ISC": r"\A(?!.*(?:\b0bsd|zero[\s-]clause|without\s+fee\s+is\s+hereby\s+granted\s*[.])).*(?:\bisc\b|with\s+or\s+without\s+fee)",
    "CC-BY-4.0": creative(), "CC-BY-SA-4.0": creative("sa"), "CC-BY-NC-4.0": creative("nc"), "CC-BY-ND-4.0": creative("nd"),
    "CC-BY-NC-SA-4.0": creative("nc", "sa"), "CC-BY-NC-ND-4.0": creative("nc", "nd"),
    "CC0-1.0": r"\A.*(?:cc0|waived|dedicated)", "Unlicense": r"\A.*(?:unencumbered|unlicense)",
}


#: Words of the notices that any prose may have; no cues.
EVERYDAY = frozenset("associated charge damages derived distribute distribution following included performance permitted portions possible products provided related released "
                     "binary domain person persons promote public resulting source extent without author appear permit restriction software substantial written worldwide whatsoever modification limitation conditions documentation materials".split())


def cue() -> str:
    """Words that a header has: the licence's own word, and for notices without it their three terms that the fewest notices hold."""
    held = [set(re.findall(TERM, text.lower())) for _, text in NOTICES]
    rarest = {w for ws in held if not any(re.match("licen[cs]e", w) for w in ws)
              for w in sorted((w for w in ws if len(w) > 5 and w not in EVERYDAY), key=lambda w: (sum(w in x for x in held), -len(w), w))[:3]}
    return r"(?i)licen[cs]e|spdx-|public\s+domain|all\s+rights\s+reserved|\b(?:" + "|".join(sorted(map(re.escape, rarest))) + r")\b"


CUE = cue()

#: Whole texts of the long licences, and how like one of them a text must be: any two long English texts share their common words.
WHOLE = 0.95
FULL = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(Path(__file__).with_name("licences").glob("*.txt"))]
#: Sections 13 set the GNU Affero licence apart from the GPL, whose text it has otherwise.
FULL += [("AGPL-3.0", re.sub(r"GNU\s+GENERAL\s+PUBLIC", "GNU Affero General Public", text.replace("GNU Affero General Public", "GNU General Public"), flags=re.I)
          + " Remote Network Interaction; if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network "
            "an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge.")
         for name, text in FULL if name == "GPL-3.0"]
NOTICES += FULL

#: An SPDX tag's expression, and the identifiers that have another name here; any other one is reported as it stands.
IDENTIFIER = r"\(*[A-Za-z0-9]+(?:[.:-][A-Za-z0-9]+)*\+?\)*"
SPDX = rf"(?i:SPDX-License-Identifier):[ \t]*({IDENTIFIER}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{IDENTIFIER})*)"
IDENTIFIERS = {**{name.lower(): name for name, _ in NOTICES}, "gpl-3.0-or-later": "GPL-3.0", "gpl-2.0-only": "GPL-2.0"}


def terms(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(TERM), F.lit(0))


def parent(path: Column) -> Column:
    """The directory of a path; empty for the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def score(units: DataFrame, threshold: float, named: bool = False) -> DataFrame:
    """``units`` (unit text, holders) -> unit, license, similarity of its best notice, where that is enough.

    ``named``: only of notices whose licence the unit names (``MUST``).
    """
    spark = units.sparkSession
    notices = spark.createDataFrame([(-1 - i, name, text) for i, (name, text) in enumerate(NOTICES)], "id long, license string, text string")
    units = units.select(F.xxhash64("unit").alias("id"), "unit", "holders")
    every = units.select("id", F.col("unit").alias("text"), "holders").unionByName(notices.select("id", "text", F.lit(1).cast("long").alias("holders")))
    tf = (every.select("id", "holders", F.explode_outer(terms(F.col("text"))).alias("term")).where("term IS NOT NULL")
          .groupBy("id", "term").agg(F.count("*").alias("tf"), F.max("holders").alias("holders")))
    tf = stage(tf, "terms")
    total = every.agg(F.sum("holders")).first()[0] or 0
    idf = tf.groupBy("term").agg((F.log((F.lit(total) + 1.0) / (F.sum("holders") + 1.0)) + 1.0).alias("idf"))
    weighted = tf.join(idf, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    weighted = stage(weighted, "weights")
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # The notices' weights: at most all their terms, a table of a few hundred rows.
    notice = weighted.where("id < 0").join(F.broadcast(notices.select("id", "license")), "id")
    notice = notice.join(F.broadcast(norms.where("id < 0")), "id").select(
        F.col("id").alias("notice"), "license", "term", (F.col("w") / F.col("norm")).alias("nw"))
    dots = (weighted.join(units.select("id"), "id", "left_semi").join(F.broadcast(notice), "term")
            .groupBy("id", "notice", "license").agg(F.sum(F.col("w") * F.col("nw")).alias("dot")))
    alike = dots.join(norms, "id").withColumn("similarity", F.least(F.lit(1.0), F.round(F.col("dot") / F.col("norm"), 9))).where(F.col("similarity") >= threshold)
    if named:
        alike = alike.where((F.col("notice") > -1 - (len(NOTICES) - len(FULL))) | (F.col("similarity") >= max(threshold, WHOLE)))
        must = spark.createDataFrame(list(MUST.items()), "license string, must string")
        alike = (alike.join(F.broadcast(must), "license").join(units.select("id", "unit"), "id")
                 .where(F.regexp_like(ascii_lower(F.col("unit")), F.concat(F.lit("(?s)"), "must"))))
    best = (alike.groupBy("id").agg(F.max_by(F.struct("license", "similarity"), F.struct("similarity", "notice")).alias("b")))
    return (units.join(best, "id")
            .select("unit", F.col("b.license").alias("license"), F.col("b.similarity").alias("similarity")))


def units(files: DataFrame) -> DataFrame:
    """id, path, named, unit and whether it is a whole licence file, of ``files`` (id, path, text, named): what is compared with the notices.

    A licence file whole; and in every file, where they hold a cue: its
    comment blocks, their paragraphs and the text's, the runs of lines around
    a cue's line, and sentences of long lines; all without comment marks.
    """
    def has(x: Column) -> Column:
        return x.rlike(CUE)

    def paragraphs(x: Column) -> Column:
        return F.split(x, r"\n\s*\n", -1)

    # Behind generators, so that lambdas read these columns and do not make them again.
    made = files.select("*", F.explode(F.array(F.regexp_replace("text", LEADER, ""))).alias("bare"))
    comments = F.transform(F.filter(F.regexp_extract_all("text", F.lit(COMMENT), F.lit(0)), has), lambda x: F.regexp_replace(x, LEADER, ""))
    made = made.select("*", F.inline(F.array(F.struct(F.split("bare", r"\r?\n", -1).alias("lines"), comments.alias("comments")))))
    spots = F.filter(F.transform("lines", lambda x, i: F.when(has(x), i + 1)), lambda i: i.isNotNull())
    made = made.select("*", F.explode(F.array(spots)).alias("spots"))
    around = F.flatten(F.transform("spots", lambda i: F.array(*[
        F.array_join(F.slice("lines", F.greatest(i - r, F.lit(1)), i + r + 1 - F.greatest(i - r, F.lit(1))), "\n") for r in AROUND])))
    long = F.flatten(F.transform(F.filter("lines", lambda x: (F.length(x) > LONG_LINE) & has(x)), lambda x: F.split(x, r"(?<=[.!?;])\s+", -1)))
    blocks = F.concat(F.filter(paragraphs(F.col("bare")), has), "comments", F.filter(F.flatten(F.transform("comments", paragraphs)), has), around, F.filter(long, has))
    parts = F.transform(F.array_distinct(blocks), lambda x: F.struct(x.alias("unit"), F.lit(False).alias("whole")))
    whole = F.array(F.struct(F.col("text").alias("unit"), F.lit(True).alias("whole")))
    return made.select("id", "path", "named", F.inline(F.when(F.col("named"), F.concat(whole, parts)).otherwise(parts)))


def scan(files: DataFrame, key: str, path: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """key, path, license, similarity, origin (header, file, inherited or null) and from_path of every row."""
    rows = files.select(F.col(key).alias("id"), F.col(path).alias("path"), F.col(text).alias("text"))
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    marked = rows.where("text IS NOT NULL").select("id", "path", "text", named.alias("named")).where(F.col("named") | F.col("text").rlike(CUE))
    prose = marked.withColumn("text", F.regexp_replace("text", SPDX, " "))
    heads = stage(units(prose).select("id", "path", "named", "whole", F.btrim("unit").alias("unit")).distinct(), "heads")
    scored = score(heads.groupBy("unit").agg(F.count("*").alias("holders")), threshold, named=True)
    # A tag goes before a whole text, and that before its parts.
    tag = F.regexp_extract("text", SPDX, 1)
    listed = F.create_map(*[F.lit(x) for pair in IDENTIFIERS.items() for x in pair])
    tagged = marked.where(tag != "").select("id", "path", "named", F.coalesce(listed[F.lower(tag)], tag).alias("license"), F.lit(1.0).alias("similarity"), F.lit(2).alias("rank"))
    every = heads.join(scored, "unit").select("id", "path", "named", "license", "similarity", F.col("whole").cast("int").alias("rank")).unionByName(tagged)
    own = stage(every.groupBy("id", "path", "named").agg(
        F.max_by(F.struct("license", "similarity"), F.struct("rank", "similarity", "license")).alias("b"))
        .select("id", "path", "named", "b.license", "b.similarity"), "own")

    # Directories with a licence file, recognised or not, and each directory's nearest one upwards.
    said = named & F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    files_of = rows.where(said).select("id", "path", F.col("path").rlike(CODE_FILE).alias("code")).distinct()
    given = (files_of.alias("f").join(own.where("named").alias("o"), F.expr("f.id <=> o.id AND f.path = o.path"), "left")
             .where("o.license IS NOT NULL OR NOT f.code").select("f.path", "license", "similarity").groupBy(parent(F.col("path")).alias("dir"))
             .agg(F.min(F.struct((-F.coalesce("similarity", F.lit(0.0))).alias("less"), "path", "license", "similarity")).alias("g")))
    dirs = rows.where("path IS NOT NULL").select(parent(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/", -1)
    ups = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))
    near = (dirs.select("dir", F.explode(F.array_distinct(ups)).alias("up")).join(given.withColumnRenamed("dir", "up"), "up")
            .groupBy("dir").agg(F.max_by("g", F.length("up")).alias("g")))

    mine = rows.select("id", "path", parent(F.col("path")).alias("dir"), (said & ~F.col("path").rlike(CODE_FILE)).alias("file"))
    out = (mine.alias("m").join(own.alias("o"), F.expr("m.id <=> o.id AND m.path <=> o.path"), "left")
           .select("m.*", "o.named", "o.license", "o.similarity").join(near, "dir", "left"))
    has = F.col("license").isNotNull()
    itself = ~has & F.col("file") & F.col("g.license").isNull()
    return out.select(
        F.col("id").alias(key), F.col("path").alias(path), F.coalesce("license", "g.license").alias("license"),
        F.coalesce("similarity", "g.similarity").alias("similarity"),
        F.when((has & F.col("named")) | itself, "file").when(has, "header").when(F.col("g").isNotNull(), "inherited").alias("origin"),
        F.when(has | itself, F.col("path")).otherwise(F.col("g.path")).alias("from_path"))


def tree(docs: DataFrame) -> DataFrame:
    """Paths for ``documents``, which has none: source / thousand / fifty / name, each fiftieth one a licence file."""
    name = F.when(F.col("doc_id") % 50 == 0, "LICENSE").otherwise(F.concat(F.lit("doc_"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt")))
    deep = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 50).cast("string"))
    shallow = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"))
    return docs.select("doc_id", F.concat(F.when(F.col("doc_id") % 1000 == 0, shallow).otherwise(deep), F.lit("/"), name).alias("path"), "text")


def op5_license_scan(spark, sf_dir):
    """Licences of all documents, filed under paths made from source and id."""
    return scan(tree(table(spark, sf_dir, "documents", "doc_id", "source", "text")), "doc_id", "path", "text")
