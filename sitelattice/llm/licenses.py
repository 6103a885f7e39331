"""Operator 9 - licence scans by sentence rules (native).

Texts are cut into sentences at line ends and at closing punctuation before white
space; sentences are normalised (ASCII lower case, runs of anything but letters and
digits to one blank). A normalised sentence that a licence text is known to hold maps
to its identifier. Known sentences are also found wrapped: over several lines, with or
without comment marks, no blank line or full stop between (a semicolon or colon may be).
Such a sentence takes the place of its first line; lines that are known sentences by
themselves stay so. Licence rules are sequences of identifiers: a rule matches where its
sentences stand in order with no other known sentence between them. Longer rules are
tried first, and what one has matched is used up; then sentences that name a licence by
themselves are looked up, and what is left is reported as fragments. Sentences
that name someone have a hole there (``HOLES``): whoever they name, they are the same
sentence, so a clause about endorsement always parts BSD-3-Clause from BSD-2-Clause.
SPDX identifiers are read as expressions: AND, OR and parentheses part licences, a
trailing + means "or later", what follows WITH is an exception and no licence.
"All rights
reserved" makes a text proprietary only where it names no licence.

Only built-in expressions are used, in one pass without a shuffle. The sentence table
is a literal of some hundred entries, most made from a name and a version. Texts without any of the words that every known
sentence has one of (``ANCHOR``; a test holds the table to it) skip the cutting.

Nulls: a null text has no sentences. A null doc_id stays null. Repeated rows each give
a row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .native import between, let, matches, running

#: Abbreviations and initials, whose full stop ends no sentence.
ABBREVIATED = r"\b(Inc|INC|Ltd|LTD|Corp|CORP|Co|CO|[A-Z])\."
SPLIT = r"[\r\n]+|[.!?;:]+(?:[ \t]+|$)"
ANCHOR = r"(?i)licen[cs]e|rights reserved|copyright|permission|warrant|redistribution|free software|public domain|liab|provided by the|this software|this program|misrepresented|advertising materials|this (?:library|file)|[al]?gpl"

#: Normalised sentences of public licence texts and notices, with identifiers.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    4: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    5: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    6: "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    10: "licensed under the apache license version 2 0",
    11: "licensed under the apache license version 2 0 the license",
    12: "you may not use this file except in compliance with the license",
    13: "you may obtain a copy of the license at",
    14: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    15: "see the license for the specific language governing permissions and limitations under the license",
    20: "this work is licensed under the gnu general public license version 3",
    21: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    22: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    23: "see the gnu general public license for more details",
    24: "this program is free software",
    25: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    30: "licensed under cc by nc 4 0",
    31: "licensed under cc by 4 0",
    32: "licensed under cc by sa 4 0",
    33: "this work is licensed under a creative commons attribution 4 0 international license",
    34: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    35: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    40: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    41: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    42: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    43: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    44: "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    50: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    60: "this is free and unencumbered software released into the public domain",
    45: "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    46: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    51: "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    52: "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    53: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    70: "all rights reserved",
    80: "this software is provided as is without any express or implied warranty",
    81: "in no event will the authors be held liable for any damages arising from the use of this software",
    82: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    83: "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    84: "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required",
    85: "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    86: "distributed under the boost software license version 1 0",
    87: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    90: "this source code form is subject to the terms of the mozilla public license v",
    91: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    92: "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    93: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    94: "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    95: "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    96: "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
    97: "this software is distributed without any warranty",
    98: "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
}
#: The end of a BSD licence, for whoever it names.
_DAMAGES = (
    "in no event shall the {} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data "
    "or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this "
    "software even if advised of the possibility of such damage"
)
_WHO = ("copyright holder or contributors", "copyright holders or contributors", "copyright owner or contributors", "author", "regents or contributors")
DAMAGES = {110 + i: _DAMAGES.format(who) for i, who in enumerate(_WHO)}
DISCLAIMED = {120 + i: SENTENCES[44].replace("copyright holders and contributors", who) for i, who in enumerate(("author", "regents and contributors", "copyright holder and contributors"))}
#: Sentences that name someone, as patterns of normalised text, and the sentence each stands for.
_END = "endorse or promote products derived from (?:[a-z0-9]+ ){1,6}without (?:specific |express |prior |written ){1,4}permission"
HOLES = {
    43: f"neither (?:the )?names? (?:[a-z0-9]+ ){{1,20}}may be used to {_END}",
    45: f"(?:the )?names? (?:[a-z0-9]+ ){{1,20}}(?:may|must) not be used to {_END}",
    44: SENTENCES[44].replace("the copyright holders and contributors", "(?:[a-z0-9]+ ){1,10}?[a-z0-9]+"),
    110: _DAMAGES.replace("the {}", "(?:[a-z0-9]+ ){1,14}?[a-z0-9]+"),
}
#: The GNU licences, their short names and versions, and the heads of their full texts.
GNU = (
    ("gnu general public license", "gpl", "GPL", (("2", "june 1991"), ("3", "29 june 2007"))),
    ("gnu lesser general public license", "lgpl", "LGPL", (("2.1", "february 1999"), ("3", "29 june 2007"))),
    ("gnu library general public license", "lgpl", "LGPL", (("2", "june 1991"),)),
    ("gnu affero general public license", "agpl", "AGPL", (("3", "19 november 2007"),)),
)
#: Names under which texts name other licences.
NAMED = {
    "apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0", "mit license": "MIT", "bsd 2 clause license": "BSD-2-Clause", "bsd 3 clause license": "BSD-3-Clause",
    "apache license version 2 0 january 2004": "Apache-2.0", "isc license": "ISC", "mozilla public license version 2 0": "MPL-2.0", "mozilla public license 2 0": "MPL-2.0", "eclipse public license 2 0": "EPL-2.0", "boost software license version 1 0": "BSL-1.0",
}
CC = {"": "BY", " noncommercial": "BY-NC", " sharealike": "BY-SA", " noderivatives": "BY-ND", " noncommercial sharealike": "BY-NC-SA", " noncommercial noderivatives": "BY-NC-ND"}
LEADS = ("licensed under the ", "released under the ", "distributed under the ", "this work is licensed under the ", "this software is licensed under the ", "this program is licensed under the ")


def _generated() -> tuple[dict[int, str], list[tuple[str, tuple[int, ...]]], dict[int, str]]:
    """Sentences that differ in a name or a version, from 200 on: (sentences, rules of
    several, licence of those that are one alone)."""
    said, rules, alone = {}, [], {}
    known = {s: i for i, s in SENTENCES.items()}

    def add(sentence: str, licence: str | None) -> int:
        i = known.setdefault(sentence, 200 + len(said))
        if i >= 200:
            said[i] = sentence
        if licence and i not in _ALONE:
            alone.setdefault(i, licence)
        return i

    for name, short, spdx, versions in GNU:
        for version, date in versions:
            v, full = version.replace(".", " "), f"{spdx}-{version if '.' in version else version + '.0'}"
            grant = f"you can redistribute it and or modify it under the terms of the {name} as published by the free software foundation either version {v} of the license or at your option any later version"
            later, only = f"{full}-or-later", f"{full}-only"
            one = add(grant, later)
            for thing in ("program", "library", "file", "software"):
                free = add(f"this {thing} is free software", None)
                whole = add(f"this {thing} is free software {grant}", later)
                hope = add(f"this {thing} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", None)
                see = add(f"see the {name} for more details", None)
                rules += [(later, (whole, hope, see)), (later, (free, one, hope, see)), (later, (free, one))]
            add(f"you can redistribute it and or modify it under the terms of the {name} version {v} as published by the free software foundation", only)
            add(f"you can redistribute it and or modify it under the terms of version {v} of the {name} as published by the free software foundation", only)
            add(f"{name} version {v} {date}", full)
            for called in (f"{name} version {v}", f"{name} v{v}", f"{short} version {v}", f"{short} v{v}", f"{short}v{v}"):
                for lead in ("", *LEADS[:4]):
                    add(lead + called, full)
                    add(f"{lead}{called} or later", later)
    for name, licence in NAMED.items():
        for lead in (*LEADS, "", "the "):
            add(lead + name, licence)
    for short, licence in (("mit", "MIT"), ("apache 2 0", "Apache-2.0"), ("bsd 2 clause", "BSD-2-Clause"), ("bsd 3 clause", "BSD-3-Clause"), ("isc", "ISC"), ("mpl 2 0", "MPL-2.0")):
        for said_as in (f"license {short}", f"licence {short}", f"licensed under {short}", f"{short} licensed", *(f"{what} is {short} licensed" for what in ("the code", "this code", "this project", "this software", "this package", "it"))):
            add(said_as, licence)
        for tail in ("see license", "see the license file", "see license for details", "see the license file for details"):
            for lead in LEADS[:2]:
                add(f"{lead}{short} license {tail}", licence)
    for rest, short in CC.items():
        for version, kind in (("4 0", "international"), ("3 0", "unported")):
            add(f"this work is licensed under a creative commons attribution{rest} {version} {kind} license", f"CC-{short}-{version.replace(' ', '.')}")
        for lead in ("", "this work is "):
            add(f"{lead}licensed under cc {short.lower().replace('-', ' ')} 4 0", f"CC-{short}-4.0")
    return said, rules, alone


#: Sentences that are a licence by themselves.
_ALONE = {
    1: "MIT", 2: "MIT", 11: "Apache-2.0", 10: "Apache-2.0", 20: "GPL-3.0", 21: "GPL-3.0-or-later", 30: "CC-BY-NC-4.0", 31: "CC-BY-4.0", 32: "CC-BY-SA-4.0", 33: "CC-BY-4.0", 34: "CC-BY-NC-4.0", 35: "CC-BY-SA-4.0",
    50: "ISC", 53: "0BSD", 60: "Unlicense", 70: "Proprietary", 82: "Zlib", 86: "BSL-1.0", 87: "BSL-1.0", 91: "MPL-2.0", 92: "MPL-2.0", 93: "EPL-2.0", 94: "EPL-1.0", 95: "CC0-1.0", 96: "CC0-1.0", 98: "WTFPL",
}
_SAID, _GNU_RULES, _NAMES = _generated()
SENTENCES |= DAMAGES | DISCLAIMED | _SAID
ALONE = _ALONE | _NAMES
_BSD = [(name, (*head, end, *tail)) for name, head in (("BSD-4-Clause", (40, 41, 42, 46, 43)), ("BSD-3-Clause", (40, 41, 42, 43)), ("BSD-3-Clause", (40, 41, 42, 45)), ("BSD-2-Clause", (40, 41, 42))) for end in (44, *DISCLAIMED) for tail in (*((d,) for d in DAMAGES), ())]
#: Licences by their sentences in order; the first rule that matches wins, longer ones
#: are tried first, and what a sentence is alone (``ALONE``) last.
RULES = tuple(
    sorted(
        [
            ("MIT", (3, 4, 5, 6)), ("MIT", (3, 4, 5)), ("MIT", (3, 4)), ("Apache-2.0", (11, 12, 13, 14, 15)), ("Apache-2.0", (10, 12, 13, 14, 15)), ("GPL-3.0-or-later", (21, 22, 23)),
            ("ISC", (50, 51, 52)), ("0BSD", (53, 51, 52)), ("Zlib", (80, 81, 82, 83, 84, 85)), ("Zlib", (82, 83, 84, 85)), ("MPL-2.0", (90, 91)), ("MPL-2.0", (90, 92)), ("CC0-1.0", (95, 97)), *_BSD, *_GNU_RULES,
        ],
        key=lambda r: -len(r[1]),
    )
)
#: "All rights reserved" says nothing where a licence follows.
UNLESS = "Proprietary"


def normalised(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(s, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+", " "))


#: In a text of sentences "|" is a cut that a known sentence cannot span, "/" one that it can.
#: Sentences by themselves come before wrapped ones, longer before shorter (``KNOWN``).
def _tree(sentences, gap: str) -> str:
    """Pattern of all sentences, word by word; of those that match at a place the longest."""
    root: dict = {}
    for s in sentences:
        node = root
        for word in s.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def after(node: dict) -> str:
        parts = [gap + word + after(below) for word, below in node.items() if word]
        if not parts:
            return ""
        return parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)}){'?' if '' in node else ''}"

    return "|".join(word + after(below) for word, below in root.items())


_HOLED = "|".join(HOLES.values())
KNOWN = rf"(?<=[|/])(?:{_tree(SENTENCES.values(), ' ')}|{_HOLED}|{_tree(SENTENCES.values(), '[ /]')}|{_HOLED.replace(' ', '[ /]')})(?=[|/])"
#: An expression of SPDX identifiers, what parts it, and what in it is no licence.
SPDX, SPDX_PARTS, SPDX_EXCEPTION = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", r"[() \t]+(?:AND|OR|and|or)[() \t]+|[()]+", r"[ \t]+(?:WITH|with)[ \t]+[A-Za-z0-9.-]+"
_SPDX_ID = r"^[A-Za-z0-9][A-Za-z0-9.-]*\+?$"


def spdx(text: Column) -> Column:
    """The licences of all SPDX expressions of a text, in order."""
    parts = lambda e: F.split(F.regexp_replace(e, SPDX_EXCEPTION, ""), SPDX_PARTS)
    ids = F.flatten(F.transform(matches(text, SPDX, 1), lambda e: F.transform(parts(e), lambda p: F.trim(p))))
    return F.transform(F.filter(ids, lambda p: p.rlike(_SPDX_ID)), lambda p: F.regexp_replace(p, r"\+$", "-or-later"))


def marked(text: Column) -> Column:
    """The normalised sentences, blank ones left out, each with the mark of the cut
    after it; a mark before all."""

    def part(s: Column, i: Column, cuts: Column) -> Column:
        cut = F.coalesce(F.get(cuts, i), F.lit("."))
        hard = cut.rlike(r"[.!?]|\n\r?\n|\r\r") | s.rlike(r"[.!?][^A-Za-z0-9]*$")
        return let(normalised(s), lambda n: F.when(n == "", "|").otherwise(F.concat(n, F.when(hard, "|").otherwise("/"))))

    parts = F.array_join(let(matches(text, SPLIT), lambda cuts: F.transform(F.split(text, SPLIT, -1), lambda s, i: part(s, i, cuts))), "")
    # A blank sentence (a blank line, or comment marks alone) makes the cut before it hard.
    joined = F.regexp_replace(F.concat(F.lit("|"), parts), r"[|/]*\|[|/]*", "|")
    return F.regexp_replace(joined, r"(?<=[|/])(?:dnl|rem) ", "")


def known_sentences(text: Column) -> Column:
    """array<struct<sentence, id>>: place (from 0, blank ones not counted) and
    identifier of the known sentences."""
    table = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    none = F.array().cast("array<struct<sentence:int,id:int>>")
    cuts = lambda s: F.length(s) - F.length(F.translate(s, "|/", ""))

    def placed(x: Column) -> Column:
        gaps, sizes = F.transform(F.slice(x["gaps"], 1, F.size(x["found"])), cuts), F.transform(x["found"], cuts)
        both = F.struct(gaps.alias("g"), sizes.alias("n"), F.transform(F.zip_with(gaps, sizes, lambda g, n: (g + n).cast("bigint")), lambda c: c).alias("both"))
        at = let(both, lambda y: F.zip_with(running(y["both"]), y["n"], lambda end, n: end - n))  # cuts before the sentence

        def identified(s: Column) -> Column:
            holed = F.lit(None).cast("int")
            for i, pattern in reversed(HOLES.items()):
                holed = F.when(s.rlike(f"^(?:{pattern})$"), i).otherwise(holed)
            return F.coalesce(F.try_element_at(table, s), holed)

        hit = lambda s, a: F.struct((a - 1).cast("int").alias("sentence"), let(F.translate(s, "/", " "), identified).alias("id"))
        return F.when(F.size(x["found"]) > 0, F.zip_with(x["found"], at, hit)).otherwise(none)

    found = let(marked(F.regexp_replace(text, ABBREVIATED, "$1 ")), lambda m: let(F.struct(matches(m, KNOWN).alias("found"), between(m, KNOWN).alias("gaps")), placed))
    return F.when(text.rlike(ANCHOR), found).otherwise(none)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, known, licences, fragments): known sentences in order, licences found
    (distinct, sorted), identifiers that no rule took."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    known, named = known_sentences(text), F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), spdx(text)).otherwise(F.array().cast("array<string>"))

    table = F.create_map(*[F.lit(x) for i, name in sorted(ALONE.items()) for x in (str(i), name)])

    def judged(k: Column) -> Column:
        joined = F.array_join(F.transform(k, lambda x: F.concat(F.lit("|"), x["id"].cast("string"), F.lit("|"))), "")
        state = F.struct(joined.alias("left"), F.array().cast("array<string>").alias("licences"))
        rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in ids)).alias("ids")) for name, ids in RULES])

        def step(a: Column, r: Column) -> Column:
            hit = F.contains(a["left"], r["ids"])
            return F.struct(
                F.when(hit, F.replace(a["left"], r["ids"], F.lit("|*|"))).otherwise(a["left"]).alias("left"),
                F.when(hit, F.array_append(a["licences"], r["name"])).otherwise(a["licences"]).alias("licences"),
            )

        def finished(e: Column) -> Column:
            left = F.regexp_extract_all(e["left"], F.lit("[0-9]+"), F.lit(0))
            own = F.filter(F.transform(left, lambda i: F.try_element_at(table, i)), lambda x: x.isNotNull())
            every = F.array_sort(F.array_distinct(F.concat(e["licences"], own, F.col("_named"))))
            licences = F.when(F.size(every) > 1, F.array_remove(every, UNLESS)).otherwise(every)
            return F.struct(k.alias("known"), licences.alias("licences"), F.filter(left, lambda i: F.try_element_at(table, i).isNull()).alias("fragments"))

        end = F.when(F.size(k) > 1, F.aggregate(rules, state, step)).otherwise(state)
        return let(end, finished)

    rows = docs.select(F.col(id_col).alias(id_col), named.alias("_named"), known.alias("_known"))
    return rows.select(id_col, let(F.col("_known"), judged).alias("r")).select(id_col, "r.known", "r.licences", "r.fragments")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("known").cast("long").alias("n_sentences"),
        F.array_join(F.transform("known", lambda k: F.concat(k["sentence"].cast("string"), F.lit(":"), k["id"].cast("string"))), ",").alias("sentences"),
        F.array_join("licences", ",").alias("licenses"),
        F.array_join("fragments", ",").alias("fragments"),
    )


def oracle() -> str:
    """The same rules in DuckDB SQL."""
    table = ", ".join(f"({i}, '{s}')" for i, s in SENTENCES.items())
    alone = ", ".join(f"('{i}', '{name}')" for i, name in sorted(ALONE.items()))
    rules = ", ".join(f"({n}, '{name}', '{''.join(f'|{i}|' for i in ids)}')" for n, (name, ids) in enumerate(RULES))
    holes = "case " + " ".join(f"when regexp_full_match(s, '{p}') then {i}" for i, p in HOLES.items()) + " end"
    return f"""
with known(id, s) as (values {table}),
d as (select row_number() over () as r, doc_id, coalesce(text, '') as whole, regexp_replace(coalesce(text, ''), '{ABBREVIATED}', '\\1 ', 'g') as text from documents),
spdx as (select r, list(regexp_replace(trim(u), '\\+$', '-or-later')) filter (regexp_matches(trim(u), '{_SPDX_ID}')) as names
         from (select r, unnest(string_split_regex(regexp_replace(x, '{SPDX_EXCEPTION}', '', 'g'), '{SPDX_PARTS}')) as u from (select r, unnest(regexp_extract_all(whole, '{SPDX}', 1)) as x from d) y) z group by r),
parts as (select r, p, trim(regexp_replace(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) as s
          from (select r, unnest(t) as u, unnest(range(len(t))) as p from (select r, string_split_regex(text, '{SPLIT}') as t from d) x) y),
placed as (select r, s, row_number() over (partition by r order by p) - 1 as sentence from parts where s <> ''),
hits as (select r, sentence, coalesce(known.id, hole) as id from (select *, {holes} as hole from placed) p left join known using (s) where coalesce(known.id, hole) is not null),
seq as (select r, count(*) as n, string_agg(concat(sentence, ':', id), ',' order by sentence) as sentences,
          string_agg(concat('|', id, '|'), '' order by sentence) as joined from hits group by r),
rules(n, name, ids) as (values {rules}),
alone(id, name) as (values {alone}),
eaten as (with recursive e(r, n, left_, names) as (
    select r, 0, joined, [] :: varchar[] from seq
    union all
    select e.r, e.n + 1, replace(e.left_, k.ids, '|*|'), case when contains(e.left_, k.ids) then list_append(e.names, k.name) else e.names end from e join rules k on k.n = e.n)
  select * from e where n = {len(RULES)}),
rest as (select r, unnest(regexp_extract_all(left_, '[0-9]+')) as id, unnest(range(len(regexp_extract_all(left_, '[0-9]+')))) as p from eaten),
own as (select r, list(alone.name) filter (alone.name is not null) as names, string_agg(rest.id, ',' order by p) filter (alone.name is null) as fragments from rest left join alone using (id) group by r),
every as (select r, list_sort(list_distinct(list_concat(coalesce(eaten.names, []), coalesce(own.names, []), coalesce(spdx.names, [])))) as names, coalesce(own.fragments, '') as fragments
  from eaten left join own using (r) full join spdx using (r))
select doc_id, coalesce(n, 0) as n_sentences, coalesce(sentences, '') as sentences,
  coalesce(array_to_string(case when len(names) > 1 then list_filter(names, lambda x: x <> '{UNLESS}') else names end, ','), '') as licenses,
  coalesce(fragments, '') as fragments
from d left join seq using (r) left join every using (r)
"""


OP9_SQL = oracle()
