"""License detection by ordered signature rules.

Texts are reduced to words (A-Z lower-cased) joined by one space, so rules need not know punctuation or line
ends. Rules are matched on bytes, in which that space is the only white space: U+00A0 and its kind belong to words. Each rule is
a regular expression with a priority, a confidence and the words it cannot do without; it runs only on texts that hold
those words. Detections are resolved by priority, then length: one that lies inside an accepted one is suppressed, by a sweep
over interval starts. Base phrases are counted apart and keep their labels.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows give a row each; very long texts are
scanned whole, in time that grows with their length (times a logarithm), however many mentions they hold; other columns may
have any name and are carried only if asked for.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_TABLE = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))

#: Base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label; its SPDX tag as words (or -); its names, as expressions over normalised words. Fixed values.
FAMILIES = """
mit | mit | mit|expat
mit-0 | mit 0 | mit no attribution|mit 0
x11 | x11 | x11|mit x11|x consortium
isc | isc | isc
0bsd | 0bsd | zero clause bsd|0 clause bsd|0bsd
bsd-2-clause | bsd 2 clause | bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd
bsd-3-clause | bsd 3 clause | bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd
bsd-4-clause | bsd 4 clause | bsd 4 clause|4 clause bsd|original bsd
bsd | - | bsd|bsd style
apache-2 | apache 2 0 | apache(?: software)? (?:license )?(?:version |v)?2(?: 0)?|apache 2(?: 0)?|apache license version 2(?: 0)?
apache-1.1 | apache 1 1 | apache (?:license )?(?:version |v)?1 1
apache | - | apache|apache software
gpl-3.0 | gpl 3 0(?: only| or later)? | (?:gnu )?gpl ?(?:version |v )?v?3(?: 0)?|gnu general public license (?:version |v)3|gplv3
gpl-2.0 | gpl 2 0(?: only| or later)? | (?:gnu )?gpl ?(?:version |v )?v?2(?: 0)?|gnu general public license (?:version |v)2|gplv2
gpl-1.0 | gpl 1 0(?: only| or later)? | gnu general public license (?:version |v)1
gpl | - | (?:gnu )?gpl|gnu general public
lgpl-3.0 | lgpl 3 0(?: only| or later)? | (?:gnu )?lgpl ?(?:version |v )?v?3|gnu lesser general public license (?:version |v)3|lgplv3
lgpl-2.1 | lgpl 2 1(?: only| or later)? | (?:gnu )?lgpl ?(?:version |v )?v?2 1|gnu lesser general public license (?:version |v)2 1
lgpl-2.0 | lgpl 2 0(?: only| or later)? | gnu library general public license (?:version |v)2
lgpl | - | (?:gnu )?lgpl|gnu lesser general public|gnu library general public
agpl-3.0 | agpl 3 0(?: only| or later)? | (?:gnu )?agpl ?(?:version |v )?v?3|gnu affero general public license (?:version |v)3|agplv3
agpl | - | (?:gnu )?agpl|gnu affero general public
gfdl | gfdl 1 [123](?: only| or later)? | gnu free documentation
mpl-2.0 | mpl 2 0 | mozilla public license (?:version |v)?2(?: 0)?|mpl (?:version |v)?2(?: 0)?
mpl-1.1 | mpl 1 1 | mozilla public license (?:version |v)?1 1|mpl (?:version |v)?1 1
mpl | - | mozilla public|mpl
epl-2.0 | epl 2 0 | eclipse public license (?:version |v)?2(?: 0)?|epl (?:version |v)?2(?: 0)?
epl-1.0 | epl 1 0 | eclipse public license (?:version |v)?1(?: 0)?|epl (?:version |v)?1(?: 0)?
epl | - | eclipse public
cddl | cddl 1 [01] | common development and distribution|cddl
cpl-1.0 | cpl 1 0 | common public
eupl | eupl 1 [12] | european union public|eupl
unlicense | unlicense | unlicense
wtfpl | wtfpl | do what the fuck you want to public|wtfpl
zlib | zlib | zlib|zlib libpng
libpng | libpng | libpng
bsl-1.0 | bsl 1 0 | boost software|boost
artistic-2.0 | artistic 2 0 | artistic license 2 0|perl artistic
artistic-1.0 | artistic 1 0 | artistic license 1 0
python-2.0 | python 2 0 | python software foundation|psf
postgresql | postgresql | postgresql
openssl | openssl | openssl
ruby | ruby | ruby
php | php 3 0[01]? | php license version 3|php
ofl-1.1 | ofl 1 1 | sil open font|open font
cc0-1.0 | cc0 1 0 | cc0|cc0 1 0|cc zero|creative commons zero
cc-by-nc-nd | cc by nc nd [1-4] [05] | cc by nc nd|creative commons attribution noncommercial noderivatives|creative commons attribution non commercial no derivatives
cc-by-nc-sa | cc by nc sa [1-4] [05] | cc by nc sa|creative commons attribution noncommercial sharealike|creative commons attribution non commercial share alike
cc-by-nc | cc by nc [1-4] [05] | cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial
cc-by-nd | cc by nd [1-4] [05] | cc by nd|creative commons attribution noderivatives|creative commons attribution no derivatives
cc-by-sa | cc by sa [1-4] [05] | cc by sa|creative commons attribution sharealike|creative commons attribution share alike
cc-by | cc by [1-4] [05] | cc by|creative commons attribution
cc | - | creative commons
public-domain | - | public domain
odbl | odbl 1 0 | open database|odbl
odc-by | odc by 1 0 | open data commons attribution
ms-pl | ms pl | microsoft public|ms pl
ms-rl | ms rl | microsoft reciprocal
sspl | sspl 1 0 | server side public|sspl
busl | busl 1 1 | business source
upl | upl 1 0 | universal permissive
ncsa | ncsa | university of illinois ncsa|ncsa
"""
#: Sentences of well-known license texts and notices, written by hand: label | expression. Fixed values.
TEXTS = r"""
mit | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | this (?:project|code|package|module|library|software|repository) is (?:mit licensed|licensed mit|under mit)
mit | mit licen[sc]ed
mit-0 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd | redistribution and use in source and binary forms with or without modification are permitted
bsd | use of this source code is governed by a bsd style license
bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
bsd-3-clause | neither the name of (?:\S+ ){1,8}nor the names of its contributors
bsd-3-clause | the names? of (?:\S+ ){1,8}may not be used to endorse or promote products derived from this software
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2 | you may not use this file except in compliance with the license
apache-2 | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2 | www apache org licenses license 2 0(?: txt| html)?
apache-2 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1 | this product includes software developed by the apache (?:software foundation|group)
gpl | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | you should have received a copy of the gnu general public license
gpl-2.0 | published by the free software foundation either version 2 of the license
gpl-2.0 | gnu general public license as published by the free software foundation version 2
gpl-3.0 | gnu general public license as published by the free software foundation either version 3 of the license
gpl-3.0 | www gnu org licenses gpl 3 0(?: html| txt| en html)?
gpl-2.0 | www gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt| en html)?
lgpl | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | you should have received a copy of the gnu lesser general public license
lgpl-2.1 | gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-3.0 | gnu lesser general public license as published by the free software foundation either version 3 of the license
agpl-3.0 | gnu affero general public license as published by the free software foundation either version 3 of the license
agpl | you should have received a copy of the gnu affero general public license
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1 | alternatively the contents of this file may be used under the terms of either the gnu general public license version 2 or later
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
epl-1.0 | all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl | www eclipse org legal epl (?:v10 html|2 0|v20 html)
cddl | the contents of this file are subject to the terms of the common development and distribution license
cpl-1.0 | the accompanying program is provided under the terms of this common public license
eupl | licensed under the eupl version 1 [12]
unlicense | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng | this copy of the libpng notices is provided for your convenience
bsl-1.0 | boost software license version 1 0
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
bsl-1.0 | www boost org license 1 0 txt
artistic-2.0 | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed this license establishes the terms under which a given free software package
artistic | (?:this is free software you can redistribute it and or modify it|it may be distributed) under the same terms as perl(?: itself)?
python-2.0 | psf is making python available to licensee on an as is basis
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
openssl | this product includes software developed by the openssl project
ssleay | this product includes cryptographic software written by eric young
ijg | this software is based in part on the work of the independent jpeg group
curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
ofl-1.1 | this font software is licensed under the sil open font license version 1 1
cc0-1.0 | to the extent possible under law (?:\S+ ){1,8}waived all copyright
cc0-1.0 | creativecommons org publicdomain zero 1 0
cc-by-nc-nd | creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc-sa | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc | creativecommons org licenses by nc [1-4] [05]
cc-by-nd | creativecommons org licenses by nd [1-4] [05]
cc-by-sa | creativecommons org licenses by sa [1-4] [05]
cc-by | creativecommons org licenses by [1-4] [05]
cc-by-sa | text is available under the creative commons attribution share ?alike license
cc-by | this is an open access article distributed under the terms of the creative commons attribution license
cc-by-nc | for non ?commercial (?:use|purposes) only
public-domain | (?:this|the) (?:work|file|software|text|code|document|image) (?:is|has been (?:released|placed|dedicated)|was (?:released|placed|dedicated)) (?:in|into|to) the public domain
public-domain | released (?:in|into|to) the public domain
odbl | any rights in individual contents of the database are licensed under the database contents license
ms-pl | this license governs use of the accompanying software if you use the software you accept this license
sspl | if you make the functionality of the program or a modified version available to third parties as a service
busl | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
ncsa | developed by (?:\S+ ){1,8}university of illinois
json | the software shall be used for good not evil
beerware | you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer
proprietary | all rights reserved
proprietary | (?:alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)
proprietary | proprietary and confidential
proprietary | confidential and proprietary
proprietary | unauthorized (?:copying|reproduction|distribution|use) of this (?:file|text|document|work|software|material)
proprietary | no part of this (?:publication|document|book|work|text) may be reproduced
proprietary | (?:for internal use only|not for (?:public )?distribution|do not (?:copy or )?distribute)
proprietary | this (?:document|file|software|text) contains (?:proprietary|confidential) information
proprietary | subject to the terms of (?:the|an?) end user licen[sc]e agreement
"""
#: Forms in which a family is named: priority (lower first), confidence, expression around NAME or TAG.
FORMS = (
    (0, 1.0, r"spdx license identifier TAG"),
    (2, 0.95, r"(?:licensed|licenced|released|distributed|available|published|provided|made available) under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?: (?:public )?(?:license|licence)s?)?"),
    (3, 0.9, r"under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?: (?:public )?(?:license|licence)s?)"),
    (4, 0.8, r"(?:license|licence)(?: type)? (?:is )?(?:the )?(?:NAME)"),
    (5, 0.7, r"(?:NAME) (?:public )?(?:license|licence)"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern[bytes]
    needs: frozenset[bytes]
    holds: tuple[bytes, ...]  # literals of every match


def _needs(expression: str) -> frozenset[bytes]:
    """Words that every match holds: whole words of the expression outside all groups."""
    flat = expression
    while (less := re.sub(r"(?:\(\?:)[^()]*\)[?*+]?(?:\{[\d,]+\})?", "\0", flat)) != flat:
        flat = less
    return frozenset(w.encode() for w in re.findall(r"(?<![^ \0])[a-z][a-z0-9]+(?= [a-z0-9]| \0|$)", flat.replace("\0", " \0 ").replace("  ", " ")))


def _literals(expression: str) -> tuple[bytes, ...]:
    """Runs of characters, of two and more, that every match holds; the rarest kinds (short ones) first."""
    out: set[str] = set()

    def walk(parsed) -> None:
        run = ""
        for op, arg in [*parsed, (None, None)]:
            if str(op) == "LITERAL":
                run += chr(arg)
                continue
            out.add(run)
            run = ""
            if str(op) == "SUBPATTERN":
                walk(arg[3])

    walk(re._parser.parse(expression))
    return tuple(x.encode() for x in sorted((x for x in out if len(x) > 1), key=lambda x: (len(x), x)))


def _whole(expression: str) -> re.Pattern[bytes]:
    """The expression over whole words: in bytes only ASCII white space is \\s."""
    return re.compile(rf"(?<!\S)(?:{expression})(?!\S)".encode())


def rules() -> tuple[Rule, ...]:
    out = []

    def add(label: str, priority: int, confidence: float, expression: str, name: str = "") -> None:
        out.append(Rule(label, priority, confidence, _whole(expression), _needs(name) or _needs(expression), _literals(expression)))

    for line in FAMILIES.strip().splitlines():
        label, tag, names = (x.strip() for x in line.split(" | ", 2))
        for priority, confidence, form in FORMS:
            if "TAG" in form:
                if tag != "-":
                    add(label, priority, confidence, form.replace("TAG", tag))
            else:
                for name in re.split(r"\|(?![^(]*\))", names):
                    add(label, priority, confidence, form.replace("NAME", name), name)
        if label.startswith("cc-"):  # abbreviations that say enough without the word license
            add(label, 4, 0.8, tag)
            add(label, 5, 0.7, names.split("|")[0])
    for line in TEXTS.strip().splitlines():
        label, expression = (x.strip() for x in line.split(" | ", 1))
        add(label, 1 if label != "proprietary" else 6, 0.9 if label != "proprietary" else 0.5, expression)
    for phrase, label in BASE.items():
        add(label, 5, 0.8, phrase)
    return tuple(sorted(out, key=lambda r: (r.priority, r.label, r.pattern.pattern)))


_RULES: list[dict[bytes, list[tuple[int, Rule]]]] = []


def _by_word() -> dict[bytes, list[tuple[int, Rule]]]:
    """The rules by a word that they need (b"" for those that need none), with their ranks."""
    if not _RULES:
        by: dict[bytes, list[tuple[int, Rule]]] = {}
        for i, r in enumerate(rules()):
            by.setdefault(max(r.needs, key=lambda w: (len(w), w), default=b""), []).append((i, r))
        _RULES.append(by)
    return _RULES[0]


class _Reach:
    """The furthest end of the accepted intervals that start at or before a place: a binary indexed tree of maxima over sorted starts."""

    def __init__(self, starts: list[int]):
        self.starts, self.ends = starts, [-1] * (len(starts) + 1)

    def accept(self, start: int, end: int) -> None:
        i = bisect_left(self.starts, start) + 1
        while i < len(self.ends):
            self.ends[i] = max(self.ends[i], end)
            i += i & -i

    def holds(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, start) + 1
        while i:
            if self.ends[i] >= end:
                return True
            i -= i & -i
        return False


def detect(text: bytes, words: set[bytes]) -> list[tuple[int, int, Rule]]:
    """Detections that remain, by place. text: normalised words joined by one space; words: those in it."""
    by = _by_word()
    here: dict[bytes, bool] = {}

    def holds(literal: bytes) -> bool:
        if literal not in here:
            here[literal] = literal in text
        return here[literal]

    tried = sorted((x for w in (by.keys() & words) | {b""} for x in by.get(w, ()) if x[1].needs <= words and all(map(holds, x[1].holds))), key=lambda x: x[0])
    found = [(m.start(), m.end(), r) for _, r in tried for m in r.pattern.finditer(text)]
    found.sort(key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].label))
    accepted, kept = _Reach(sorted({a for a, _, _ in found})), []
    for a, b, r in found:
        if not accepted.holds(a, b):
            accepted.accept(a, b)
            kept.append((a, b, r))
    return sorted(kept, key=lambda x: (x[0], x[1]))


_BASE = [(_whole(p), label) for p, label in BASE.items()]
SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,first:long,end:long>>"
_NONE = (0, None, None, "", "", 0.0, [])


def scan_text(text: str | None) -> tuple:
    """The columns of SCHEMA."""
    words = text.encode().translate(_TABLE).split() if text else []
    if not words:
        return (0, *_NONE)
    joined = b" ".join(words)
    places = [(m.start(), label) for p, label in _BASE for m in p.finditer(joined)]
    found = detect(joined, set(words))
    if not found and not places:
        return (len(words), *_NONE)
    begins, at = [], 0
    for w in words:
        begins.append(at)
        at += len(w) + 1
    starts = [bisect_left(begins, a) for a, _ in places]
    base = {label for _, label in places}
    spans = [{"label": r.label, "first": bisect_left(begins, a), "end": bisect_left(begins, b)} for a, b, r in found]
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {r.label for _, _, r in found})), max((r.confidence for _, _, r in found), default=0.0), spans,
    )


def scan(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and those of SCHEMA for every document."""
    more = StructType.fromDDL(SCHEMA)
    names = [f.name for f in more]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                rows = [scan_text(t) for t in batch.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*keep, *names])

    chosen = documents.select(*keep, F.col("text").alias("_text"))
    return chosen.mapInArrow(run, StructType([chosen.schema[c] for c in keep] + more.fields))
