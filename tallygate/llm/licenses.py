"""License scans: phrases, and templates with optional and replaceable regions.

A template is written in the mark-up of public license lists: ``<<beginOptional>>`` ...
``<<endOptional>>`` around words that may be missing, ``<<var;match=a-b>>`` for a to b words
of any kind; everything else is mandatory wording. It is compiled into an automaton over
words. A text (or a place in it) is accepted if the automaton runs through it, that is, if the
mandatory wording matches exactly. Licenses that are short are templates from their grant
to the end of their disclaimer; long ones (Apache, GPL, MPL, Creative Commons) are told by
the notices that name them. A text that only opens like a license, and goes on otherwise, is
another license or part of one: it gets a label of its own and a lower score.

Automata are only started where a template's longest run of mandatory words stands, which
plain searching finds; texts without any cost little more than being split into words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: the contract's phrases -------------------------------------
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# --- Fixed values: license wordings ---------------------------------------------
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of"
    " <<var;match=1-6>> and associated documentation files (the"
    " <<var;match=1-3>>), to deal in the <<var;match=1-3>> without restriction, including"
    " without limitation the rights to use, copy, modify, merge, publish, distribute,"
    " sublicense, and/or sell copies of the <<var;match=1-3>>, and to permit persons to"
    " whom the <<var;match=1-3>> is furnished to do so, subject to the following"
    " conditions: The above copyright notice and this permission notice"
    " <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in"
    " all copies or substantial portions of the <<var;match=1-3>>"
)
_AS_IS = (
    " THE <<var;match=1-3>> IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match=1-8>> BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
    " FROM, OUT OF OR IN CONNECTION WITH THE <<var;match=1-3>> OR THE USE OR OTHER DEALINGS IN"
    " THE <<var;match=1-3>>"
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met"
)
_BSD_CONDITIONS = (
    ": <<var;match=0-1>> Redistributions of source code must retain the above copyright notice,"
    " this list of conditions and the following disclaimer. <<var;match=0-1>> Redistributions"
    " in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
_BSD_ADVERTISING = (
    " <<var;match=0-1>> All advertising materials mentioning features or use of this software must"
    " display the following <<var;match=1-1>> This product includes software developed by"
    " <<var;match=1-20>>."
)
_BSD_NAMES = (
    " <<var;match=0-1>> Neither the name of <<var;match=1-12>> nor the names of <<var;match=1-3>>"
    " contributors may be used to endorse or promote products derived from this software without"
    " specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY <<var;match=1-12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=1-12>> BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT"
    " NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;"
    " OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
    " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY"
    " OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and <<beginOptional>>or<<endOptional>> distribute this"
    " software for any purpose with or without fee is hereby granted, provided that the"
    " above copyright notice and this permission notice appear in all copies"
)
_UNLICENSE_GRANT = "This is free and unencumbered software released into the public domain"

TEMPLATES = {
    "mit": [
        "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>>"
        "<<beginOptional>>distributed<<endOptional>> under the"
        " <<beginOptional>>terms of the<<endOptional>> MIT License",
        _MIT_GRANT + _AS_IS,
    ],
    "x11": [
        _MIT_GRANT + _AS_IS + " Except as contained in this notice, the <<var;match=1-2>> of"
        " <<var;match=1-12>> shall not be used in advertising or otherwise to promote the sale,"
        " use or other dealings in <<var;match=1-3>> without prior written authorization from"
    ],
    "json": [
        _MIT_GRANT + " The Software shall be used for Good, not Evil." + _AS_IS,
    ],
    "apache-2": [
        "Licensed under the Apache License, Version 2.0"
        " <<beginOptional>>(the License); you may not use this file except in compliance with"
        " the License<<endOptional>>",
        "Apache License<<beginOptional>>, Version<<endOptional>> 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl-2": [
        "SPDX-License-Identifier: GPL-2.0 <<beginOptional>>only<<endOptional>>",
        "GPL-2.0-only",
        "GPL-2.0-or-later",
        "GNU General Public License <<beginOptional>>as published by the Free Software"
        " Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 2"
        " <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or at your option any later version<<endOptional>>",
    ],
    "gpl-3": [
        "SPDX-License-Identifier: GPL-3.0 <<beginOptional>>only<<endOptional>>",
        "GPL-3.0-only",
        "GPL-3.0-or-later",
        "GNU General Public License <<beginOptional>>as published by the Free Software"
        " Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 3"
        " <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or at your option any later version<<endOptional>>",
    ],
    "lgpl": [
        "SPDX-License-Identifier: LGPL-<<var;match=1-1>>.<<var;match=1-1>>",
        "GNU Lesser General Public License <<beginOptional>>as published by the Free Software"
        " Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version"
        " <<var;match=1-2>>",
    ],
    "agpl-3": [
        "SPDX-License-Identifier: AGPL-3.0",
        "GNU Affero General Public License <<beginOptional>>as published by the Free Software"
        " Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 3",
    ],
    "bsd-2": [_BSD_GRANT + _BSD_CONDITIONS + _BSD_DISCLAIMER],
    "bsd-3": [
        _BSD_GRANT + _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER,
        _BSD_GRANT + _BSD_CONDITIONS + " <<var;match=0-1>> The name of <<var;match=1-12>> may not"
        " be used to endorse or promote products derived from this software without specific prior"
        " written permission." + _BSD_DISCLAIMER,
    ],
    "bsd-4": [_BSD_GRANT + _BSD_CONDITIONS + _BSD_ADVERTISING + _BSD_NAMES + _BSD_DISCLAIMER],
    "isc": [
        _ISC_GRANT + " THE SOFTWARE IS PROVIDED AS IS AND <<var;match=1-12>> DISCLAIMS ALL"
        " WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;match=1-12>> BE LIABLE FOR ANY"
        " SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING"
        " FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER"
        " TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS"
        " SOFTWARE",
    ],
    "mpl-2": [
        "SPDX-License-Identifier: MPL-2.0",
        "subject to the terms of the Mozilla Public License, <<var;match=1-1>> 2.0",
    ],
    "unlicense": [
        _UNLICENSE_GRANT + ". Anyone is free to copy, modify, publish, use, compile, sell, or"
        " distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize"
        " copyright laws, the author or authors of this software dedicate any and all copyright"
        " interest in the software to the public domain. We make this dedication for the benefit"
        " of the public at large and to the detriment of our heirs and successors. We intend this"
        " dedication to be an overt act of relinquishment in perpetuity of all present and future"
        " rights to this software under copyright law." + _AS_IS,
    ],
    "cc-by": [
        "licensed under <<beginOptional>>a<<endOptional>> CC BY <<var;match=1-1>>.0",
        "Creative Commons Attribution <<var;match=1-1>>.0",
    ],
    "cc-by-sa": [
        "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA <<var;match=1-1>>.0",
        "Creative Commons Attribution-ShareAlike <<var;match=1-1>>.0",
    ],
    "cc-by-nc": [
        "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC <<var;match=1-1>>.0",
        "Creative Commons Attribution-NonCommercial <<var;match=1-1>>.0",
    ],
    "cc-by-nd": [
        "CC BY-ND <<var;match=1-1>>.0",
        "Creative Commons Attribution-NoDerivatives <<var;match=1-1>>.0",
        "Creative Commons Attribution-NoDerivs <<var;match=1-1>>.0",
    ],
    "cc-by-nc-sa": [
        "CC BY-NC-SA <<var;match=1-1>>.0",
        "Creative Commons Attribution-NonCommercial-ShareAlike <<var;match=1-1>>.0",
    ],
    "cc-by-nc-nd": [
        "CC BY-NC-ND <<var;match=1-1>>.0",
        "Creative Commons Attribution-NonCommercial-NoDerivatives <<var;match=1-1>>.0",
        "Creative Commons Attribution-NonCommercial-NoDerivs <<var;match=1-1>>.0",
    ],
    "cc0": [
        "CC0 1.0",
        "Creative Commons Zero",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

#: How licenses open. What goes on as none of the templates is like one, and no more.
OPENINGS = {
    "mit-like": [_MIT_GRANT],
    "bsd-like": [_BSD_GRANT],
    "isc-like": [_ISC_GRANT],
    "unlicense-like": [_UNLICENSE_GRANT],
}

#: What a document's best evidence is worth.
ACCEPTED, PHRASE_ONLY, OPENING_ONLY = 1.0, 0.8, 0.5

#: Bytes to words: A-Z lower-cased; digits, a-z and everything beyond ASCII stay; else a gap.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_MARK = re.compile(r"<<(beginOptional|endOptional|var;match=(\d+)-(\d+))>>")


def words_of(text: bytes) -> list[bytes]:
    """The contract's words, of a text in UTF-8."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``steps[s]`` are (word or None for any, next), ``skips[s]`` cost nothing."""

    label: str
    steps: tuple[tuple[tuple[bytes | None, int], ...], ...]
    skips: tuple[tuple[int, ...], ...]
    accept: int
    anchor: bytes  # the longest run of mandatory words
    before: tuple[int, int]  # fewest and most words in front of it
    worth: float = ACCEPTED

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.skips[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def run(self, words: list[bytes], start: int) -> int | None:
        """Where the longest accepted stretch from ``start`` ends, None if there is none."""
        states, at, end = self.closure({0}), start, None
        while states:
            if self.accept in states:
                end = at
            if at >= len(words):
                break
            word = words[at]
            states = self.closure(
                {after for s in states for want, after in self.steps[s] if want in (None, word)}
            )
            at += 1
        return end


def compile_template(label: str, template: str, worth: float = ACCEPTED) -> Automaton:
    """One automaton; optional regions do not nest."""
    steps: list[list] = [[]]
    skips: list[list[int]] = [[]]
    runs: list[tuple[list[bytes], int, int]] = []  # mandatory words, words before: least, most
    least = most = 0
    current: list[bytes] = []
    opened = None
    optional = 0

    def add(word: bytes | None) -> None:
        steps[-1].append((word, len(steps)))
        steps.append([])
        skips.append([])

    def close_run() -> None:
        nonlocal current
        if current:
            runs.append((current, least - len(current), most - len(current)))
        current = []

    position = 0
    for mark in [*_MARK.finditer(template), None]:
        literal = template[position : mark.start() if mark else len(template)]
        for word in words_of(literal.encode()):
            add(word)
            if opened is None:
                current.append(word)
                least, most = least + 1, most + 1
            else:
                optional += 1
        if mark is None:
            break
        position = mark.end()
        close_run()
        if mark[1] == "beginOptional":
            opened, optional = len(steps) - 1, 0
        elif mark[1] == "endOptional":
            skips[opened].append(len(steps) - 1)
            opened, most = None, most + optional
        else:
            for count in range(int(mark[3])):
                if count >= int(mark[2]):
                    skips[-1].append(-1)  # to the end of the region, known below
                add(None)
            for targets in skips:
                targets[:] = [len(steps) - 1 if t == -1 else t for t in targets]
            least, most = least + int(mark[2]), most + int(mark[3])
    close_run()
    run, fewest, furthest = max(runs, key=lambda r: len(b" ".join(r[0])))
    return Automaton(
        label, tuple(map(tuple, steps)), tuple(map(tuple, skips)), len(steps) - 1,
        b" ".join(run), (fewest, furthest), worth,
    )


def compiled(
    templates: dict[str, list[str]] = TEMPLATES, openings: dict[str, list[str]] = OPENINGS
) -> list[Automaton]:
    return [
        compile_template(label, template, worth)
        for kind, worth in ((templates, ACCEPTED), (openings, OPENING_ONLY))
        for label, listed in kind.items()
        for template in listed
    ]


@dataclass(frozen=True)
class Scan:
    n_words: int
    phrase_places: list[int]
    phrase_labels: set[str]
    spans: list[tuple[str, int, int]]  # label, first word, word after the last
    score: float


class Scanner:
    """Looks through one text after another."""

    def __init__(self, phrases: dict[str, str], automata: list[Automaton]):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.automata = automata

    def scan(self, text: bytes) -> Scan:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places, labels, spans = [], set(), []
        for phrase, label in self.phrases:
            found = list(_starts(line, phrase))
            if found:
                places.extend(found)
                labels.add(label)
        for automaton in self.automata:
            fewest, furthest = automaton.before
            ends: dict[int, int] = {}
            for at in _starts(line, b" " + automaton.anchor + b" "):
                for start in range(max(0, at - furthest), at - fewest + 1):
                    if start not in ends:
                        end = automaton.run(words, start)
                        if end is not None and end > at:
                            ends[start] = end
            reached = -1
            for start, end in sorted(ends.items()):
                if end > reached:  # not inside a stretch that began earlier
                    spans.append((automaton.label, start, end, automaton.worth))
                    reached = end
        spans = _outermost(spans)
        score = max([worth for *_, worth in spans] + [PHRASE_ONLY] * bool(places), default=0.0)
        return Scan(len(words), places, labels, [span[:3] for span in spans], score)


def _outermost(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Without those that are part of another label's longer stretch: it tells more."""
    out, label, first, after = [], None, 0, 0
    for span in sorted(spans, key=lambda s: (s[1], -s[2])):
        if span[2] > after or span[0] == label or span[1:3] == (first, after):
            out.append(span)
            if span[2] > after:
                label, first, after = span[:3]
    return out


def _starts(line: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which a phrase (a space before and after) starts."""
    at, counted, number = line.find(phrase), 0, 0
    while at >= 0:
        number += line.count(b" ", counted, at)
        counted = at
        yield number
        at = line.find(phrase, at + 1)


def scanned(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
    openings: dict[str, list[str]] = OPENINGS,
) -> DataFrame:
    """One row for every row of ``docs``; null texts count as empty.

    doc_id, n_words; n_base (places of phrases), first_word and last_word (of these places;
    null without any), base_labels; labels (with those of accepted templates; both sorted and
    joined by commas, empty if there are none); score (1 if a template is accepted, 0.8 with
    a phrase only, 0.5 with no more than an opening, else 0); spans (label, first word, word
    after the last of every accepted stretch). A row is judged by itself, whatever its neighbours.
    """
    scanner = Scanner(phrases, compiled(templates, openings))

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for text in rows.column(1):
                scan = scanner.scan(text.as_py() or b"")
                places = scan.phrase_places
                labels = scan.phrase_labels | {label for label, _, _ in scan.spans}
                out.append(
                    (
                        scan.n_words,
                        len(places),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(scan.phrase_labels)),
                        ",".join(sorted(labels)),
                        scan.score,
                        [{"label": x, "first": a, "after": b} for x, a, b in sorted(scan.spans)],
                    )
                )
            columns = [[row[k] for row in out] for k in range(len(names) - 1)]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([rows.column(0), *arrays], names)

    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())])
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
             "score", "spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    schema = (
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, "
        "spans array<struct<label:string,first:bigint,after:bigint>>"
    )
    narrow = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text")
    )
    return narrow.mapInArrow(batch, schema)


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and templates found in every document."""
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
