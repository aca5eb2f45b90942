"""Phrases against a search word by word; templates against texts that vary what may vary."""

from __future__ import annotations

import random
import re

import pytest
from tables import no_documents, odd_documents, odd_texts, plain_rows

from tallygate.llm import licenses


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner(licenses.PHRASES, licenses.compiled())


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), labels


PIECES = [
    "under the MIT License", "Apache-License, version 2", "CC BY-NC 4.0", "cc", "by", "nc", "é",
    "word", "MIT", "license", "under the", "(the", "version 2.0", "\n", "İ", "2", "x2",
]


def test_phrases(scanner):
    rng = random.Random(2)
    texts = odd_texts() + [" ".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(500)]
    for text in texts:
        scan = scanner.scan((text or "").encode())
        assert (scan.n_words, sorted(scan.phrase_places), scan.phrase_labels) == brute(text)


MIT = next(t for t in licenses.TEMPLATES["mit"] if t.startswith("Permission"))


def labels(scanner, text):
    return {label for label, _, _ in scanner.scan(text.encode()).spans}


def filled(template: str, optional: bool, words: int) -> str:
    text = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", r"\1" if optional else "", template)
    return re.sub(r"<<var;match=(\d+)-(\d+)>>",
                  lambda m: " ".join(["any"] * min(max(words, int(m[1])), int(m[2]))), text)


@pytest.mark.parametrize("optional", [True, False])
@pytest.mark.parametrize("words", [1, 3, 99])
def test_templates_accept_what_may_vary(scanner, optional, words):
    for label, listed in licenses.TEMPLATES.items():
        for template in listed:
            text = filled(template, optional, words)
            assert label in labels(scanner, f"Words before. {text} and after"), template
            assert label in labels(scanner, text.upper().replace(" ", "\n * "))


def test_templates_need_every_mandatory_word(scanner):
    text = filled(MIT, True, 2)
    words = text.split()
    for i, word in enumerate(words):
        if word == "any" or "(including" in " ".join(words[max(0, i - 5) : i + 1]):
            continue
        changed = " ".join(words[:i] + ["zyzzyva"] + words[i + 1 :])
        removed = " ".join(words[:i] + words[i + 1 :])
        near_variable = "any" in words[max(0, i - 2) : i + 3]
        assert "mit" not in labels(scanner, changed) or near_variable, word
        assert "mit" not in labels(scanner, removed) or near_variable, word


def test_spans(scanner):
    text = "a b released under the MIT License c under the terms of the mit license d"
    spans = [s for s in scanner.scan(text.encode()).spans if s[0] == "mit"]
    assert spans == [("mit", 2, 7), ("mit", 8, 15)]


def test_documents(spark):
    docs = odd_documents(spark)
    rows = licenses.scanned(docs).collect()
    assert len(rows) == docs.count()
    assert sorted(r.n_words for r in rows) == sorted(brute(r.text)[0] for r in docs.collect())
    made = spark.createDataFrame(
        [
            (1, "Released under the MIT License."),
            (2, "cc by nc"),
            (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, "nothing"),
        ],
        "doc_id int, text string",
    )
    found = {r.doc_id: r for r in licenses.scanned(made).collect()}
    assert (found[1].base_labels, found[1].labels, found[1].score) == ("mit", "mit", 1.0)
    assert (found[1].n_base, found[1].first_word, found[1].last_word) == (1, 1, 1)
    assert (found[2].base_labels, found[2].labels, found[2].score) == ("cc-by-nc", "cc-by-nc", 0.8)
    assert (found[3].base_labels, found[3].labels, found[3].score) == ("", "gpl-3", 1.0)
    assert (found[4].n_base, found[4].first_word, found[4].labels) == (0, None, "")
    assert found[4].score == 0.0


def test_no_documents(spark):
    assert plain_rows(licenses.scanned(no_documents(spark))) == []


GRANT = filled(licenses._MIT_GRANT, True, 1)
AS_IS = filled(licenses._AS_IS, True, 1)
BSD = licenses._BSD_GRANT + ": 1. " + filled(licenses._BSD_CONDITIONS, True, 0).replace("any", "2.")
BSD_END = filled(licenses._BSD_DISCLAIMER, True, 2)


@pytest.mark.parametrize(
    "text, wanted, score",
    [
        (f"{GRANT}. {AS_IS}.", {"mit"}, 1.0),
        (f"{GRANT}. The Software shall be used for Good, not Evil. {AS_IS}.", {"json"}, 1.0),
        (f"{GRANT}. {AS_IS}. Except as contained in this notice, the name of the X Consortium shall"
         " not be used in advertising or otherwise to promote the sale, use or other dealings in"
         " this Software without prior written authorization from the X Consortium.", {"x11"}, 1.0),
        (f"{GRANT}. All use must be reported to us.", {"mit-like"}, 0.5),
        (f"{BSD} {BSD_END}", {"bsd-2"}, 1.0),
        (f"{BSD} 3. Neither the name of X nor the names of its contributors may be used to endorse"
         " or promote products derived from this software without specific prior written"
         f" permission. {BSD_END}", {"bsd-3"}, 1.0),
        # As Apache 1.1 and OpenSSL go on.
        (f"{BSD} 3. The end-user documentation included with the redistribution, if any, must"
         f" include the following acknowledgment. {BSD_END}", {"bsd-like"}, 0.5),
        (f"{BSD} 3. All advertising materials mentioning features or use of this software must"
         " display the following acknowledgment: This product includes software developed by the"
         " OpenSSL Project. 4. The names OpenSSL Toolkit and OpenSSL Project must not be used to"
         f" endorse or promote products. {BSD_END}", {"bsd-like"}, 0.5),
        ("This is free and unencumbered software released into the public domain",
         {"unlicense-like"}, 0.5),
        (f"{GRANT}. Under the MIT License", {"mit", "mit-like"}, 1.0),
    ],
)
def test_licenses_count_as_a_whole(scanner, text, wanted, score):
    scan = scanner.scan(text.encode())
    assert ({label for label, _, _ in scan.spans}, scan.score) == (wanted, score)


BSD_FILE = """Copyright (c) The Regents of the University of California.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE.
"""


def test_a_license_file(scanner):
    scan = scanner.scan(BSD_FILE.encode())
    assert [label for label, _, _ in scan.spans] == ["bsd-3"]


def as_pattern(template: str) -> re.Pattern:
    """A template as a regular expression over words with a space before each: a matcher that
    shares nothing with the automata."""
    pattern = ""
    for part in re.split(r"(<<.*?>>)", template):
        if part == "<<beginOptional>>":
            pattern += "(?:"
        elif part == "<<endOptional>>":
            pattern += ")?"
        elif part.startswith("<<var"):
            least, most = re.findall(r"\d+", part)
            pattern += f"(?: [^ ]+){{{least},{most}}}"
        else:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", part.lower())
            pattern += "".join(" " + re.escape(w) for w in words)
    return re.compile(pattern + "(?= |$)")


PATTERNS = {
    label: [as_pattern(t) for t in listed] for label, listed in licenses.TEMPLATES.items()
}


@pytest.mark.parametrize("seed", range(6))
def test_against_regular_expressions(scanner, seed):
    """Templates filled at random, some words changed, taken out, repeated or put in."""
    rng = random.Random(seed)
    listed = [t for some in licenses.TEMPLATES.values() for t in some]
    for _ in range(150):
        words = []
        for template in rng.sample(listed, rng.randint(1, 2)):
            text = re.sub(
                r"<<beginOptional>>(.*?)<<endOptional>>",
                lambda m: m[1] if rng.random() < 0.5 else "", template,
            )
            text = re.sub(
                r"<<var;match=(\d+)-(\d+)>>",
                lambda m: " ".join(["any"] * rng.randint(int(m[1]), int(m[2]) + 1)), text,
            )
            words += ["so"] * rng.randint(0, 2) + re.findall("[a-z0-9]+", text.lower())
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["other"], [words[at]] * 2, [words[at], "more"]])
        line = "".join(" " + w for w in words)
        spans = {
            label: [m.span() for p in some for m in p.finditer(line)]
            for label, some in PATTERNS.items()
        }
        found = labels(scanner, " ".join(words)) & PATTERNS.keys()
        assert found <= {label for label, own in spans.items() if own}, line
        # What is part of a longer license is not one of its own.
        counted = [span for label in found for span in spans[label]]
        for label in PATTERNS.keys() - found:
            for a, b in spans[label]:
                assert any(c <= a and b <= d and (c, d) != (a, b) for c, d in counted), line


def test_short_notices(scanner):
    for text, label in (
        ("Under CC BY-NC-SA 4.0.", "cc-by-nc-sa"),
        ("Apache License 2.0", "apache-2"),
        ("Dedicated to all: CC0 1.0", "cc0"),
        ("GPL-2.0-only", "gpl-2"),
        ("SPDX-License-Identifier: LGPL-2.1", "lgpl"),
        ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "cc-by-nc-nd"),
    ):
        assert label in labels(scanner, text), text
