"""Measures and verdicts against a plain count over each text."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from helpers import plan_text
from tables import no_documents, odd_documents, odd_texts, plain_rows

from tallygate.llm import quality_rules as rules


def brute(text: str | None) -> dict[str, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures(spark):
    texts = odd_texts() + ["a b c a b c", "a a a", "a a a a", "a b a b a"]
    texts += ["x\n\nx\n \nx", "a\x0bb\x1cc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in rules.verdicts(docs).collect():
        wanted = brute(texts[row.doc_id])
        assert {k: row[k] for k in wanted} == wanted, row.doc_id
        failed = wanted["n_words"] < 50 or 100 * wanted["n_repeat_words"] > 50 * wanted["n_words"]
        assert row.base_failed == failed
        assert not (row.kept and failed)


@pytest.mark.parametrize(
    "text, broken",
    [
        ("the word and " * 1 + " ".join(f"w{i} of" for i in range(60)), ""),
        (" ".join(f"w{i}*** the" for i in range(60)), "symbols"),
        (" ".join(f"word{i}" for i in range(60)), "stop_words"),
        (" ".join(f"the {'y' * 60}{i}" for i in range(60)), "word_length"),
    ],
)
def test_rules(spark, text, broken):
    row = rules.verdicts(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (row.broken_rules, row.kept) == (broken, broken == "")


def test_repeated_lines_break_a_rule(spark):
    lines = [f"the line of {i}" for i in range(15)]
    text = "\n".join(lines + ["the end"] * 50)
    row = rules.verdicts(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert "repeated_lines" in row.broken_rules


def test_kept_rows_are_whole(spark):
    docs = odd_documents(spark)
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    verdict = [r.kept for r in rules.verdicts(docs).collect()]
    assert kept.count() == sum(verdict) > 0


def test_no_documents(spark):
    assert plain_rows(rules.verdicts(no_documents(spark))) == []


def test_plan_is_a_map(spark):
    plan = plan_text(rules.op4_quality_rules(spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Exchange" not in plan and "Window" not in plan
