"""Rules against a plain reading of every text."""

import re

import pytest
from cases import clashing, edge_texts, frame

from stageline.llm.quality_rules import RULES, STOP_WORDS, Rule, judge, keep_by_rules, rules_from

WORD, SPACE = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x20\x09-\x0D]")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if SPACE.search(line)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(8)}
    n, n_lines = len(words), len(lines)
    counts = {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": n_lines - len(set(lines)),
        "n_repeat_words": len(inside),
    }
    base = n < 20 or 100 * len(inside) > 30 * n
    ratios = {
        "word_length": counts["word_chars"] / max(n, 1),
        "symbols_per_word": counts["n_symbols"] / max(n, 1),
        "stop_words": sum(w in STOP_WORDS for w in words) / max(n, 1),
        "shouted_words": sum(w.endswith("!") for w in words) / max(n, 1),
        "letter_words": sum(any(c.isalpha() for c in w) for w in words) / max(n, 1),
        "words_per_line": n / max(n_lines, 1),
        "duplicate_lines": counts["n_dup_lines"] / max(n_lines, 1),
        "bullet_lines": sum(bool(re.match(r"[ \t]*[-*•●◦]", line)) for line in lines) / max(n_lines, 1),
        "ellipsis_lines": sum(line.rstrip(" \t\r").endswith(("...", "…")) for line in lines) / max(n_lines, 1),
    }
    return counts, base, ratios


def failed(ratios, rules):
    return [
        r.name
        for r in rules
        if (r.low is not None and ratios[r.ratio] < r.low) or (r.high is not None and ratios[r.ratio] > r.high)
    ]


@pytest.fixture(scope="module")
def texts():
    eight = "one two three four five six seven eight"
    out = edge_texts()
    out += [t.replace(" ", " ### ") for t in out[9:14]] + [t.upper().replace(" ", "!! ") for t in out[9:14] if t]
    out += [
        "the and of " * 30, "a " * 19, "a " * 20, eight, f"{eight} {eight}", f"{eight} nine {eight}", "aa " * 9,
        "x\n\n x\nx\r\nx", "- a\n* b\n\t• c and the d\n" * 5, "well...\nso…\nno ...  \n" * 9, "1 2 3 4 5 " * 6,
        f"{eight} a b c d e f g h i j k l {eight} m n o p q r s t u v w {eight}", " x  y z\u0085w", "word\x00word ok",
    ]
    return out


def test_counts_and_verdicts(spark, texts):
    rows = {r.doc_id: r for r in judge(clashing(frame(spark, texts))).collect()}
    assert sorted(rows) == list(range(len(texts)))
    for i, text in enumerate(texts):
        counts, base, ratios = brute(text)
        got = rows[i]
        assert {c: got[c] for c in counts} == counts, (i, text[:80])
        assert got.base_failed == base
        assert got.failed == failed(ratios, RULES), (i, text)
        assert got.kept == (not base and not got.failed)
    assert any(r.kept for r in rows.values()) and {n for r in rows.values() for n in r.failed} >= {"symbols", "shouting"}


def test_keeps_rows_whole(spark, texts):
    docs = clashing(frame(spark, texts))
    judged = {r.doc_id for r in judge(docs).where("kept").collect()}
    kept = keep_by_rules(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == judged and 0 < len(judged) < len(texts)


def test_table_of_rules(spark, texts):
    table = spark.createDataFrame([("long lines", "words_per_line", None, 12.0)], "name string, ratio string, low double, high double")
    rules = rules_from(table)
    assert rules == [Rule("long lines", "words_per_line", None, 12.0)]
    for r in judge(frame(spark, texts), rules).collect():
        counts, base, ratios = brute(texts[r.doc_id])
        assert r.failed == failed(ratios, rules) and r.kept == (not base and not r.failed)
    assert judge(frame(spark, texts), []).where("kept = base_failed").count() == 0


def test_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None), (1, "the " * 30)], "doc_id long, text string")
    assert len(judge(docs).collect()) == 3
    empty = judge(docs.limit(0))
    assert empty.count() == 0 and "kept" in empty.columns


def test_plan_has_no_python_and_no_shuffle(spark, texts):
    plan = judge(frame(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("Exchange", "EvalPython", "InArrow", "InPandas") if op in plan]
