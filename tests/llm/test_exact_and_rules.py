"""Exact de-duplication and quality rules: edge cases and small brute-force versions."""

import re
from collections import Counter

import pytest

from segmart.llm import exact_dedup, quality_rules

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def test_groups_of_odd_documents(odd_docs):
    rows = [(r.doc_id, r.group_size, r.keep_id, r.kept, r.copies) for r in exact_dedup.exact_groups(odd_docs).collect()]
    assert (1, 3, 1, True, 1) in rows and (2, 3, 1, False, 1) in rows  # null and empty are equal
    assert (None, 3, 1, False, 1) in rows
    assert (3, 1, 3, True, 1) in rows  # one space
    assert (5, 2, 5, True, 1) in rows and (6, 2, 5, False, 1) in rows
    assert (7, 2, 7, True, 1) in rows and (8, 2, 7, False, 1) in rows
    assert (10, 2, 10, True, 2) in rows
    assert (None, 1, None, True, 1) in rows
    assert len(rows) == 14


def test_texts_with_one_prefix_and_length_are_told_apart(docs):
    same = "x" * 300
    found = exact_dedup.exact_groups(docs((1, same + "a"), (2, same + "b"), (3, same + "a"))).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(1, 1, 2), (3, 1, 2), (2, 2, 1)}


def test_without_copies_keeps_columns_and_one_of_repeated_rows(odd_docs):
    kept = exact_dedup.without_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = Counter(SPACE.sub(" ", r.text or "") for r in kept.collect())
    wanted = {SPACE.sub(" ", r.text or "") for r in odd_docs.collect()}
    assert set(texts) == wanted and set(texts.values()) == {1}


def test_without_copies_of_unique_rows(docs):
    kept = exact_dedup.without_copies(docs((3, "a  b"), (1, "a b"), (2, "c"), (4, None), (5, "")))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_without_copies_of_repeated_rows_and_names_of_any_kind(spark):
    names = "doc_id long, text string, key int, row int, wanted_key int, copies int, _place int, _digest int"
    rows = [(1, "a  b", i, 2, 3, 4, 5, 6) for i in range(3)] + [(2, "a b", 9, 2, 3, 4, 5, 6), (None, "c", 1, 2, 3, 4, 5, 6)] * 2
    table = spark.createDataFrame(rows, names)
    kept = exact_dedup.without_copies(table)
    assert kept.columns == table.columns
    found = sorted(kept.collect(), key=lambda r: r.text)
    assert [(r.doc_id, r.text) for r in found] == [(1, "a  b"), (None, "c")]
    assert all(tuple(r)[3:] == (2, 3, 4, 5, 6) for r in found) and found[0].key in (0, 1, 2)


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x|y & <z>\nx|y & <z>\n\n\nq",
    "a b c d a b c e a b f b c d", " lead and trail ", "É é \U0001f642 é", "\x0bv\x0cf\rr",
    " ".join(f"w{i % 50}" for i in range(400)), " ".join(f"w{i}" for i in range(3000)),
    " ".join(f"r{i // 7}" for i in range(2000)),
]


def test_measurements_equal_brute_force(docs):
    rows = quality_rules.measured(docs(*enumerate(TEXTS))).collect()
    found = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert found == {i: brute_measures(text) for i, text in enumerate(TEXTS)}


def test_ledger_policies_and_ablations(docs):
    good = " ".join(f"word{i}" for i in range(60))
    ledger = quality_rules.stored_ledger(docs((1, good), (2, "short"), (3, "same " * 90), (4, good + " #" * 30), (5, "|")))
    kept = {r.doc_id for r in ledger.where(quality_rules.passes("junk-2")).collect()}
    assert kept == {1}
    base = {r.doc_id for r in ledger.where(quality_rules.passes("base-1")).collect()}
    assert base == {1, 4}
    rules = {r.rule: (r.failed, r.failed_alone, r.kept_without) for r in quality_rules.ablations(ledger).collect()}
    assert rules["few_words"] == (2, 1, 2)
    assert rules["symbols"] == (2, 1, 2)
    assert rules["repeated_windows"] == (1, 1, 2)


def test_passing_keeps_rows_as_they_were(odd_docs, docs):
    assert quality_rules.passing(odd_docs).columns == odd_docs.columns
    good = " ".join(f"word{i}" for i in range(60))
    rows = quality_rules.passing(docs((1, good), (1, good), (1, "bad"), (None, good))).collect()
    assert [(r.doc_id, r.key, r.length) for r in rows if r.doc_id] == [(1, "k", 1)] * 2
    assert len(rows) == 3


@pytest.mark.parametrize("operator", [exact_dedup.exact_groups, exact_dedup.without_copies, quality_rules.ledger, quality_rules.passing])
def test_empty_table(docs, operator):
    assert operator(docs()).collect() == []


def test_native_plans_have_no_python(spark, docs):
    for frame in (quality_rules.ledger(docs((1, "a"))), exact_dedup.exact_groups(docs((1, "a")))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
