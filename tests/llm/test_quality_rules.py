import re
import unicodedata
from collections import Counter

import pytest
from helpers import documents, empty, words

from cartwise.llm import quality_rules as rules


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    kinds = [unicodedata.category(c) for c in text]
    return dict(
        n_words=len(w), word_chars=sum(map(len, w)), n_symbols=sum(c in "#*$%&|<>" for c in text),
        n_lines=len(lines), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered),
        n_capitals=kinds.count("Lu"), n_letters=sum(k[0] == "L" for k in kinds),
        n_letter_words=sum(any(unicodedata.category(c)[0] == "L" for c in x) for x in w))


def failed(m):
    return {name for name, rule in rules.RULES.items() if eval(rule, {}, m)}


def kept(m, policy):
    fails = failed(m)
    return not fails & set(policy.reject) and len(fails & set(policy.counted)) <= policy.allowed


TEXTS = [
    words(60), None, "", " \n\t\x0b\f\r ", "one two", "a b c d e a b c d e " + words(30, 3), "to " * 400,
    " ".join(f"X{i}### y" for i in range(30)), "LOUD " + words(12, 2).upper(), "same line here\n" * 9,
    " | ".join(words(20, 5).split()), "Été ÉTÉ ça va bien 😀 #1 ⅔ ǅ " * 3, words(30_000, 8, 90), "\n\n \n",
    "x" * 100_000, " ".join("ab" * 3 for _ in range(5)), words(40, 7) + "\n" + words(40, 7), "1 2 3 4 5 6 7 8 9 10 11",
]


def test_measurements_and_failures(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (3, TEXTS[7]), (3, TEXTS[7])]
    got = rules.ledger(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, tuple(plain(t).values()), rules.mask(failed(plain(t)))) for i, t in rows)
    assert Counter((r.doc_id, tuple(r[m] for m in plain("")), r.failures) for r in got) == want


def test_policies_and_ablations(spark):
    many = [(i, t) for i, t in enumerate(TEXTS * 4)]
    book = rules.ledger(documents(spark, many))
    measured = {i: plain(t) for i, t in many}
    for name, policy in rules.POLICIES.items():
        got = {r.doc_id: r.kept for r in rules.applied(book, name).collect()}
        assert got == {i: kept(m, policy) for i, m in measured.items()}
    found = {(r.policy, r.rule): r for r in rules.ablations(book).collect()}
    assert len(found) == sum(1 + len(p.reject) + len(p.counted) for p in rules.POLICIES.values())
    for (version, rule), r in found.items():
        policy = rules.POLICIES[version]
        rest = rules.Policy(tuple(x for x in policy.reject if x != rule),
                            tuple(x for x in policy.counted if x != rule), policy.allowed)
        fails = [failed(m) for m in measured.values()]
        assert r.documents == len(many) and r.kept == sum(kept(m, policy) for m in measured.values())
        assert r.kept_without == sum(kept(m, rest) for m in measured.values())
        assert r.failed == sum(rule in f for f in fails)
        assert r.kept_alone == sum(rule not in f for f in fails)


def test_empty_table(spark):
    book = rules.ledger(empty(spark))
    assert book.collect() == [] and rules.ablations(book).collect() == []


def test_a_rule_keeps_its_bit():
    more = {**rules.RULES, "new": "n_words > 5"}
    assert rules.mask(rules.RULES, more) == rules.mask(rules.RULES)
    assert rules.mask(["new"], more) == 1 << len(rules.RULES)
    with pytest.raises(ValueError):
        rules.mask(["none such"])


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        rules.ledger(empty(spark), {f"r{i}": "n_words > 1" for i in range(63)})


def test_no_python_in_the_plan(spark, sf_dir):
    plan = rules.op12_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
