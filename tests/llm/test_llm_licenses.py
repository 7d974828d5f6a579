import random
import re

import pytest
from llm_cases import by_id, documents, no_documents, odd_documents, rows_of

from bizmetrics.llm import license_scan as L


@pytest.mark.parametrize(
    "text, label",
    [
        ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2.0"),
        ("released under the MIT License.", "mit"),
        ("see https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
        ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
        ("Redistribution and use in source and binary forms, with or without modification", "bsd"),
        ("dedicated to the public domain", "public-domain"),
    ],
)
def test_labels(text, label):
    assert label in {d[2] for d in L.scan_text(text)[2]}


def test_hundreds_of_rules_each_with_a_keyword_its_pattern_needs():
    assert len(L.rules()) > 300
    for rule in L.rules():
        assert rule.keywords and all(k == k.lower() for k in rule.keywords)
        re.compile(rule.pattern)


def test_the_keyword_gate_loses_nothing():
    texts = ["SPDX-License-Identifier: MPL-2.0", "GNU Affero General Public License, version 3", "CC BY-NC 4.0", "zlib license", "© 2020 me", "confidential and proprietary", "Boost Software License 1.0"]
    patterns = [(i, re.compile(r.pattern, re.DOTALL), r) for i, r in enumerate(L.rules())]
    for text in texts:
        low = text.lower()
        every = [(-r.priority, m.start() - m.end(), i, m.start(), m.end()) for i, p, r in patterns for m in p.finditer(low) if m.end() > m.start()]
        assert L.scan_text(text)[2] == L.resolve(every, L.rules())


def written(parsed, longest=40):
    """Texts that a parsed pattern matches, such that every alternative and every optional part, present and absent, is in one."""
    texts = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "NOT_LITERAL":
            more = [" "]
        elif name == "ANY":
            more = ["q"]
        elif name == "IN":
            more = [character(value)]
        elif name == "BRANCH":
            more = [t for branch in value[1] for t in written(branch)]
        elif name == "SUBPATTERN":
            more = written(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            more = [t * n for n in dict.fromkeys((least, min(most, max(1, least)))) for t in written(inner)]
        else:
            assert name in ("AT", "ASSERT_NOT"), name
            more = [""]
        # All ways for few parts; for many, each part's ways at least once.
        if len(texts) * len(more) <= longest:
            texts = [a + b for a in texts for b in more]
        else:
            texts = [texts[i % len(texts)] + more[i % len(more)] for i in range(max(len(texts), len(more)))]
    return texts


def character(ways):
    """One that a class holds."""
    if str(ways[0][0]) == "NEGATE":
        return " "
    kind, value = ways[0]
    if str(kind) == "LITERAL":
        return chr(value)
    if str(kind) == "RANGE":
        return chr(value[0])
    return {"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "1", "CATEGORY_NOT_SPACE": "q", "CATEGORY_WORD": "q"}[str(value)]


def test_every_alternative_of_every_rule_passes_the_gate():
    tried = 0
    for rule in L.rules():
        pattern = re.compile(rule.pattern, re.DOTALL)
        matched = [m[0] for t in written(re._parser.parse(rule.pattern, re.DOTALL)) if (m := pattern.search(f" {t} "))]
        assert matched, rule.pattern
        for text in matched:
            assert any(k in text for k in rule.keywords), (rule.label, rule.pattern, text)
        tried += len(matched)
    assert tried > len(L.rules())


@pytest.mark.parametrize(
    "text, label",
    [
        ("Creative Commons Zero", "cc0"),
        ("Creative Commons Zero v1.0 Universal", "cc0-1.0"),
        ("CC0", "cc0"),
        ("version 1.0 of the Creative Commons Zero", "cc0-1.0"),
        ("Responsible AI License", "rail"),
        ("OpenRAIL-M License", "rail"),
        ("University of Illinois/NCSA", "ncsa"),
    ],
)
def test_the_gate_loses_no_alternative(text, label):
    low = text.lower()
    every = [(-r.priority, m.start() - m.end(), i, m.start(), m.end()) for i, r in enumerate(L.rules()) for m in re.finditer(r.pattern, low, re.DOTALL) if m.end() > m.start()]
    found = L.scan_text(text)[2]
    assert found == L.resolve(every, L.rules()) and label in {d[2] for d in found}


def test_resolution_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        found = []
        for _ in range(r.randint(0, 25)):
            start = r.randint(0, 30)
            end = start + r.randint(1, 10)
            found.append((-r.randint(0, 3), start - end, r.randint(0, 9), start, end))
        kept = []
        for _, _, i, s, e in sorted(found):
            if not any((a <= s and e <= b) or (s <= a and b <= e) for a, b, _ in kept):
                kept.append((s, e, i))
        rules = L.rules()
        assert [(s, e) for s, e, _, _ in L.resolve(found, rules)] == [(s, e) for s, e, _ in sorted(kept)]


def test_base_places_equal_brute_force(spark):
    r = random.Random(2)
    vocabulary = ["CC", "by", "General", "public", "license", "all", "rights", "reserved", "x", "é"]
    texts = {i: r.choice([" ", "-", ". "]).join(r.choices(vocabulary, k=r.randint(0, 30))) for i in range(80)}
    found = by_id(L.document_licenses(documents(spark, texts)))
    for i, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.replace("É", "É").translate({c: c + 32 for c in range(65, 91)}))
        places = [(s, label) for s in range(len(words)) for phrase, label in L.BASE if [w.encode() for w in words[s : s + len(phrase)]] == list(phrase)]
        row = found[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((s for s, _ in places), default=None) and row["last_word"] == max((s for s, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_odd_rows(spark):
    found = rows_of(L.document_licenses(odd_documents(spark)))
    assert len(found) == 9 and all(r["n_base"] == 0 and r["first_word"] is None and r["score"] == 0 for r in found)
    assert L.document_licenses(no_documents(spark)).count() == 0
