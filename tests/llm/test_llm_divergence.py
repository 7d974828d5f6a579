import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_cases import frame, no_documents, odd_documents, rows_of

from bizmetrics.llm import source_divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_documents, top):
    """The definition, with every term of a language for every one of its sources."""
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        having = Counter(t for x, _, c in docs if x == lang for t in c)
        kept = sorted(t for t, n in having.items() if n >= min_documents)
        counts = defaultdict(Counter)
        whole = Counter()
        for x, source, c in docs:
            if x == lang:
                counts[source].update({t: c[t] for t in kept if c[t]})
                whole.update({t: c[t] for t in kept if c[t]})

        def shares(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for s in p:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)}
    return out


def found(spark, rows, min_documents=2, top=3):
    docs = frame(spark, rows, "lang string, source string, text string")
    return {tuple(r.values()) for r in rows_of(D.divergence(docs, min_documents, top))}


WORDS = ["a", "B", "b", "ça", "Ça", "x1y", "it's", "É", "zz", "\U0001f600", "_", "42"]


def generated():
    state = 7
    for i in range(120):
        words = []
        for _ in range(i % 9):
            state = (state * 1103515245 + 12345) % 2**31
            words.append(WORDS[(state >> 16) % (4 + i % 9)])
        yield ["en", "de", None, ""][i % 4 if i % 3 else 0], ["s0", "s0", "s1", "s2", None, "S"][i % 6], " ".join(words) if i % 11 else None


def test_equals_brute_force(spark):
    rows = list(generated())
    assert found(spark, rows) == brute(rows, 2, 3)
    assert found(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_small_sums_of_tasks_give_the_same(spark, monkeypatch):
    rows = list(generated())
    monkeypatch.setattr(D, "HELD", 1)
    assert found(spark, rows) == brute(rows, 2, 3)


def test_sources_without_terms_and_languages_without_kept_ones(spark):
    rows = [("en", "a", "one two"), ("en", "b", "one"), ("en", "c", None), ("en", "d", "12 ."), ("fr", "a", "un"), ("fr", "b", "deux"), ("it", "a", "solo")]
    assert found(spark, rows) == brute(rows, 2, 3)
    assert {r[4] for r in found(spark, rows) if r[0] == "fr"} == {0}


def test_ties_go_by_bytes(spark):
    rows = [("en", s, t) for s in ("a", "b", "\U0001f600", "～") for t in ("z é \U0001f600 ～ Z", "z é \U0001f600 ～")] + [("en", "c", "q q q")] * 3
    assert found(spark, rows) == brute(rows, 2, 3)


def test_counts_beyond_64_bits_of_a_product(spark):
    rows = [(10**12, 3 * 10**12, 5), (0, 1, 1), (4 * 10**13, 4 * 10**13, 1)]
    df = spark.createDataFrame(rows, "count long, n long, v long")
    p = [r[0] for r in df.select(D._share(*map(df.__getitem__, df.columns))).collect()]
    assert p == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_odd_documents(spark):
    odd = odd_documents(spark)
    rows = [(r["lang"], r["source"], r["text"]) for r in rows_of(odd.select("lang", "source", "text"))]
    assert {tuple(r.values()) for r in rows_of(D.divergence(odd, 1, 10))} == brute(rows, 1, 10)
    assert rows_of(D.source_audit(no_documents(spark))) == []


@given(st.text())
def test_tokenizer(text):
    text = text.encode("utf-8", "replace").decode()
    assert [t.decode() for t in D.utf8(text).translate(D.TERM_BYTES).split()] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("text", [None, "", " \n", "12 34"])
def test_no_terms(text):
    assert not D.document_terms(text)
