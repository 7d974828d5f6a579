import random

import numpy as np
import pytest
from llm_cases import by_id, documents, frame, no_documents, odd_documents, rows_of

from bizmetrics.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed, count):
    """Texts of which some hold one of a few words or stems; these are toxic, with a little noise."""
    r = random.Random(seed)
    texts, labels = {}, []
    for i in range(count):
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 80))]
        toxic, junk = r.random() < 0.3, r.random() < 0.2
        if toxic:
            for _ in range(2):
                words[r.randrange(len(words))] = r.choice(["foulword", f"vilestem{r.randrange(10**6)}"])
        if junk:
            words = [w + "***" for w in words]
        texts[i] = " ".join(words)
        labels.append((i, int(not junk), int(toxic)))
    return texts, labels


def test_fit_equals_a_plain_solver():
    r = np.random.default_rng(1)
    x = (r.random((300, 12)) < 0.3).astype(float)
    y = (x[:, 0] + x[:, 3] + 0.3 * r.random(300) > 0.9).astype(float)
    rows = [np.flatnonzero(row) for row in x]
    weights = T.fit(rows, np.zeros((300, 0)), y, 12, 0.01, 3000)
    plain = np.zeros(13)
    design = np.hstack([x, np.ones((300, 1))])
    for _ in range(60_000):
        plain = plain - 0.3 * design.T @ (T._sigmoid(design @ plain) - y) / 300
        plain[:-1] = np.sign(plain[:-1]) * np.maximum(np.abs(plain[:-1]) - 0.3 * 0.01, 0)
    assert np.abs(weights - plain).max() < 1e-2


def test_held_out_accuracy(spark):
    texts, labels = corpus(2, 900)
    given, known = documents(spark, texts), frame(spark, labels[:600], LABELS)
    chain = T.train(given, known)
    found = by_id(T.score(given, chain))
    for column, k in (("p_low_quality", 1), ("p_toxic", 2)):
        right = sum((found[row[0]][column] > 0.5) == (row[k] == (0 if k == 1 else 1)) for row in labels[600:])
        assert right >= 0.97 * 300, column


def test_labels_of_other_texts_take_no_place_in_the_sample(spark):
    labels = frame(spark, [(i, 1, i % 2) for i in range(1000)], LABELS)
    texts = {i: f"text {i}" for i in range(500, 540)} | {540: None}
    found = [r["id"] for r in rows_of(T.training_rows(documents(spark, texts), labels, sample=30))]
    assert len(found) == len(set(found)) == 30 and set(found) <= set(range(500, 540))


def test_later_models_see_earlier_probabilities(spark):
    texts, labels = corpus(3, 400)
    # The second category is the first one's negative, so the first probability tells it.
    given, known = documents(spark, texts), frame(spark, [(i, q, 1 - q) for i, q, _ in labels], LABELS)
    chain = T.train(given, known, categories=(("good", "quality", 1), ("bad", "toxic", 1)))
    assert chain.before[0] == () and len(chain.before[1]) == 1 and chain.before[1][0] < 0


def test_probabilities_equal_a_plain_sum(spark):
    chain = T.Chain(("a", "b"), (0.1, -0.2), ({"foul": 1.0, "foul*": 0.5}, {"###": 2.0}), ((), (0.7,)))
    found = by_id(T.score(documents(spark, {1: "Foul foulest ###", 2: None, 3: "foul foul"}), chain))
    p = lambda x: 1 / (1 + np.exp(-x))
    assert found[1]["p_a"] == pytest.approx(p(1.6)) and found[1]["p_b"] == pytest.approx(p(1.8 + 0.7 * p(1.6)))
    assert found[2]["p_a"] == pytest.approx(p(0.1)) and found[3]["p_a"] == pytest.approx(p(1.1))


def test_odd_rows_and_labels(spark):
    known = frame(spark, [(None, 1, 1), (1, 1, None), (4, 1, 0), (5, 1, 1), (5, 1, 0), (99, 0, 1)], LABELS)
    found = rows_of(T.document_toxicity(odd_documents(spark), known))
    assert len(found) == 9 and all(0 <= r["p_toxic"] <= 1 for r in found)
    none = frame(spark, [], LABELS)
    assert {r["p_toxic"] for r in rows_of(T.document_toxicity(odd_documents(spark), none))} == {0.0}
    assert T.document_toxicity(no_documents(spark), known).count() == 0


def test_sample_is_bounded(spark):
    texts, labels = corpus(4, 100)
    assert T.training_rows(documents(spark, texts), frame(spark, labels, LABELS), sample=30).count() == 30


def test_scoring_does_not_shuffle(spark):
    chain = T.Chain(("a",), (0.0,), ({},), ((),))
    assert "Exchange" not in T.score(documents(spark, {1: "a"}), chain)._jdf.queryExecution().executedPlan().toString()
