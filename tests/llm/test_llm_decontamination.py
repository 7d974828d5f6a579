import random
import re

import pytest
from llm_cases import by_id, documents, frame, no_documents, odd_documents, rows_of

from bizmetrics.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(text, items, size):
    own, hit, found = words(text), set(), set()
    for item, item_text in items.items():
        for window in D.windows(words(item_text), size):
            for s in range(len(own) - len(window) + 1):
                if tuple(own[s : s + len(window)]) == window:
                    hit.update(range(s, s + len(window)))
                    found.add(str(item))
    return {"n_words": len(own), "n_hit": len(hit), "items": sorted(found), "contaminated": bool(hit)}


def made(seed, count, length):
    r = random.Random(seed)
    return {i: " ".join(r.choices(["a", "B", "cé", "d1", "e", "😀"], k=r.randint(0, length))) for i in range(count)}


def items_frame(spark, items):
    return frame(spark, list(items.items()), "item_id long, text string")


def test_equals_brute_force(spark):
    texts, items = made(1, 60, 40) | {100: None, 101: ""}, made(2, 15, 8) | {50: None, 51: "!?", 52: "A b", 53: "a B"}
    found = by_id(D.decontaminate(documents(spark, texts), items_frame(spark, items), window=4))
    for i, text in texts.items():
        assert {k: found[i][k] for k in ("n_words", "n_hit", "items", "contaminated")} == brute_force(text, items, 4)


def test_many_blocks_give_the_same(spark):
    texts, items = made(3, 40, 40), made(4, 12, 8)
    whole = by_id(D.decontaminate(documents(spark, texts), items_frame(spark, items), window=3))
    assert by_id(D.decontaminate(documents(spark, texts), items_frame(spark, items), window=3, most=10)) == whole


def test_matches_and_proximity_equal_brute_force(spark):
    texts, items, slop, size = made(5, 30, 25), made(6, 6, 6), 1, 3
    index = D.build_index(documents(spark, texts))
    (block,) = D.blocks(items_frame(spark, items), "item_id", "text", size)
    found = {(r["id"], r["item"], r["window"], r["start"], r["exact"]) for r in rows_of(D.matches(index, block, slop))}
    wanted = set()
    for d, text in texts.items():
        own = words(text)
        for item, item_text in items.items():
            for k, window in enumerate(D.windows(words(item_text), size)):
                for s in range(-len(window), len(own) + 1):
                    exact = s >= 0 and tuple(own[s : s + len(window)]) == window
                    near = all(any(own[p] == w for p in range(max(0, s + j - slop), min(len(own), s + j + slop + 1))) for j, w in enumerate(window))
                    if exact:
                        wanted.add((d, str(item), k, s, True))
                    elif near:
                        wanted.add((d, str(item), k, s, False))
    assert {f for f in found if f[4]} == {w for w in wanted if w[4]}
    # A near match is found around a place of its rarest term, so these are some of all.
    assert found <= wanted and len(found) > len({w for w in wanted if w[4]})


@pytest.mark.parametrize("slop", [1, 2, 3])
def test_every_proximity_match_is_found(spark, slop):
    texts, items, size = made(7, 40, 25) | {100: "b a c", 101: "e e e e", 102: None, 103: "A"}, made(8, 8, 6) | {50: "a b c", 51: "c"}, 3
    index = D.build_index(documents(spark, texts))
    (block,) = D.blocks(items_frame(spark, items), "item_id", "text", size)
    found = [(r["id"], r["item"], r["window"], r["start"]) for r in rows_of(D.matches(index, block, slop))]
    wanted = set()
    for d, text in texts.items():
        own = words(text)
        for item, item_text in items.items():
            for k, window in enumerate(D.windows(words(item_text), size)):
                for s in range(-size - slop, len(own) + size + slop):
                    if all(any(own[p] == w for p in range(max(0, s + j - slop), min(len(own), s + j + slop + 1))) for j, w in enumerate(window)):
                        wanted.add((d, str(item), k, s))
    assert sorted(found) == sorted(wanted)


def test_proximity_matches_do_not_depend_on_the_shard(spark):
    (block,) = D.blocks(items_frame(spark, {1: "a b c"}), "item_id", "text", 3)
    for others in ("a a", "b b", "c c", "a a b b", "a a c c", "b b c c"):
        found = rows_of(D.matches(D.build_index(documents(spark, {1: "b a c", 2: others}).coalesce(1)), block, 1))
        assert 0 in [r["start"] for r in found if r["id"] == 1]


def test_no_phrase_spans_two_documents(spark):
    found = by_id(D.decontaminate(documents(spark, {1: "x one two", 2: "three four y"}), items_frame(spark, {1: "one two three four"}), window=4))
    assert not found[1]["contaminated"] and not found[2]["contaminated"]


def test_odd_rows(spark):
    items = items_frame(spark, {1: "twice the same row", 2: None, 3: ""})
    found = rows_of(D.document_contamination(odd_documents(spark), items))
    assert len(found) == 9 and sorted(r["doc_id"] or 0 for r in found if r["contaminated"]) == [5, 5]
    assert D.document_contamination(no_documents(spark), items).count() == 0
    clean = D.document_contamination(documents(spark, {1: "a b"}), items_frame(spark, {}))
    assert [r["contaminated"] for r in rows_of(clean)] == [False]


def test_search_does_not_shuffle(spark):
    found = D.decontaminate(documents(spark, {1: "a"}), items_frame(spark, {1: "a"}))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
