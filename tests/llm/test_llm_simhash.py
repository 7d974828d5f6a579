import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from llm_cases import by_id, documents, frame, no_documents, odd_documents, rows_of

from bizmetrics.llm import simhash_groups as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, size=3):
    """The definition, bit by bit."""
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(fps):
    return [int(x) for x in np.array(fps, np.uint64).view(np.int64)]


def near(fps, distance):
    fps = sorted(set(signed(fps)))
    return {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance}


def clustered(count, seed=1, flips=4):
    """Random fingerprints, and ones a few bits off a few centres; half the bits of many are alike."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = [0, 2**64 - 1, 1 << 63]
    for i in range(count):
        value = rng.choice(centres) if i % 3 else rng.getrandbits(64)
        if i % 3 == 1:
            value = value & 0xFFFFFFFF00000000 | rng.getrandbits(16)
        for _ in range(rng.randrange(flips)):
            value ^= 1 << rng.randrange(64)
        out.append(value)
    return sorted(set(out))


def pairs(spark, fps, **options):
    classes = spark.createDataFrame([(x,) for x in signed(fps)], "fp long")
    return {(r["a"], r["b"]) for r in rows_of(S.close_pairs(classes, **options))}


@given(st.lists(st.one_of(st.none(), st.text("aAbB é\t\n ", max_size=30)), max_size=5))
def test_fingerprints(texts):
    assert S.fingerprints(texts).tolist() == [plain(t) for t in texts]


def test_fingerprints_of_long_texts(monkeypatch):
    texts = [" ".join(f"w{i * k % 97}" for i in range(500 * k)) for k in (1, 0, 3, 2)] + [None, "a", "a b"]
    wanted = [plain(t) for t in texts]
    assert S.fingerprints(texts).tolist() == wanted
    monkeypatch.setattr(S, "SLICE_SHINGLES", 7)
    assert S.fingerprints(texts).tolist() == wanted


def test_every_pair_is_found(spark):
    fps = clustered(700)
    assert pairs(spark, fps) == near(fps, 2) != set()


@pytest.mark.parametrize("parts", [(2,), (3,), (4,), (5,)])
def test_any_number_of_parts(spark, parts):
    fps = clustered(300, seed=parts[0])
    assert pairs(spark, fps, parts=parts) == near(fps, 2)


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_any_distance(spark, distance):
    fps = clustered(200, seed=9, flips=6)
    assert pairs(spark, fps, distance=distance) == near(fps, distance)


@pytest.mark.parametrize("heavy", [0, 3, 40])
def test_hot_values(spark, heavy):
    fps = clustered(400, seed=5)
    assert pairs(spark, fps, heavy=heavy) == near(fps, 2)


def test_thresholds_are_the_cheapest():
    fps = np.random.default_rng(3).integers(0, 2**64, 2000, np.uint64)
    fps[::2] &= np.uint64(2**64 - 2**20)  # the first part of half of them is alike
    plan = S.Plan([list(range(0, 20)), list(range(20, 45)), list(range(45, 64))], 2, len(fps))
    plan.count([[np.bincount(S.pick(fps, bits), minlength=1 << len(bits)).astype(float) for bits in S.pieces(part)] for part in plan.parts])
    chosen, cost = plan.thresholds(fps)
    assert (chosen.sum(axis=1) == 2 - 3 + 1).all() and chosen.min() >= -1
    of_parts = [plan.costs(fps, k) for k in range(3)]
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    least = np.min([sum(of_parts[k][:, t + 1] for k, t in enumerate(v)) for v in every], axis=0)
    assert np.allclose(cost, least)
    assert np.allclose(sum(of_parts[k][np.arange(len(fps)), chosen[:, k] + 1] for k in range(3)), least)
    assert (chosen[::2, 0] == -1).all() and (chosen[1::2] == 0).all()


def test_estimates_of_one_piece_are_counts():
    fps = np.array(clustered(200, seed=4), np.uint64)
    bits = list(range(10))
    plan = S.Plan([bits, list(range(10, 64))], 2, len(fps))
    plan.count([[np.bincount(S.pick(fps, p), minlength=1 << len(p)).astype(float) for p in S.pieces(part)] for part in plan.parts])
    values = S.pick(fps, bits)
    for threshold, probes in ((0, 1), (1, 11), (2, 56)):
        within = [sum((int(v) ^ int(o)).bit_count() <= threshold for o in values) for v in values]
        assert np.allclose(plan.costs(fps, 0)[:, threshold + 1], np.array(within) * S.CANDIDATE + probes)


def test_correlated_bits_are_grouped():
    rng = np.random.default_rng(1)
    source = rng.integers(0, 2, (4000, 4))
    owner = rng.permutation(np.repeat(np.arange(4), 16))
    bits = (source[:, owner] ^ (rng.random((4000, 64)) < 0.1)).astype(float)
    parts = S.grouped(bits.T @ bits, 4000, 4)
    assert sorted(map(tuple, parts)) == sorted(tuple(np.flatnonzero(owner == k).tolist()) for k in range(4))
    assert sorted(b for p in S.grouped(np.zeros((64, 64)), 0, 3) for b in p) == list(range(64))


def expected(rows):
    """doc_id, fingerprint, smallest id reachable; by all pairs."""
    fps = [plain(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                gone = label[i]
                label = [label[j] if x == gone else x for x in label]
    low = {x: min((r[0] for r, y in zip(rows, label, strict=True) if y == x and r[0] is not None), default=None) for x in label}
    return sorted(((r[0], f"{fp:016x}", low[x]) for r, fp, x in zip(rows, fps, label, strict=True)), key=str)


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        if rows and i % 2:
            text = rng.choice(rows)[1]
            parts = text.split()
            if parts and i % 4 == 1:
                parts[rng.randrange(len(parts))] = rng.choice(words)
            text = " ".join(parts)
        else:
            text = " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 30, 400])))
        rows.append((None if i % 29 == 28 else (i * 37) % 150 - 20, text))
    found = rows_of(S.simhash_groups(frame(spark, [(i, t, None, None, None) for i, t in rows])))
    assert sorted((tuple(r.values()) for r in found), key=str) == expected(rows)
    assert len({r["component_id"] for r in found}) < len({r["fingerprint"] for r in found})


def test_odd_documents(spark):
    odd = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in rows_of(odd.select("doc_id", "text"))]
    found = [tuple(r.values()) for r in rows_of(S.document_simhash(odd))]
    assert sorted(found, key=str) == expected(rows)
    assert rows_of(S.document_simhash(no_documents(spark))) == []


def test_empty_texts_are_one_group(spark):
    found = by_id(S.document_simhash(documents(spark, {5: None, 3: "", 9: " \n", 4: "some words here"})))
    assert [found[i]["component_id"] for i in (3, 5, 9, 4)] == [3, 3, 3, 4]
    assert found[5]["fingerprint"] == "0" * 16
    assert S.document_simhash(documents(spark, {1: "x"})).dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]


def test_whole_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r.values()) for r in rows_of(S.document_simhash(docs))), key=str) == expected(rows)
