import random

import numpy as np
from llm_cases import by_id, documents, no_documents, odd_documents, rows_of

from bizmetrics.llm import components as C
from bizmetrics.llm import near_duplicates as N


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_force(texts, size, percent):
    sets = {i: sets_of(t, size) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


def families(seed, groups, members, length):
    r = random.Random(seed)
    texts, i = {}, 0
    for _ in range(groups):
        base = [f"w{r.randrange(500)}" for _ in range(length)]
        for _ in range(members):
            own = list(base)
            for _ in range(r.randrange(0, 8)):
                own[r.randrange(length)] = f"x{r.randrange(10**6)}"
            texts[i] = " ".join(own)
            i += 1
    return texts


def test_equals_brute_force(spark):
    texts = families(1, 12, 12, 120) | families(2, 1, 1, 2) | {900: None, 901: "", 902: "A b", 903: "a B", 904: "a"}
    found = by_id(N.near_duplicates(documents(spark, texts), 3, 85))
    for i, (size, low) in brute_force(texts, 3, 85).items():
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (size, low, low == i)


def test_blocks_lose_no_link(spark, monkeypatch):
    texts = families(3, 2, 60, 100)
    monkeypatch.setattr(N, "SIGNATURE_BLOCK", 9)
    monkeypatch.setattr(N, "SET_BLOCK", 7)
    found = by_id(N.near_duplicates(documents(spark, texts), 5, 80))
    assert {i: r["component_id"] for i, r in found.items()} == {i: low for i, (_, low) in brute_force(texts, 5, 80).items()}


def swapped(words, places, r):
    own = list(words)
    for k in places:
        own[k] = f"x{r.randrange(10**9)}"
    return own


def shapes(seed):
    """A chain in which only neighbours are similar, a star, and two stars that one text joins."""
    r = random.Random(seed)
    texts, i = {}, 0
    chain = [f"c{k}" for k in range(120)]
    for step in range(24):
        texts[i], i = " ".join(chain), i + 1
        chain = swapped(chain, range(4 * step % 120, 4 * step % 120 + 4), r)
    for name in "de":
        hub = [f"{name}{k}" for k in range(120)]
        for _ in range(30):
            texts[i], i = " ".join(swapped(hub, [r.randrange(120)], r)), i + 1
    one = [f"f{k}" for k in range(160)]
    for apart in (0, 6, 12):
        other = swapped(one, range(20, 20 + apart), random.Random(1))
        for _ in range(25 if apart != 6 else 1):
            texts[i], i = " ".join(swapped(other, [r.randrange(60, 160)] if apart != 6 else [], r)), i + 1
    ids = list(texts)
    r.shuffle(ids)
    return dict(zip(ids, texts.values(), strict=True))


def test_pivots_and_parts_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(N, "SET_BLOCK", 5)
    monkeypatch.setattr(N, "PIVOT_CHUNK", 3)
    texts = shapes(8) | {1000 + i: t for i, t in families(9, 2, 40, 90).items()}
    found = by_id(N.near_duplicates(documents(spark, texts), 3, 85))
    wanted = brute_force(texts, 3, 85)
    assert len({low for _, low in wanted.values()}) > 5
    assert {i: r["component_id"] for i, r in found.items()} == {i: low for i, (_, low) in wanted.items()}


def test_a_large_group_is_not_copied_for_each_block(spark, monkeypatch):
    """Candidates that are all one component: every text near the first, and a few that are like nothing else."""
    monkeypatch.setattr(N, "SET_BLOCK", 16)
    monkeypatch.setattr(N, "PIVOT_CHUNK", 8)
    r = random.Random(10)
    base = [f"w{k}" for k in range(100)]
    texts = {i: " ".join(swapped(base, [r.randrange(100)], r) if i % 50 else [f"y{i}.{k}" for k in range(100)] if i else base) for i in range(1600)}
    candidates = spark.createDataFrame([(0, i) for i in range(1, 1600)], "a long, b long")
    exchanged, grouped = [], N.by_group
    monkeypatch.setattr(N, "by_group", lambda rows, *others: exchanged.append(rows.count()) or grouped(rows, *others))
    found = C.connected_components(N.links(documents(spark, texts), candidates, 3, 85, "doc_id", "text"))
    assert {x["node"] for x in rows_of(found)} == {i for i in texts if i % 50 or not i}
    assert {x["component"] for x in rows_of(found)} == {0}
    assert sum(exchanged) < 6 * len(texts)


def test_pigeonhole_guarantee():
    r = np.random.default_rng(4)
    m = N.chunks(85)
    symbols, distance = N.SYMBOLS * m, 2 * m - 1
    for _ in range(300):
        one = r.integers(0, 2**16, symbols, dtype=np.uint16)
        two = one.copy()
        places = r.choice(symbols, distance, replace=False)
        two[places] ^= 1
        a, b = N.index_keys(np.stack([one, two]))
        assert set(a) & set(b)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(5)
    shared, own, other = (r.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    a, b = N.signatures([np.concatenate([shared, own]), np.concatenate([shared, other])], 4000)
    assert abs((a == b).mean() - 0.8) < 0.03


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (102, 100), (200, 200), (7, 300)]
    found = {r["node"]: r["component"] for r in rows_of(C.connected_components(spark.createDataFrame(chain, "a long, b long")))}
    assert found == {i: 0 for i in range(51)} | {300: 0, 100: 100, 101: 100, 102: 100}
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_intersections_equal_brute_force():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 60, n, dtype=np.uint64)) for n in (40, 1, 30, 25, 0, 40)]
    wanted = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    found = N.intersections(sets)
    np.fill_diagonal(found, 0)
    np.fill_diagonal(wanted := np.array(wanted), 0)
    assert (found == wanted).all()


def test_odd_rows(spark):
    found = rows_of(N.document_groups(odd_documents(spark)))
    assert len(found) == 9
    assert all(r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] and r["kept"] for r in found if r["doc_id"] in (1, 2, 3))
    assert [r["component_id"] for r in found if r["doc_id"] == 5] == [5, 5]
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]
    assert N.document_groups(no_documents(spark)).count() == 0
