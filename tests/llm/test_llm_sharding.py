from collections import Counter

import pytest
from llm_cases import no_documents, odd_documents, rows_of

from bizmetrics.llm import sharding


def brute_force(names, slots, weights=None):
    orders = {n: [(o + j * s) % slots for j in range(slots)] for n in names for o, s in [sharding.preference(n, slots)]}
    owner = {}
    while len(owner) < slots:
        for i, n in enumerate(names):
            for _ in range((weights or {}).get(n, 1)):
                if len(owner) < slots:
                    owner[next(s for s in orders[n] if s not in owner)] = i
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("weights", [None, {"shard-00001": 3}])
def test_fill_takes_turns(weights):
    names = sharding.shard_names(7)
    assert sharding.fill(names, 101, weights) == brute_force(names, 101, weights)


def test_slots_are_shared_equally_and_few_move():
    before, after = (sharding.fill(sharding.shard_names(n), sharding.SLOTS) for n in (64, 65))
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after) if b != 64)
    assert moved < 0.1 * len(before)


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b"], 1)])
def test_refuses_bad_tables(names, slots):
    with pytest.raises(ValueError):
        sharding.fill(names, slots)


def test_odd_rows(spark):
    found = rows_of(sharding.place(odd_documents(spark), "doc_id", sharding.shard_names(5), 101))
    assert len(found) == 9 and all(0 <= r["shard"] < 5 and 0 <= r["slot"] < 101 for r in found)
    same = {r["shard"] for r in found if r["doc_id"] == 5}
    assert len(same) == 1
    assert sharding.document_shards(no_documents(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = sharding.document_shards(odd_documents(spark).where("doc_id > 1"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
