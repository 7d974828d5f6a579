import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import by_id, documents, no_documents, odd_documents, rows_of

from bizmetrics.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_stop_words": sum(re.sub("[A-Z]", lambda m: m[0].lower(), w) in Q.STOP_WORDS for w in words),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAb \n#é😀\x0b!", max_size=60), min_size=1, max_size=40))
def test_measures_equal_brute_force(spark, texts):
    found = by_id(Q.measures(documents(spark, dict(enumerate(texts)))))
    for i, text in enumerate(texts):
        assert {k: found[i][k] for k in brute_force(text)} == brute_force(text)


def test_a_text_that_repeats_one_word(spark):
    found = by_id(Q.document_quality(documents(spark, {1: "a " * 5000})))[1]
    assert found["n_repeat_words"] == 5000 and found["base_failed"] and not found["kept"]


def test_windows_whose_hashes_nearly_agree_are_not_equal(spark):
    # The hashes of these two windows differ in their low 20 bits only, and a text of so many words needs 20 bits for a place.
    words = ["a", "b", "2811354", "a", "b", "8190362", *(f"w{i}" for i in range(530_000))]
    text = " ".join(words)
    assert brute_force(text)["n_repeat_words"] == 0
    found = by_id(Q.measures(documents(spark, {1: text, 2: text + " w0 w1 w2"})))
    assert [found[i]["n_repeat_words"] for i in (1, 2)] == [0, 6]


def test_rules(spark):
    plain = "The words of this text are all as they should be and it is kept by every rule that we have for it today".split()
    plain = " ".join(plain + [f"new{i}" for i in range(60)])
    texts = {1: plain, 2: plain + " ***" * 20, 3: "\n".join([*["x y the of"] * 3, *(f"the of w{i} v{i}" for i in range(20))]), 4: " ".join(f"w{i}" for i in range(80)), 5: "short"}
    found = by_id(Q.document_quality(documents(spark, texts)))
    assert found[1]["kept"]
    assert found[2]["failed_rules"] == "symbols" and not found[2]["kept"]
    assert found[4]["failed_rules"] == "stop_words"
    assert found[5]["base_failed"]


def test_stop_words_are_a_ratio_at_every_length(spark):
    junk = [f"w{i}" for i in range(10_000)]
    prose = "THE NAME OF IT IS NOT KNOWN AND NOBODY ASKS FOR IT".split()
    texts = {1: " ".join([*junk, "the", "of"]), 2: " ".join(w for i in range(30) for w in [*prose, f"x{i}"]), 3: " ".join(w for i, j in enumerate(junk) for w in ([j, "the"] if i % 10 == 0 else [j]))}
    found = by_id(Q.document_quality(documents(spark, texts)))
    assert found[1]["failed_rules"] == "stop_words" and found[1]["n_stop_words"] == 2
    assert "stop_words" not in found[2]["failed_rules"] and found[2]["n_stop_words"] == 30 * 7
    assert found[3]["kept"] and found[3]["n_stop_words"] == 1000


def test_odd_rows(spark):
    found = rows_of(Q.document_quality(odd_documents(spark)))
    assert len(found) == 9
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in found if r["doc_id"] in (1, 2, 3))
    assert Q.document_quality(no_documents(spark)).count() == 0


def test_one_projection_without_python_or_shuffle(spark):
    plan = Q.document_quality(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("Scan ExistingRDD", "") and "Exchange" not in plan


def test_filter_below_does_not_change_the_result(spark, small_dir):
    found = Q.document_quality(spark.read.parquet(f"{small_dir}/documents.parquet"))
    assert found.where("kept").count() == sum(r["kept"] for r in rows_of(found))
