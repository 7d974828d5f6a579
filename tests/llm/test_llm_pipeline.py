import re

import pytest
from llm_cases import SCHEMA, documents, frame, rows_of

import corpus_pipeline
from bizmetrics.llm import decontamination, near_duplicates, secret_scan, toxicity
from bizmetrics.llm.common import stored


@pytest.fixture(scope="module")
def kept(spark, small_dir):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small_dir), name)
        out.append((name, docs))
    return dict(out)


def test_stages_in_order(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scan", "sentencepiece"]
    columns = kept["documents"].columns
    assert all(kept[name].columns == columns for name in list(kept)[:-1])


def test_each_stage_decides_on_its_own_input(spark, kept, small_dir):
    ids = {name: [r["doc_id"] for r in df.select("doc_id").collect()] for name, df in kept.items()}
    chain = toxicity.train(kept["documents"], spark.read.parquet(f"{small_dir}/labels.parquet"))
    toxic = {r["doc_id"] for r in rows_of(toxicity.score(kept["documents"], chain)) if r["p_toxic"] > 0.5}
    assert set(ids["toxicity"]) == set(ids["documents"]) - toxic and toxic
    groups = rows_of(near_duplicates.near_duplicates(kept["toxicity"], 5, 80))
    assert sorted(ids["near_dedup"]) == sorted(r["doc_id"] for r in groups if r["kept"]) and len(ids["near_dedup"]) < len(groups)
    hit = {r["doc_id"] for r in rows_of(decontamination.decontaminate(kept["near_dedup"], spark.read.parquet(f"{small_dir}/benchmark.parquet"))) if r["contaminated"]}
    assert set(ids["decontamination"]) == set(ids["near_dedup"]) - hit and hit
    assert sorted(ids["secret_scan"]) == sorted(ids["decontamination"])
    assert set(ids["sentencepiece"]) == set(ids["secret_scan"])


def test_secrets_are_masked_and_nothing_else_changes(spark, small_dir):
    texts = {1: 'x token = "abcdef12" y', 2: "plain", 3: "a " + "deadbeef" * 3, 4: None, 5: ""}
    docs = documents(spark, texts)
    before, after = ({r["doc_id"]: r for r in rows_of(df)} for df in (docs, corpus_pipeline.mask_secrets(spark, docs, small_dir)))
    changed = [i for i in before if before[i]["text"] != after[i]["text"]]
    assert changed == [1, 3] and all(secret_scan.MASK in after[i]["text"] for i in changed)
    assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in changed)
    assert all(before[i] == after[i] for i in before if i not in changed)
    assert not any(re.search(r"[0-9a-f]{24,}", r["text"] or "") for r in after.values())


def test_run_gives_the_same(spark, kept, small_dir):
    wanted = sorted((r["doc_id"], r["sample"], r["ids"]) for r in rows_of(kept["sentencepiece"]))
    assert sorted((r["doc_id"], r["sample"], r["ids"]) for r in rows_of(corpus_pipeline.run(spark, small_dir))) == wanted


def test_odd_rows(spark, small_dir):
    odd = frame(spark, [(None, "no id", None, None, None), (None, "no id", None, None, None), (1, None, None, None, None), (2, "", "", "", 0), (3, "same", "x", "y", 4), (3, "same", "x", "y", 4)])
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small_dir))
    found = [r["doc_id"] for r in rows_of(docs.select("doc_id", "sample").where("sample = 0"))]
    assert sorted(i or 0 for i in found) == [0, 0, 1, 2, 3]
    empty = frame(spark, [], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, small_dir))
    assert empty.count() == 0


def text_of(seed):
    return " ".join(f"s{seed}w{i}" for i in range(40))


def test_each_text_has_its_own_verdict_on_copies(spark, small_dir):
    rows = [(1, text_of(1)), (7, text_of(2)), (7, text_of(3)), (7, text_of(1)), (7, text_of(3)), (None, text_of(1)), (None, text_of(1) + " more"), (None, text_of(4)), (9, text_of(3)), (9, None)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    found = [(r["doc_id"], r["text"]) for r in rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, small_dir))]
    wanted = [(1, text_of(1)), (7, text_of(2)), (7, text_of(3)), (None, text_of(4)), (9, None)]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_each_text_has_its_own_verdict_on_leaks(spark, small_dir):
    leak = spark.read.parquet(f"{small_dir}/benchmark.parquet").where("length(text) > 100").first()["text"]
    docs = frame(spark, [(i, t, None, None, None) for i, t in [(None, leak), (None, "clean"), (5, leak), (5, "clean too"), (5, None), (6, f"x {leak}")]])
    found = [(r["doc_id"], r["text"]) for r in rows_of(corpus_pipeline.drop_contaminated(spark, docs, small_dir))]
    assert sorted(found, key=str) == sorted([(None, "clean"), (5, "clean too"), (5, None)], key=str)


def test_extra_columns_are_kept(spark, small_dir):
    docs = documents(spark, {1: "token = 'abcdefgh'"}).selectExpr("*", "7 AS id", "'a' AS words", "1 AS _before_me")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small_dir))
    (row,) = rows_of(docs)
    assert row["id"] == 7 and row["words"] == "a" and secret_scan.MASK in row["text"]


OWN_NAMES = ("_before", "_key", "_id", "_rest", "_text", "_low", "_high", "_first", "row", "key", "id", "shared", "low", "first", "component_id", "kept")


def test_columns_of_any_name_come_back_as_they_were(spark, small_dir):
    secret = "x token = 'abcdefgh' y"
    docs = documents(spark, {1: secret, 2: text_of(1), 3: text_of(1), 4: None}).unionByName(documents(spark, {2: text_of(5), None: "no id"}))
    for name in OWN_NAMES:
        docs = docs.selectExpr("*", f"concat('{name}', doc_id) AS {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, small_dir))
        assert after.columns == docs.columns
        docs = after
    rows = rows_of(docs)
    assert sorted((r["doc_id"] or 0 for r in rows)) == [0, 1, 2, 2, 4]
    for r in rows:
        assert all(r[name] == (None if r["doc_id"] is None else f"{name}{r['doc_id']}") for name in OWN_NAMES)
        assert not any("abcdefgh" in str(value) for value in r.values())


def test_without_a_number_of_characters(spark, small_dir):
    docs = documents(spark, {1: "x token = 'abcdefgh' y"}).select("text", "doc_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small_dir))
    (row,) = rows_of(docs)
    assert docs.columns == ["text", "doc_id"] and secret_scan.MASK in row["text"]


def test_of_repeated_rows_the_first_stays(spark, small_dir):
    rows = [(1, "same words here", "en", lang, 1) for lang in ("c", "a", None, "b")]
    for order in (rows, rows[::-1]):
        kept = rows_of(corpus_pipeline.drop_near_duplicates(spark, frame(spark, order).repartition(3), small_dir))
        assert [r["source"] for r in kept] == [None] or [r["source"] for r in kept] == ["a"]
    once = {str(rows_of(corpus_pipeline.drop_near_duplicates(spark, frame(spark, order).repartition(2), small_dir))) for order in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(once) == 1
