import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import by_id, documents, no_documents, odd_documents, rows_of

from bizmetrics.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return S.load(PATH)


@pytest.fixture(scope="module")
def pieces():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}


def every_path(model, pieces, text):
    """All segmentations and their log probabilities, by brute force."""
    text, out = S.SPACE + text.replace(" ", S.SPACE), []

    def go(at, ids, weight):
        if at == len(text):
            out.append((tuple(ids), weight))
        for size in range(1, min(16, len(text) - at) + 1):
            if (i := pieces.get(text[at : at + size])) is not None:
                go(at + size, [*ids, i], weight + model.final_weight[i])
        if at < len(text) and text[at] not in pieces:
            raw = text[at].encode()
            go(at + 1, [*ids, *(int(model.byte_ids[b]) for b in raw)], weight + model.byte_weight * len(raw))

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in out])
    return {ids: float(w - total) for ids, w in out}


def drawn(sampler, count, k):
    rows = [[] for _ in range(count)]
    for s, path in enumerate(sampler.found):
        flat, counts = sampler.ids(s)
        ends = np.cumsum(counts)
        for text, a, b, log_prob, value in zip(path.texts, ends - counts, ends, path.log_prob, path.value):
            rows[text].append((tuple(flat[a:b].tolist()), float(log_prob), float(value)))
    return rows


@pytest.mark.parametrize("text, k", [("of a", 3), ("the\n", 3), ("né 😀", 4), ("x", 5), ("a  b1", 4)])
def test_draws_without_replacement_from_the_exact_distribution(model, pieces, text, k):
    count, wanted = 4000, every_path(model, pieces, text)
    rows = drawn(S.Sampler(model, list(map(str, range(count))), [text] * count, k), count, k)
    first, pairs = Counter(), Counter()
    for row in rows:
        assert len(row) == min(k, len(wanted)) == len({ids for ids, _, _ in row})
        assert all(wanted[ids] == pytest.approx(log_prob) for ids, log_prob, _ in row)
        assert [v for _, _, v in row] == sorted((v for _, _, v in row), reverse=True)
        first[row[0][0]] += 1
        pairs[tuple(ids for ids, _, _ in row[:2])] += 1
    for ids, log_prob in wanted.items():
        mean = count * math.exp(log_prob)
        assert abs(first[ids] - mean) < 5 * math.sqrt(mean) + 3
    for a in wanted:
        for b in wanted:
            if a != b:
                mean = count * math.exp(wanted[a] + wanted[b]) / -math.expm1(wanted[a])
                assert abs(pairs[a, b] - mean) < 5 * math.sqrt(mean) + 3


def test_inclusion_scores_weigh_to_one(model):
    count, k = 6000, 2
    sampler = S.Sampler(model, list(map(str, range(count))), ["the of"] * count, k)
    total = 0.0
    for path in sampler.found:
        total += np.exp(path.log_prob - S.log_inclusion(path.log_prob, sampler.threshold[path.texts])).sum()
    assert total / count == pytest.approx(1.0, abs=0.1)


def test_log_inclusion():
    x = np.array([-800.0, -31.0, -29.0, 0.0, 5.0, np.inf])
    found = S.log_inclusion(x, np.zeros(6))
    assert found[0] == -800 and found[1] == pytest.approx(-31) and found[2] == pytest.approx(-29, abs=1e-9)
    assert found[3] == pytest.approx(math.log(1 - math.exp(-1))) and found[4] == pytest.approx(0, abs=1e-9) and found[5] == 0


def test_far_subtrees_are_looked_at_when_near_ones_are_light(model):
    # A text whose only other segmentations begin late still has k samples.
    text = "x" + "\n" * 300 + " of the"
    rows = drawn(S.Sampler(model, ["a", "b"], [text] * 2, 3), 2, 3)
    assert all(len({ids for ids, _, _ in row}) == 3 for row in rows)


def test_pieces_cross_no_segment(model):
    for piece in (t.decode("utf-8", "replace") for t in model.texts if t):
        assert "".join(S.SEGMENT.findall(piece.replace(" ", S.SPACE))) == piece.replace(" ", S.SPACE)


def test_samples_do_not_depend_on_partitions(spark, small_dir):
    given = spark.read.parquet(f"{small_dir}/documents.parquet").where("doc_id < 60")
    one, two = (sorted(map(str, rows_of(S.document_samples(given.repartition(n))))) for n in (1, 7))
    assert one == two and len(one) >= 100


def test_round_trip_through_spark(spark):
    texts = {1: "Hello  world 12.5\nfoo_bar\tñ 漢字 😀", 2: " leading and trailing ", 3: "a" * 3000, 4: "tab\x00nul"}
    ids = S.sample(documents(spark, texts), PATH, k=3)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = rows_of(S.decode(ids, PATH))
    assert len(found) == 12 and all(r["text"] == texts[r["doc_id"]] and r["round_trip"] for r in found)
    for r in rows_of(ids):
        assert sp.decode(r["ids"]) == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
    assert len({(r["doc_id"], tuple(r["ids"])) for r in rows_of(ids)}) == 12


def test_odd_rows(spark):
    found = rows_of(S.document_samples(odd_documents(spark)))
    assert Counter(r["doc_id"] for r in found) == {None: 2, 1: 1, 2: 1, 3: 2, 4: 2, 5: 4, 6: 2, 7: 2}
    assert all(r["round_trip"] for r in found)
    assert len({str(r) for r in found if r["doc_id"] == 5}) == 2
    assert [(r["n_tokens"], r["log_inclusion"]) for r in found if r["doc_id"] in (1, 2)] == [(0, 0.0)] * 2
    assert S.document_samples(no_documents(spark)).count() == 0
    assert by_id(S.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), PATH))[1]["text"] == ""
