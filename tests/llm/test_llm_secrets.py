import hashlib
import math
import random
import re
import time
from collections import Counter
from itertools import accumulate

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import by_id, documents, frame, no_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from bizmetrics.llm import secret_scan as S

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute_force(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    base = sorted(spans)
    for k, cls in enumerate(S.CLASSES):
        for m in re.finditer(f"{cls.alphabet}{{{S.WINDOW},}}", text):
            if re.search(S.ALLOWED_RUNS, m[0]):
                continue
            cuts = [(0, 0), *(w.span() for w in re.finditer(S.ALLOWED_WORDS, m[0])), (len(m[0]), len(m[0]))]
            for (_, begin), (end, _) in zip(cuts, cuts[1:]):
                part = m[0][begin:end]
                if not re.search(cls.must_hold, part):
                    continue
                dense = [i for i in range(len(part) - S.WINDOW + 1) if sum(S.weight(c) for c in Counter(part[i : i + S.WINDOW]).values()) <= S.limit(cls.entropy)]
                if dense:
                    spans.append((m.start() + begin + dense[0], 3 + k, m.start() + begin + dense[-1] + S.WINDOW))
    join = lambda found: ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    return hashlib.sha256(join(base).encode()).hexdigest(), join(spans)


parts = st.sampled_from(
    ["token", "PassWord", "api_key", "apikey", "secret", '"', "'", " ", " = ", ":", "abc12", "abcdef", "x/y.z-0=", "AKIA", "ABCD0123", "é😀", "\n", "deadbeef", "0123456789", "Zq7kL2mX9vB4nR8tY3wE", "=", "EXAMPLE", "========"]
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(parts, max_size=14).map("".join), min_size=1, max_size=40))
def test_spans_equal_brute_force(spark, texts):
    found = by_id(S.document_secrets(documents(spark, dict(enumerate(texts)))))
    for i, text in enumerate(texts):
        assert (found[i]["base_sha256"], found[i]["spans"]) == brute_force(text)


def test_entropy_weights():
    window = "ab" * 10
    bits = math.log2(20) - sum(S.weight(c) for c in Counter(window).values()) / 20e6
    assert abs(bits - 1.0) < 1e-6


def test_allow_list_and_window(spark):
    secret, uuid = "Zq7kL2mX9vB4nR8tY3wE5uPa", "123e4567-e89b-12d3-a456-426614174000"
    found = by_id(S.document_secrets(documents(spark, {1: f"a {secret} b", 2: f"{secret}EXAMPLE", 3: uuid, 4: "g" * 300 + "1"})))
    assert found[1]["spans"] == f"entropy_base64:2:{2 + len(secret)}"
    assert found[2]["spans"] == f"entropy_base64:0:{len(secret)}"  # the word beside the key takes only windows that it overlaps
    assert found[3]["spans"] == found[4]["spans"] == ""


def test_keys_beside_allowed_words_are_found(spark):
    key = "Zx9Qw2Er7Ty4Ui1Op8As5Df3Gh6Jk0Lm"
    beside = ["/sample/x", "--------", "=" * 30, "0123456789", "dummy"]
    texts = {i: f"{word}{key}" for i, word in enumerate(beside)} | {10 + i: f"{key}{word}" for i, word in enumerate(beside)} | {20: f"{key}/sample/{key}", 21: "Zx9Qw2Er7Tysample4Ui1Op8As"}
    found = by_id(S.document_secrets(documents(spark, texts)))
    for i, text in texts.items():
        assert (found[i]["base_sha256"], found[i]["spans"]) == brute_force(text)
        assert found[i]["spans"].count("entropy") == {20: 2, 21: 0}.get(i, 1)
    masked = by_id(S.redact(documents(spark, texts)))
    assert not any(key in r["text"] for r in masked.values())


def test_many_spans_in_one_text(spark):
    texts = {1: "é token=abcdef1 x\n" * 20_000, 2: "token=abcdef1" + " " * 9000 + "secret:abcdefg", 3: "y" * 5000 + " passwd=zzzzzzz"}
    found = by_id(S.redact(documents(spark, texts)))
    assert found[1]["text"] == f"é {S.MASK} x\n" * 20_000
    assert found[2]["text"] == S.MASK + " " * 9000 + S.MASK and found[3]["text"] == "y" * 5000 + f" {S.MASK}"
    spans = by_id(S.document_secrets(documents(spark, texts)))
    for i, text in texts.items():
        assert (spans[i]["base_sha256"], spans[i]["spans"]) == brute_force(text)


def test_a_text_of_hashes_costs_little_more_than_prose(spark):
    r = random.Random(1)
    hashes = " ".join("".join(r.choices("0123456789abcdef", k=64)) for _ in range(3000))
    prose = " ".join("".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(30_000))

    def seconds(text):
        given = documents(spark, {i: text for i in range(4)}).coalesce(1)
        S.document_secrets(given).collect()
        began = time.time()
        S.document_secrets(given).collect()
        return time.time() - began

    assert seconds(hashes) < 2 + 10 * seconds(prose)


def test_running(spark):
    values = [[1], list(range(1000)), [5, 1, 9] * 300]
    given = frame(spark, [(v,) for v in values], "v array<long>")
    found = rows_of(given.select(S.running(F.col("v"), S.plus).alias("sums"), S.running(F.col("v"), lambda high, x: F.greatest(high, x)).alias("tops")))
    assert [(r["sums"], r["tops"]) for r in found] == [(list(accumulate(v)), list(accumulate(v, max))) for v in values]


def test_redact(spark):
    texts = {1: 'x token = "abcdef12" y', 2: "plain", 3: None, 4: "deadbeefdeadbeefdeadbeef0 é secret: longenough", 5: ""}
    found = by_id(S.redact(documents(spark, texts)))
    assert found[1]["text"] == f'x {S.MASK}" y' and found[2]["text"] == "plain" and found[3]["text"] is None
    assert found[4]["text"] == f"{S.MASK} é {S.MASK}" and found[5]["text"] == ""


def test_odd_rows(spark):
    found = rows_of(S.document_secrets(odd_documents(spark)))
    empty = hashlib.sha256(b"").hexdigest()
    assert len(found) == 9 and all(r["base_sha256"] == empty and r["spans"] == "" for r in found)
    assert S.document_secrets(no_documents(spark)).count() == 0


def test_plan_has_no_python(spark, small_dir):
    plan = S.document_secrets(spark.read.parquet(f"{small_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
