import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, no_documents, odd_documents, rows_of
from tokenizers import Tokenizer

from bizmetrics.llm import token_blocks as T
from bizmetrics.llm.common import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "'s", "a", "Bc", "é", ".", ",", "!", "#", "1", "\t", "\x1c", "\x85", " ", "don't", "×", "ñ", "漢", "😀", '"', "\r", "$5", "<|endoftext|>"]


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 300)), max_size=900), st.integers(1, 700))
def test_file_round_trip_and_ranges(ids, step):
    ids, stream = np.array(ids, np.uint32), io.BytesIO()
    writer = T.Writer(stream)
    for i in range(0, len(ids), step):
        writer.add(ids[i : i + step], np.array([len(ids[i : i + step])]))
    writer.close()
    reader = T.Reader(Source(stream.getvalue()))
    assert reader.range(0, len(ids)).tolist() == ids.tolist()
    assert reader.range(len(ids) // 3, len(ids) // 2 + 1).tolist() == ids[len(ids) // 3 : len(ids) // 2 + 1].tolist()
    assert np.concatenate([np.empty(0, np.uint32), *(x for _, _, x in reader.documents(100))]).tolist() == ids.tolist()


def test_outliers_are_exceptions():
    ids = np.full(T.BLOCK, 5, np.uint32)
    ids[[3, 200]] = 2**31, 70_000
    data, starts = T.encode_blocks(ids)
    assert len(data) == 7 + 2 * (1 + 4) and T.decode_blocks(np.frombuffer(data, np.uint8), starts).tolist() == ids.tolist()


def test_damaged_file_is_refused():
    stream = io.BytesIO()
    writer = T.Writer(stream)
    writer.add(np.arange(10, dtype=np.uint32), np.array([10]))
    writer.close()
    with pytest.raises(ValueError):
        T.Reader(Source(stream.getvalue()[:-1]))


def test_pieces_encode_as_whole_texts():
    r = random.Random(1)
    texts = ["".join(r.choices(PARTS[:-1], k=r.randint(0, 30))) for _ in range(3000)] + [None, "", " ", " a", "a ", "a  b"]
    tokenizer = Tokenizer.from_file(PATH)
    ids, counts = T.byte_bpe_encoder(PATH)(pa.array(texts), 0)
    ends = np.cumsum(counts)
    for text, begin, end in zip(texts, ends - counts, ends):
        assert ids[begin:end].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_query_equals_brute_force(spark):
    r = random.Random(2)
    texts = {i: "".join(r.choices(PARTS, k=r.randint(0, 60))) for i in range(50, 0, -1)} | {60: None, 61: "", 62: "x" * 5000}
    found = sorted(rows_of(T.document_tokens(documents(spark, texts).repartition(3))), key=lambda x: x["doc_id"])
    tokenizer, start = Tokenizer.from_file(PATH), 0
    tokenizer.encode_special_tokens = True
    for row, (i, text) in zip(found, sorted(texts.items()), strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert row == {"doc_id": i, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        start += len(ids)


def test_files_are_in_order_of_ids(spark):
    manifest = T.write(documents(spark, {i: f"text {i}" for i in range(200)}).repartition(5), scratch_dir(spark), PATH)
    ids = [i for row in sorted(rows_of(manifest), key=lambda x: x["part"]) for i in row["ids"]]
    assert ids == list(range(200))


def test_odd_rows(spark):
    found = rows_of(T.document_tokens(odd_documents(spark)))
    assert len(found) == 9 and sum(r["n_tokens"] == 1 for r in found) == 2
    assert [r["start"] for r in found if r["doc_id"] is None] == [0]
    assert T.document_tokens(no_documents(spark)).count() == 0
