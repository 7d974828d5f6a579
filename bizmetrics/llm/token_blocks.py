"""Token ids in binary files of patched frame-of-reference blocks.

A file holds a stream of ids, cut into blocks of ``BLOCK`` ids. From a block its minimum is subtracted; the differences are packed at the
width that the 90th percentile of them needs; of larger ones (the exceptions) the low bits are packed like all others, and places and
high bits stand in a list after the packed ones. An index of block starts lets a reader decode any range of ids without the rest.

Layout, little-endian:

* ``PFORIDS1``
* blocks: minimum (4 bytes), width (1), number of exceptions (1), bytes of each high part (1: 1, 2 or 4), packed differences
  (4 * width words of 8 bytes; lane l holds ids 64 l to 64 l + 63), exception places (1 each), high parts. The last block is filled up with its minimum.
* index: byte of each block's start (8 each); per document its number of ids (8 each)
* footer: number of blocks, documents and ids (8 each), ``PFORIDS1``

``write`` deals documents to tasks by ranges of their id, sorts, and each task streams a file. A file's name is new for every attempt at a task, and
only files named by the manifest, which Spark commits, are read: lost executors and repeated attempts leave unnamed files, but no wrong ones.
Files are ordered by range, so their order is that of the ids.

Edge cases: null and empty texts are the end id alone; null ids come first; rows with the same id follow each other in the order of their texts' hashes and keep a row each;
an empty table has no files and no rows; columns besides id and text are ignored; ids are 32-bit.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizmetrics.llm.common import file_system, scratch_dir, ship_package, slices, stored

BLOCK, LANE = 256, 64
PERCENTILE = 0.9
MAGIC = b"PFORIDS1"
END_ID = 0
SLICE_BYTES = 6_000_000
CACHED_PIECES = 900_000


# ---- blocks


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values under 2 ** width, as rows of packed 8-byte words."""
    rows = len(values)
    lanes = np.ascontiguousarray(values.reshape(rows * (BLOCK // LANE), LANE).T.astype(np.uint64))
    out = np.zeros((width, lanes.shape[1]), np.uint64)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(rows, -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = len(words)
    lanes = np.ascontiguousarray(words.reshape(rows * (BLOCK // LANE), width).T)
    out = np.zeros((LANE, rows * (BLOCK // LANE)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        out[i] = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            out[i] |= lanes[word + 1] << np.uint64(64 - shift)
        out[i] &= mask
    return np.ascontiguousarray(out.T).reshape(rows, BLOCK)


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ids (a multiple of BLOCK of them), and the byte where each starts."""
    values = ids.astype(np.int64).reshape(-1, BLOCK)
    lowest = values.min(axis=1)
    values = values - lowest[:, None]
    at = max(0, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    width = _widths(np.partition(values, at, axis=1)[:, at])
    high = values >> width[:, None]
    rows, places = np.nonzero(high)
    parts = high[rows, places]
    exceptions = np.bincount(rows, minlength=len(values))
    most = _widths(high.max(axis=1))
    part_bytes = np.where(most > 16, 4, np.where(most > 8, 2, 1))
    sizes = 7 + 32 * width + exceptions * (1 + part_bytes)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(4):
        out[starts + k] = (lowest >> (8 * k)) & 255
    out[starts + 4], out[starts + 5], out[starts + 6] = width, exceptions, part_bytes
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        packed = _pack(values[which] & ((1 << int(w)) - 1), int(w)).view(np.uint8).reshape(len(which), -1)
        out[starts[which][:, None] + 7 + np.arange(32 * int(w))] = packed
    lists = starts + 7 + 32 * width
    order = np.arange(len(rows)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    out[lists[rows] + order] = places
    for k in range(4):
        own = part_bytes[rows] > k
        out[(lists[rows] + exceptions[rows] + order * part_bytes[rows] + k)[own]] = ((parts >> (8 * k)) & 255)[own]
    return out.tobytes(), starts


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at these bytes of ``data``."""
    field = lambda k: data[starts + k].astype(np.int64)
    lowest = field(0) | field(1) << 8 | field(2) << 16 | field(3) << 24
    width, exceptions, part_bytes = field(4), field(5), field(6)
    out = np.empty((len(starts), BLOCK), np.int64)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        packed = data[starts[which][:, None] + 7 + np.arange(32 * int(w))]
        out[which] = _unpack(np.ascontiguousarray(packed).view(np.uint64).reshape(len(which), -1), int(w)).astype(np.int64)
    rows = np.repeat(np.arange(len(starts)), exceptions)
    order = np.arange(len(rows)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    lists = starts + 7 + 32 * width
    places = data[lists[rows] + order]
    for k in range(4):
        own = part_bytes[rows] > k
        byte = data[(lists[rows] + exceptions[rows] + order * part_bytes[rows] + k)[own]].astype(np.int64)
        np.add.at(out, (rows[own], places[own]), byte << (width[rows[own]] + 8 * k))
    return (out + lowest[:, None]).ravel()


# ---- files


class Writer:
    """Streams documents' ids into one file."""

    def __init__(self, stream) -> None:
        self.stream, self.rest = stream, np.empty(0, np.uint32)
        self.starts: list[np.ndarray] = []
        self.documents: list[np.ndarray] = []
        self.at, self.ids = len(MAGIC), 0
        stream.write(MAGIC)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.documents.append(lengths.astype(np.int64))
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:].copy()

    def _blocks(self, ids: np.ndarray) -> None:
        if len(ids):
            data, starts = encode_blocks(ids)
            self.stream.write(data)
            self.starts.append(starts + self.at)
            self.at += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.full(BLOCK - len(self.rest), self.rest.min(), np.uint32)]))
        starts = np.concatenate(self.starts) if self.starts else np.empty(0, np.int64)
        documents = np.concatenate(self.documents) if self.documents else np.empty(0, np.int64)
        for part in (starts, documents, np.array([len(starts), len(documents), self.ids])):
            self.stream.write(part.astype("<u8").tobytes())
        self.stream.write(MAGIC)


class Reader:
    """Reads a file, whole or in parts."""

    FOOTER = 24 + len(MAGIC)

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        foot = self._read(size - self.FOOTER, self.FOOTER)
        blocks, documents, self.ids = (int(x) for x in np.frombuffer(foot[:24], "<u8"))
        if foot[24:] != MAGIC:
            raise ValueError("not a file of token blocks, or one that was cut off")
        index = np.frombuffer(self._read(size - self.FOOTER - 8 * (blocks + documents), 8 * (blocks + documents)), "<u8").astype(np.int64)
        self.starts, self.lengths = index[:blocks], index[blocks:]
        self.ends = np.append(self.starts[1:], size - self.FOOTER - 8 * (blocks + documents))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def range(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` (exclusive); only their blocks are read."""
        begin, end = max(0, begin), min(end, self.ids)
        if begin >= end:
            return np.empty(0, np.uint32)
        first, last = begin // BLOCK, (end - 1) // BLOCK
        data = np.frombuffer(self._read(int(self.starts[first]), int(self.ends[last] - self.starts[first])), np.uint8)
        ids = decode_blocks(data, self.starts[first : last + 1] - self.starts[first])
        return ids[begin - first * BLOCK : end - first * BLOCK].astype(np.uint32)

    def documents(self, most: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first document, their lengths, their ids), of about ``most`` ids at a time."""
        ends = np.cumsum(self.lengths)
        at = 0
        while at < len(ends):
            begin = int(ends[at] - self.lengths[at])
            until = max(at + 1, int(np.searchsorted(ends, begin + most, side="right")))
            yield at, self.lengths[at:until], self.range(begin, int(ends[until - 1]))
            at = until


# ---- encoding

#: White space as the tokenizer's pattern has it.
_SPACE = "\t-\r \x85\xa0  -     　"
#: The tokenizer's pattern cuts a text at these places at least (a run of white space gives its last space to what follows; letters never
#: join punctuation but the apostrophe), so pieces can be encoded apart.
_PIECES = re.compile(f" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,;:!?{_SPACE}]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_NO_BORDER = pa.array(["", *(chr(c) for c in range(0x3001) if re.match(f"[{_SPACE}]", chr(c)))])
_LOADED: dict[str, Encoder] = {}


class Encoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library.

    The file's pattern never merges across white space, so texts are cut at single spaces by Arrow, equal parts are found by
    Arrow too, and the tokenizer sees only pieces that are new to this worker.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        shape = json.loads(self.tokenizer.to_str())
        before = shape["pre_tokenizer"] or {}
        if shape["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("only byte-level tokenizers that split by pattern, without normalising, can be encoded by piece")
        self.pieces: dict[str, bytes] = {}
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _learn(self, new: list[str]) -> None:
        """Encode pieces. Those with other than white space in them go to the tokenizer by the thousand, between line breaks, which are pieces of their own."""
        lines = [piece for piece in new if not piece.isspace()]
        for i in range(0, len(lines), 1_000):
            some = lines[i : i + 1_000]
            (encoded,) = self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            data, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.line_break)).tolist()
            if len(cuts) != len(some) - 1:
                raise ValueError("a line break is not a token of its own here")
            self.pieces.update(zip(some, (data[begin:end] for begin, end in zip([0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True)), strict=True))
        for piece in (piece for piece in new if piece.isspace()):
            self.pieces[piece] = np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        """Each text's ids, 4 bytes each."""
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        known = self.pieces
        found = list(map(known.get, texts))  # most parts of texts are single pieces
        cut = {i: _PIECES.findall(texts[i]) for i, ids in enumerate(found) if ids is None}
        self._learn(list({piece for own in cut.values() for piece in own if piece not in known}))
        for i, own in cut.items():
            found[i] = known[own[0]] if len(own) == 1 else b"".join([known[piece] for piece in own])
        return found

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end`` after it, and their numbers. A null is an empty text."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists).dictionary_encode()
        code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A space that another white space follows may belong to a run; such texts are encoded whole.
        doubtful = pc.is_in(pc.utf8_slice_codeunits(flat.dictionary, 0, 1), _NO_BORDER).to_numpy(zero_copy_only=False)[code]
        parts = self.whole([" " + part for part in flat.dictionary.to_pylist()])
        heads = np.cumsum(count) - count
        doubtful[heads] = False
        odd = np.add.reduceat(doubtful, heads) > 0 if len(heads) else doubtful
        # Entries: the parts, then for each text its head or, if odd, all of it; then the end.
        plain = pc.list_element(lists, 0).to_pylist()
        own = self.whole([text if whole else head for text, head, whole in zip(texts.to_pylist() if odd.any() else plain, plain, odd.tolist(), strict=True)])
        entries = [*parts, *own, np.array([end], "<u4").tobytes()]
        code[heads] = len(parts) + np.arange(len(heads))
        of_text = np.repeat(np.arange(len(heads)), count)
        used = ~odd[of_text] | (np.arange(len(code)) == heads[of_text]) if len(code) else np.empty(0, bool)
        code, of_text = code[used], of_text[used]
        last = np.cumsum(np.bincount(of_text, minlength=len(heads)))
        code = np.insert(code, last, len(entries) - 1)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        lengths = np.add.reduceat(sizes[code], np.concatenate([[0], last[:-1] + np.arange(1, len(last))])) if len(heads) else np.empty(0, np.int64)
        stored_ids = np.frombuffer(b"".join(entries), "<u4")
        return stored_ids[_ranges((np.cumsum(sizes) - sizes)[code], sizes[code])], lengths


def byte_bpe_encoder(path: str) -> Encoder:
    """The encoder of a file, kept by the worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


# ---- tables


def write(texts: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the texts' ids in files under ``folder``, in ascending order of the id column; the manifest, a row per file."""
    spark = texts.sparkSession
    ship_package(spark)
    kind = texts.schema[id_column].dataType.simpleString()
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    order = ["id", F.xxhash64("text")]  # the texts' hashes part rows that share an id
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe_encoder(tokenizer)
        writer = stream = None
        names: list = []
        path = f"{folder}/{uuid.uuid4().hex}.pfor"
        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.schema.field("id").type
            for part in slices(batch, "text", SLICE_BYTES):
                if stream is None:
                    files, at = file_system(path)
                    files.create_dir(at.rpartition("/")[0], recursive=True)
                    stream = files.open_output_stream(at)
                    writer = Writer(stream)
                writer.add(*encode(part.column("text"), END_ID))
                names.append(part.column("id"))
        if stream is not None:
            writer.close()
            stream.close()
            ids = pa.concat_arrays(names)
            row = [TaskContext.get().partitionId()], [path], [writer.ids], [ids.to_pylist()]
            types = pa.int32(), pa.string(), pa.int64(), pa.list_(kind_of_id)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], names=["part", "path", "n_tokens", "ids"])

    return stored(dealt.mapInArrow(run, f"part int, path string, n_tokens long, ids array<{kind}>"), "manifest")


def read(manifest: DataFrame, columns: str, per_document: Callable[[np.ndarray], Sequence]) -> DataFrame:
    """Read files back: per document its id, ``start`` (ids in all files before it), ``n_tokens``, and ``columns`` from ``per_document`` (its ids)."""
    spark: SparkSession = manifest.sparkSession
    ship_package(spark)
    count = manifest.count()
    kind = manifest.schema["ids"].dataType.elementType.simpleString()
    # A row per file, so this window is as small as the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(manifest.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")), "part")
    schema = f"id {kind}, start long, n_tokens long, {columns}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind_of_id = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                files, at = file_system(batch.column("path")[i].as_py())
                base, ids = batch.column("base")[i].as_py(), batch.column("ids")[i].as_py()
                with files.open_input_file(at) as source:
                    for first, lengths, tokens in Reader(source).documents():
                        cuts = np.concatenate([[0], np.cumsum(lengths)])
                        rows = [per_document(tokens[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                        arrays = [pa.array(ids[first : first + len(lengths)], kind_of_id), pa.array(base + cuts[:-1], pa.int64()), pa.array(lengths, pa.int64())]
                        yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(list(c)) for c in zip(*rows, strict=True))], names=[x.split()[0] for x in schema.split(", ")])
                        base += int(cuts[-1])

    return placed.repartitionByRange(max(1, count), "part").mapInArrow(run, schema)


def crc32_of(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def document_tokens(documents: DataFrame) -> DataFrame:
    """Encode every document, write files, read them back; place, number and checksum of each document's ids."""
    import public_tokenizers

    spark = documents.sparkSession
    manifest = write(documents, f"{scratch_dir(spark)}/tokens", public_tokenizers.path("byte_bpe_50k.json"))
    return read(manifest, "ids_crc32 long", crc32_of).withColumnRenamed("id", "doc_id")
