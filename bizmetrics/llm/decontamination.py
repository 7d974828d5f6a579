r"""Benchmark decontamination with a distributed positional inverted index.

**Index.** The training texts are cut into shards of whole documents. A shard's row holds every term's posting list, the ascending places of
the term in the shard, and the places where documents begin. Rows are written to the shared folder: the index is stored, split by documents, serves any test set, and
each shard can be searched by any task. Postings are never shuffled, so a term that makes up a third of all words is in no task's way.

**Search.** A query is a window of terms. In each shard its lists are taken from the rarest to the most frequent: the rarest list, moved back by
its offset in the window, gives the possible starts, and each further list, moved by its own offset, strikes out those it doesn't hold. What
is left are the exact matches. For proximity matches a list may miss its place by ``slop`` words.

The test items are the query set. They are broadcast in blocks of at most ``BLOCK_TERMS`` window terms (or one item), so what a task holds is
bounded however many items there are; each block goes over the same stored index.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of texts with A-Z in lower case; terms are their 64-bit hashes.

Edge cases: null and empty texts have no words and match nothing; items without words are no queries; an item shorter than a window is one
window; equal windows of several items match for each of them; repeated documents give repeated rows; with no items every document is
clean, with no documents the result is empty; columns besides ids and texts are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.common import alnum_words, hashed, ship_package, slices, stored, tidy

WINDOW = 10
SHARD_BYTES = 8_000_000  # of text; a longer document is a shard of its own
BLOCK_TERMS = 2_000_000


@dataclass(frozen=True)
class Query:
    """A window of an item: its terms, by their places in the block's vocabulary."""

    item: int
    terms: tuple[int, ...]


@dataclass(frozen=True)
class Block:
    """Some items' windows, and the vocabulary they use."""

    names: tuple[str, ...]  # of items, as text
    words: tuple[bytes, ...]  # the vocabulary
    queries: tuple[Query, ...]


def windows(words: Sequence, size: int) -> list[tuple]:
    """Every run of ``size`` words; all of them if they are fewer, none if there are none."""
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def blocks(items: DataFrame, id_column: str, text_column: str, window: int, most: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of at most ``most`` window terms (or one item)."""
    names: list[str] = []
    words: dict[bytes, int] = {}
    queries: list[Query] = []
    size = 0
    rows = items.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    for row in rows.toLocalIterator():  # a stream: the driver holds one block at a time
        found = windows(alnum_words(row["text"]), window)
        if not found:
            continue
        more = sum(map(len, found))
        if queries and size + more > most:
            yield Block(tuple(names), tuple(words), tuple(queries))
            names, words, queries, size = [], {}, [], 0
        size += more
        names.append("" if row["id"] is None else row["id"])
        queries += [Query(len(names) - 1, tuple(words.setdefault(w, len(words)) for w in terms)) for terms in found]
    if queries:
        yield Block(tuple(names), tuple(words), tuple(queries))


INDEX_SCHEMA = "shard string, ids array<{id}>, n_words array<long>, begins array<long>, terms binary, counts binary, postings binary"


def build_index(texts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per shard: its documents, its terms (ascending hashes), their numbers of places, and the places, ascending within a term."""
    ship_package(texts.sparkSession)
    kind = texts.schema[id_column].dataType.simpleString()
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                words = [alnum_words(text.as_py()) for text in part.column("text")]
                n_words = np.fromiter(map(len, words), np.int64, len(words))
                term = hashed([w for own in words for w in own])
                places = np.argsort(term, kind="stable")
                terms, counts = np.unique(term[places], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().hex]),
                        pa.array([part.column("id").to_pylist()], pa.list_(part.schema.field("id").type)),
                        pa.array([n_words], pa.list_(pa.int64())),
                        pa.array([np.cumsum(n_words) - n_words], pa.list_(pa.int64())),
                        pa.array([terms.astype("<u8").tobytes()], pa.binary()),
                        pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                        pa.array([places.astype("<u4").tobytes()], pa.binary()),
                    ],
                    names=["shard", "ids", "n_words", "begins", "terms", "counts", "postings"],
                )

    return given.mapInArrow(tidy(run), INDEX_SCHEMA.format(id=kind))


class Shard:
    """The posting lists of one index row."""

    def __init__(self, terms: bytes, counts: bytes, postings: bytes, vocabulary: np.ndarray) -> None:
        own, many = np.frombuffer(terms, "<u8"), np.frombuffer(counts, "<u4").astype(np.int64)
        self.places = np.frombuffer(postings, "<u4")
        at = np.searchsorted(own, vocabulary)
        here = np.flatnonzero((at < len(own)) & (own[np.minimum(at, len(own) - 1)] == vocabulary)) if len(own) else _NONE
        # By place in the block's vocabulary: a term's number of places and the end of its list.
        self.counts, self.ends = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        self.counts[here], self.ends[here] = many[at[here]], np.cumsum(many)[at[here]]
        self.flat: np.ndarray | None = None

    def list_of(self, term: int) -> np.ndarray:
        return self.places[self.ends[term] - self.counts[term] : self.ends[term]].astype(np.int64)

    def holders(self) -> np.ndarray:
        """For each place the vocabulary term whose list holds it (one at most), or -1: a look into a list in constant time."""
        if self.flat is None:
            self.flat = np.full(len(self.places), -1, np.int32)
            for term in np.flatnonzero(self.counts):
                self.flat[self.places[self.ends[term] - self.counts[term] : self.ends[term]]] = term
        return self.flat

    def exact(self, queries: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The start places of each window. All windows advance together, list by list from their rarest."""
        found = [_NONE] * len(queries)
        if not len(self.places):
            return found
        flat = self.holders()
        by_length: dict[int, list[int]] = {}
        for i, q in enumerate(queries):
            by_length.setdefault(len(q), []).append(i)
        for length, which in by_length.items():
            terms = np.stack([queries[i] for i in which])
            order = np.argsort(self.counts[terms], axis=1, kind="stable")  # offsets, the rarest term's first
            rarest = np.take_along_axis(terms, order[:, :1], 1)[:, 0]
            many = self.counts[rarest]
            alive = np.repeat(np.arange(len(which)), many)
            first = np.repeat(self.ends[rarest] - many, many)
            step = np.arange(len(alive)) - np.repeat(np.cumsum(many) - many, many)
            starts = self.places[first + step].astype(np.int64) - order[alive, 0]
            for r in range(1, length):
                offset = order[alive, r]
                at = starts + offset
                holds = (starts >= 0) & (at < len(flat))
                holds &= flat[np.where(holds, at, 0)] == terms[alive, offset]
                alive, starts = alive[holds], starts[holds]
            if length == 1:
                alive, starts = alive[starts >= 0], starts[starts >= 0]
            cuts = np.searchsorted(alive, np.arange(len(which) + 1))
            for k, i in enumerate(which):
                if cuts[k + 1] > cuts[k]:
                    found[i] = starts[cuts[k] : cuts[k + 1]]
        return found

    def near(self, query: np.ndarray, slop: int, begins: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every start around which each term is within ``slop`` of its own place, and its document.

        The rarest term may itself be off, so each of its places stands for 2 * slop + 1 starts.
        """
        order = np.argsort(self.counts[query], kind="stable")
        anchors = self.list_of(query[order[0]])
        # Starts may lie before their document, so a start alone doesn't tell it.
        document = np.repeat(np.searchsorted(begins, anchors, side="right") - 1, 2 * slop + 1)
        starts = (anchors[:, None] - order[0] + np.arange(-slop, slop + 1)).ravel()
        if len(starts):
            by = np.lexsort((starts, document))
            starts, document = starts[by], document[by]
            new = np.concatenate([[True], (starts[1:] != starts[:-1]) | (document[1:] != document[:-1])])
            starts, document = starts[new], document[new]
        for offset in order[1:]:
            own, place = self.list_of(query[offset]), starts + offset
            first = np.searchsorted(own, np.maximum(place - slop, begins[document]))
            last = np.searchsorted(own, np.minimum(place + slop, begins[document] + n_words[document] - 1), side="right")
            starts, document = starts[last > first], document[last > first]
        return starts, document


_NONE = np.empty(0, np.int64)


def _shards(batch: pa.RecordBatch, vocabulary: np.ndarray) -> Iterator[tuple[str, list, np.ndarray, np.ndarray, Shard]]:
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i] for name in batch.schema.names}
        n_words, begins = (row[name].values.to_numpy(zero_copy_only=False) for name in ("n_words", "begins"))
        yield row["shard"].as_py(), row["ids"].as_py(), n_words, begins, Shard(*(row[name].as_py() for name in ("terms", "counts", "postings")), vocabulary)


def _in_documents(starts: np.ndarray, length: int, begins: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The document of each start, and which starts have all their words in one document."""
    document = np.searchsorted(begins, starts, side="right") - 1
    inside = (document >= 0) & (starts + length <= begins[np.maximum(document, 0)] + n_words[np.maximum(document, 0)])
    return document, inside


MATCH_SCHEMA = "id {id}, item string, window int, start long, exact boolean"


def matches(index: DataFrame, block: Block, slop: int = 0) -> DataFrame:
    """Every match of the block's windows: document, item, the window's number in the item, start word, and whether it is exact.

    With a ``slop``, also the places around which each of the window's terms is within that many words of its own place.
    """
    spark = index.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(block)  # at most BLOCK_TERMS terms, or one item
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Block = shared.value
        queries, vocabulary = [np.array(q.terms) for q in own.queries], hashed(own.words)
        numbers, seen = [], {}
        for q in own.queries:
            numbers.append(seen.setdefault(q.item, 0))
            seen[q.item] += 1
        for batch in batches:
            for _, ids, n_words, begins, shard in _shards(batch, vocabulary):
                out: list[tuple] = []
                exact = shard.exact(queries)
                for i, (q, starts) in enumerate(zip(own.queries, exact, strict=True)):
                    document, inside = _in_documents(starts, len(q.terms), begins, n_words)
                    found = {(s, d): True for s, d in zip(starts[inside].tolist(), document[inside].tolist(), strict=True)}
                    if slop:
                        near = shard.near(queries[i], slop, begins, n_words)
                        found = {(s, d): False for s, d in zip(*(x.tolist() for x in near), strict=True)} | found
                    out += [(ids[d], own.names[q.item], numbers[i], s - int(begins[d]), whole) for (s, d), whole in found.items()]
                columns = zip(*out, strict=True) if out else [[]] * 5
                types = (batch.schema.field("ids").type.value_type, pa.string(), pa.int32(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["id", "item", "window", "start", "exact"])

    return index.mapInArrow(tidy(run), MATCH_SCHEMA.format(id=kind))


HIT_SCHEMA = "shard string, place int, id {id}, n_words long, hits array<struct<begin: long, end: long>>, items array<string>"


def hits(index: DataFrame, block: Block) -> DataFrame:
    """Per document: number of words, the intervals of hit words, and the items with occurring windows."""
    spark = index.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(block)  # at most BLOCK_TERMS terms, or one item
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Block = shared.value
        queries, vocabulary = [np.array(q.terms) for q in own.queries], hashed(own.words)
        for batch in batches:
            for name, ids, n_words, begins, shard in _shards(batch, vocabulary):
                spans: dict[int, list[tuple[int, int]]] = {}
                items: dict[int, set[str]] = {}
                for q, starts in zip(own.queries, shard.exact(queries), strict=True):
                    document, inside = _in_documents(starts, len(q.terms), begins, n_words)
                    for s, d in zip((starts - begins[document])[inside].tolist(), document[inside].tolist(), strict=True):
                        spans.setdefault(d, []).append((s, s + len(q.terms)))
                        items.setdefault(d, set()).add(own.names[q.item])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(ids), pa.string()),
                        pa.array(range(len(ids)), pa.int32()),
                        pa.array(ids, batch.schema.field("ids").type.value_type),
                        pa.array(n_words, pa.int64()),
                        pa.array([merged(spans.get(d, [])) for d in range(len(ids))], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(items.get(d, ())) for d in range(len(ids))], pa.list_(pa.string())),
                    ],
                    names=["shard", "place", "id", "n_words", "hits", "items"],
                )

    return index.mapInArrow(tidy(run), HIT_SCHEMA.format(id=kind))


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The union of intervals."""
    out: list[dict[str, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"begin": begin, "end": end})
    return out


def decontaminate(
    texts: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", most: int = BLOCK_TERMS
) -> DataFrame:
    """Per document: id, n_words, n_hit, items (of which a window occurs, as text, ascending) and contaminated."""
    index = stored(build_index(texts, id_column, text_column), "index")
    found, count = None, 0
    for block in blocks(items, item_column, item_text, window, most):
        more = hits(index, block)
        found, count = more if found is None else found.unionByName(more), count + 1
    if found is None:
        found = hits(index, Block((), (), ()))
    if count > 1:  # a row for each block and document
        found = found.groupBy("shard", "place").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))
    n_hit = F.aggregate(
        F.sort_array("hits"),
        start,
        lambda state, span: F.struct(F.greatest(state["end"], span["end"]).alias("end"), (state["total"] + F.greatest(F.lit(0).cast("long"), span["end"] - F.greatest(state["end"], span["begin"]))).alias("total")),
        lambda state: state["total"],
    )
    return found.select(F.col("id").alias(id_column), "n_words", n_hit.alias("n_hit"), F.sort_array(F.array_distinct("items")).alias("items")).withColumn("contaminated", F.col("n_hit") > 0)


def document_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Of every document: words, hit words, number and digest of the items found."""
    found = decontaminate(documents, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
