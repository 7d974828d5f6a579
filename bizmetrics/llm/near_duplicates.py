r"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full sets.

1. **Signatures.** A text's set is that of its runs of ``shingle`` words. Its signature has 5 * m symbols, each 16 bits of a minimum hash; two symbols
   are equal with a probability of the sets' similarity. Texts with equal sets are one class, which goes on as its smallest id.
2. **Multi-index join.** A signature is cut into m chunks of five symbols. Two signatures at a distance of at most 2 m - 1 have, by the pigeonhole
   principle, a chunk with at most one error. So each chunk is indexed five times, with each symbol left out, and such pairs share a key:
   all of them, for sure. m is the smallest number with which sets of just the wanted similarity exceed that distance with a probability under ``MISS``.
3. **Buckets.** Keys of a single class are dropped; keys with the same classes are one bucket. In a bucket the
   distances of signatures are computed, and what is emitted is not every pair but a forest with the same components. Buckets above ``SIGNATURE_BLOCK`` rows are
   cut into blocks, and every pair of blocks is a group of its own, so that the hottest bucket spreads over many tasks and no pair is left out.
4. **Confirmation.** Pairs within the distance lie in one component of these forests. A component of up to ``SET_BLOCK`` classes is one group in which all
   pairs are compared on their full sets. In a larger one every class is first compared with one of them, in rounds, which joins near copies at one
   comparison each; then only blocks of different parts are compared in full, in pairs. So a group of n near copies is exchanged some two times, and
   n / ``SET_BLOCK`` times only where its members are near each other's signatures and yet not similar. The links' components are the result.

Nothing is capped, no bucket or candidate is left out, and no group, component or fingerprint reaches the driver. Every step is written to the shared folder.

Words are ``[^\x20\x09-\x0D]+`` of texts with A-Z in lower case; fewer than ``shingle`` words are one shingle.

Edge cases: null and empty texts have an empty set and are linked with nothing; repeated rows are copies of each other; rows that share an
id are one document; a null id names no component, and its row is kept if no other row of its class has an id; an empty table gives no rows; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizmetrics.llm.common import hashed, mix64, ship_package, slices, spaced_words, stored, tidy
from bizmetrics.llm.components import by_group, connected_components, forest, in_blocks

SYMBOLS = 5  # in a chunk
MISS = 1e-6
SIGNATURE_BLOCK = 2048  # rows of a few hundred bytes
SET_BLOCK = 256  # rows of whole sets
PIVOT_CHUNK = 64  # rows of whole sets that are compared with one
SLICE_BYTES = 2_000_000


@lru_cache
def chunks(percent: int, miss: float = MISS) -> int:
    """How many chunks it takes that sets of this similarity stay within the distance."""
    wrong, m = 1 - percent / 100, 1
    while sum(comb(SYMBOLS * m, k) * wrong**k * (1 - wrong) ** (SYMBOLS * m - k) for k in range(2 * m, SYMBOLS * m + 1)) > miss:
        m += 1
    return m


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The ascending 64-bit hashes of a text's shingles."""
    if not words:
        return np.empty(0, np.uint64)
    codes = hashed(words)
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - width + 1 + k])
    return np.unique(total)


@lru_cache
def _hashes(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:count], seeds[count:] | np.uint64(1)


def signatures(sets: list[np.ndarray], symbols: int) -> np.ndarray:
    """A row of 16-bit symbols for each (not empty) set."""
    out = np.empty((symbols, len(sets)), np.uint16)
    if not sets:
        return out.T
    values = np.concatenate(sets)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    begins, held = np.cumsum(lengths) - lengths, np.empty_like(values)
    for k, (flip, factor) in enumerate(zip(*_hashes(symbols), strict=True)):
        np.bitwise_xor(values, flip, out=held)
        np.multiply(held, factor, out=held)
        out[k] = mix64(np.minimum.reduceat(held, begins)) >> np.uint64(48)
    return np.ascontiguousarray(out.T)


def index_keys(signature: np.ndarray) -> np.ndarray:
    """For each signature, the keys of its chunks with each symbol left out."""
    rows = len(signature)
    parts = signature.reshape(rows, -1, SYMBOLS).astype(np.uint64)
    keys = np.empty((rows, parts.shape[1], SYMBOLS), np.uint64)
    for gone in range(SYMBOLS):
        four = np.delete(parts, gone, axis=2)
        packed = four[:, :, 0] << np.uint64(48) | four[:, :, 1] << np.uint64(32) | four[:, :, 2] << np.uint64(16) | four[:, :, 3]
        place = mix64(np.arange(parts.shape[1], dtype=np.uint64) * np.uint64(SYMBOLS) + np.uint64(gone + 1))
        keys[:, :, gone] = mix64(packed ^ place)
    return keys.reshape(rows, -1)


def signed(texts: DataFrame, shingle: int, percent: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n (size of the set), digest of the set, signature; the last two are null for an empty set."""
    ship_package(texts.sparkSession)
    given = texts.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    symbols = SYMBOLS * chunks(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = [shingle_set(spaced_words(t.as_py()), shingle) for t in part.column("text")]
                rows = iter(signatures([s for s in sets if len(s)], symbols))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(list(map(len, sets)), pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["id", "n", "digest", "signature"],
                )

    return given.mapInArrow(tidy(run), "id long, n long, digest binary, signature binary")


def _keys(classes: DataFrame, symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2_000):
                part = batch.slice(begin, 2_000)
                keys = index_keys(np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, symbols))
                nodes = np.repeat(part.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], names=["key", "node"])

    return classes.select("node", "signature").mapInArrow(tidy(run), "key long, node long")


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _across(table: pa.Table, near: np.ndarray) -> Iterable[tuple[int, int]]:
    """A forest of ``near``. Of a pair of blocks, only what joins them: what is joined in either block is known from its pair with itself."""
    one, two, own = (table.column(c).to_numpy() for c in ("one", "two", "own"))
    nodes = table.column("node").to_numpy()
    if len(one) and one[0] != two[0]:
        other = own[:, None] != own[None, :]
        found = forest(near & other, near & ~other)
    else:
        found = forest(near)
    return [(int(nodes[i]), int(nodes[j])) for i, j in found]


def close_signatures(classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of classes within the distance."""
    m = chunks(percent)
    symbols, distance = SYMBOLS * m, 2 * m - 1
    # A class has very many keys, so the classes are dealt to as many tasks as their keys will be: what a task sums up stays small.
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _keys(classes.select("node", "signature").repartition(tasks, "node"), symbols)
    buckets = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"))
    # Keys with the same members are one bucket: size, ends and the sum of hashes tell.
    buckets = stored(buckets.where("size > 1").groupBy("size", "low", "high", "who").agg(F.min("key").alias("key")), "buckets")
    pairs = buckets.where("size = 2")
    pairs = pairs.select("key", F.explode(F.array("low", "high")).alias("node"), F.lit(2).cast("long").alias("size"))
    # Both sides by key at any size: what is exchanged then grows in proportion to the classes, and the adaptive join splits hot keys.
    larger = keys.join(buckets.where("size > 2").select("key", "size").hint("merge"), "key").select("key", "node", "size")
    members = in_blocks(pairs.unionByName(larger), "size", "node", SIGNATURE_BLOCK).join(classes.select("node", "n", "signature"), "node")

    def near(table: pa.Table) -> Iterable[tuple[int, int]]:
        rows = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, symbols)
        sizes = table.column("n").to_numpy()
        found = np.zeros((len(rows), len(rows)), bool)
        for i in range(len(rows) - 1):
            ok = (rows[i + 1 :] != rows[i]).sum(axis=1) <= distance
            # Sets of which one is too small for the other cannot be similar enough.
            ok &= 100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :])
            found[i, i + 1 :] = ok
        return _across(table, found | found.T)

    return by_group(members, ["key", "one", "two"], near, EDGES)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1
    owners, group = owners[shared], group[shared]
    if len(group):
        group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
    total = np.zeros((len(sets), len(sets)), np.float64)
    for first in range(0, int(group[-1]) + 1 if len(group) else 0, 4096):
        begin, end = np.searchsorted(group, [first, first + 4096])
        held = np.zeros((len(sets), 4096), np.float32)  # counts up to 4096 are exact
        held[owners[begin:end], group[begin:end] - first] = 1
        total += held @ held.T
    return total.astype(np.int64)


def _sets(texts: DataFrame, sized: DataFrame, shingle: int, id_column: str, text_column: str) -> DataFrame:
    """``sized`` (a column ``node`` and others) with the set of their texts, once per text of a node."""
    given = texts.select(F.col(f"`{id_column}`").cast("long").alias("node"), F.col(f"`{text_column}`").cast("string").alias("text"))
    names = [c for c in sized.columns if c != "node"]
    joined = given.join(sized, "node").select("node", *names, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = [shingle_set(spaced_words(t.as_py()), shingle).tobytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", *names)), pa.array(sets, pa.binary())], names=["node", *names, "set"])

    return joined.mapInArrow(tidy(run), T.StructType([*joined.drop("text").schema.fields, T.StructField("set", T.BinaryType())]))


def _similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    common = intersections(sets)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(near, False)
    return near


def joined_to_pivots(sets: DataFrame, members: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(node, component, part) of the ``members`` (node, component, size) of large components, and the links that make the parts.

    In each round every open member of a component is compared with one of them, its pivot, and those that it is linked to make a part. A component
    goes on for as long as a round at least halves its open members and they are more than a block, so all rounds compare at most twice its members.
    """
    settled: list[DataFrame] = []
    found: list[DataFrame] = []

    def pairs(table: pa.Table) -> Iterable[tuple[int, int]]:
        nodes, pivot = table.column("node").to_numpy(), table.column("pivot").to_numpy()
        own = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        for head in np.flatnonzero(nodes == pivot):
            for i in np.flatnonzero(nodes != pivot):
                common = len(np.intersect1d(own[head], own[i], assume_unique=True))
                if 100 * common >= percent * (len(own[head]) + len(own[i]) - common):
                    yield int(pivot[i]), int(nodes[i])

    active = members
    while not active.isEmpty():
        pivots = active.groupBy("component").agg(F.min("node").alias("pivot"))
        star = stored(active.join(pivots, "component").withColumn("chunks", F.ceil(F.col("size") / F.lit(float(PIVOT_CHUNK))).cast("int")), "star")
        mates = star.where("node != pivot").select("node", "pivot", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"))
        heads = star.where("node = pivot").select("node", "pivot", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        linked = stored(by_group(sets.join(mates.unionByName(heads), "node"), ["pivot", "chunk"], pairs, EDGES).distinct(), "linked")
        found.append(linked)
        after = star.join(linked.select(F.col("b").alias("node"), F.lit(True).alias("linked")), "node", "left")
        after = stored(after.withColumn("open", F.col("linked").isNull() & (F.col("node") != F.col("pivot"))), "after")
        left = after.where("open").groupBy("component").agg(F.count("*").alias("left"))
        rest = stored(after.where("open").join(left, "component"), "rest")
        settled.append(after.where("not open").select("node", "component", F.col("pivot").alias("part")))
        going = (F.col("left") > SET_BLOCK) & (2 * F.col("left") <= F.col("size"))
        settled.append(rest.where(~going).select("node", "component", F.col("node").alias("part")))
        active = rest.where(going).select("node", "component", F.col("left").alias("size"))
    return reduce(DataFrame.unionByName, settled), found


def between_parts(parts: DataFrame) -> DataFrame:
    """(node, component, own, one, two): each member once for each pair of blocks in which it may meet another part.

    Parts above a block's rows have blocks of their own; the smaller ones of a component share blocks, whatever their number.
    """
    sizes = parts.groupBy("component", "part").agg(F.count("*").alias("n"))
    cells = sizes.withColumn("cell", F.when(F.col("n") > SET_BLOCK, F.col("part")))
    counts = cells.groupBy("component", "cell").agg(F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / F.lit(float(SET_BLOCK))).cast("int"))
    whole = Window.partitionBy("component")
    numbered = counts.withColumn("total", F.sum("blocks").over(whole).cast("int")).withColumn("begin", (F.sum("blocks").over(whole.orderBy("cell")) - F.col("blocks")).cast("int"))
    placed = cells.select("component", "part", "cell").join(numbered.select(F.col("component").alias("c"), F.col("cell").alias("k"), "total", "begin", "blocks"), F.expr("component = c and cell <=> k"))
    # A component of one large part has nothing left to compare.
    placed = stored(placed.where("cell is null or blocks < total").select("component", "part", "cell", "total", "begin", "blocks"), "placed")
    rows = parts.join(placed, ["component", "part"]).withColumn("own", (F.col("begin") + F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int"))
    apart = F.filter(
        F.sequence(F.lit(0), F.col("total") - 1),
        lambda other: F.col("cell").isNull() | (other < F.col("begin")) | (other >= F.col("begin") + F.col("blocks")),
    )
    return rows.withColumn("other", F.explode(apart)).select("node", "component", "own", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))


def links(texts: DataFrame, candidates: DataFrame, shingle: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs with the wanted similarity, within the candidates' components."""
    coarse = stored(connected_components(candidates), "coarse")
    sized = stored(coarse.join(coarse.groupBy("component").agg(F.count("*").alias("size")), "component"), "sized")
    sets = stored(_sets(texts, sized, shingle, id_column, text_column), "sets")
    blocks = sets.where(F.col("size") <= SET_BLOCK).select("node", "set", "component", *(F.lit(0).alias(c) for c in ("own", "one", "two")))
    found: list[DataFrame] = []
    large = sized.where(F.col("size") > SET_BLOCK).select("node", "component", "size")
    if not large.isEmpty():
        larger = sets.where(F.col("size") > SET_BLOCK).select("node", "set")
        parts, found = joined_to_pivots(larger, large, percent)
        blocks = blocks.unionByName(larger.join(between_parts(parts), "node"))

    def similar(table: pa.Table) -> Iterable[tuple[int, int]]:
        own = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        return _across(table, _similar(own, percent)) if len(own) > 1 else []

    return reduce(DataFrame.unionByName, found, by_group(blocks, ["component", "one", "two"], similar, EDGES))


def near_duplicates(texts: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id reachable by links of at least ``percent`` similarity), kept (it is that id)."""
    rows = stored(signed(texts, shingle, percent, id_column, text_column), "signed")
    some = rows.where("digest is not null and id is not null")
    classes = stored(some.groupBy("digest").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("signature").alias("signature")), "classes")
    close = stored(close_signatures(classes, percent), "close")
    found = stored(links(texts, close, shingle, percent, id_column, text_column), "links")
    components = connected_components(found)
    # A row per class; both sides of the last join are tables, so that the adaptive join can split a class of very many copies.
    named = stored(classes.select("digest", "node").join(components, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id")), "named")
    joined = rows.select("id", "n", "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), component.isNull()).alias("kept"))


def document_groups(documents: DataFrame) -> DataFrame:
    """Of every document: its set's size, its component at three words and 85 percent, and whether it stands for it."""
    return near_duplicates(documents, shingle=3, percent=85)
