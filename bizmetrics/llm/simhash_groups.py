r"""SimHash near-duplicates: fingerprints within a Hamming distance, found by the generalised pigeonhole principle.

1. **Fingerprints.** A text's 64 bits are the majorities of the bits of its shingles' XXH64 (seed 42), repeats included. Texts with equal fingerprints are one class.
2. **Partitions.** Bits that agree or disagree more often than chance say little about each other's part, so correlated bits are put together: from the counts
   of all pairs of bits over all classes, each part starts with the strongest pair left and takes the bit with the strongest mean correlation to it.
3. **Thresholds.** With m parts and thresholds whose sum is distance - m + 1, two fingerprints within the distance differ by at most its threshold in some part; a
   threshold of -1 leaves a part out. Each fingerprint gets the thresholds that cost it least, by dynamic programming over the parts. The cost of a
   part is its probes and its estimated candidates: counts of all classes in pieces of up to ``PIECE`` bits, folded as if pieces were independent. m is the number of parts
   whose cheapest thresholds cost least in sum over all classes. Estimates decide cost alone, never what is found.
4. **Probe and verify.** Every class is indexed by the value of each part. A class probes each part at all values within its threshold, and the join
   keeps pairs whose whole fingerprints are within the distance. The smaller of two fingerprints finds the larger, so a pair is met from one side.
5. **Hot values.** Where a probe meets a value that more than ``HEAVY`` classes share, its class probes its whole fingerprint's neighbours instead (a single part with the
   whole distance): 2,081 lookups, whatever the data. So a class meets a bounded number of candidates, and links are at most 2,080 for each: no pairs of a group
   are listed, and nothing is left out.

The driver holds 2,081 counts of bits and 25,000 counts of pieces at most, whatever the input; no fingerprint or link reaches it.

Edge cases: null and empty texts and texts without words have fingerprint zero, linked like any other; fewer words than a shingle are one; repeated rows are
copies; rows that share an id are judged each by its text; a null id names no component (which is null where no row has an id); texts are
taken whole, a slice of shingles at a time; an empty table gives no rows; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.common import ship_package, slices, spaced_words, stored
from bizmetrics.llm.components import connected_components

BITS = 64
SHINGLE = 3
DISTANCE = 2
PARTS = (2, 3, 4)
PIECE = 11  # bits
HEAVY = 2048  # classes
#: What looking at a candidate costs, where a probe costs 1.
CANDIDATE = 1 / 16
SLICE_BYTES = 1_000_000
SLICE_SHINGLES = 100_000
SLICE_CLASSES = 1_000

_xxh64 = partial(xxhash.xxh64_intdigest, seed=42)


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words joined by a space, repeats included; fewer words are one run."""
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(size, len(words))
    begins = np.concatenate([[0], ends[: len(words) - width]])
    return [joined[a:b] for a, b in zip(begins.tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[str | None], size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    ones, counts = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[int] = []

    def add_up() -> None:
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        owner = np.array(owners)
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ones[owner[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
        hashes.clear()
        owners.clear()

    for i, text in enumerate(texts):
        runs = shingles(spaced_words(text), size)
        counts[i] = len(runs)
        for begin in range(0, len(runs), SLICE_SHINGLES):
            part = runs[begin : begin + SLICE_SHINGLES]
            hashes.extend(map(_xxh64, part))
            owners.extend([i] * len(part))
            if len(hashes) >= SLICE_SHINGLES:
                add_up()
    if hashes:
        add_up()
    return np.packbits(2 * ones > counts[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprinted(texts: DataFrame, size: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, fp (the fingerprint as a signed number)."""
    ship_package(texts.sparkSession)
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = fingerprints([t.as_py() for t in part.column("text")], size)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, fp long")


def pick(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as a number; the first is its lowest."""
    out = np.zeros(len(fps), np.int64)
    for k, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


@lru_cache
def masks(bits: int, distance: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``distance`` ones."""
    found = [sum(1 << b for b in ones) for k in range(min(distance, bits) + 1) for ones in combinations(range(bits), k)]
    return np.array(found, np.uint64)


def grouped(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """The bits dealt to ``parts``, correlated ones together. ``both[i, j]`` of ``total`` fingerprints have the bits i and j."""
    share = both / max(total, 1)
    alone = np.diag(share)
    spread = np.sqrt(alone * (1 - alone))
    scale = np.outer(spread, spread)
    strength = np.abs(np.divide(share - np.outer(alone, alone), scale, out=np.zeros_like(share), where=scale > 0))
    np.fill_diagonal(strength, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - k)
        part: list[int] = []
        while len(part) < size:
            if part:
                gains = strength[np.ix_(left, part)].sum(axis=1)
                chosen = [left[int(gains.argmax())]]
            else:
                pairs = strength[np.ix_(left, left)]
                first, second = divmod(int(pairs.argmax()), len(left))
                chosen = sorted({left[first], left[second]})[:size]
            part += chosen
            left = [b for b in left if b not in chosen]
        out.append(sorted(part))
    return out


def pieces(part: list[int]) -> list[list[int]]:
    """A part's bits in as few pieces of at most ``PIECE`` bits as it takes."""
    count = -(-len(part) // PIECE)
    return [list(map(int, p)) for p in np.array_split(part, count)]


@dataclass
class Plan:
    """Parts of the bits, and for each part's pieces how many classes lie at which distance from each value."""

    parts: list[list[int]]
    distance: int
    total: int = 0
    near: list[list[np.ndarray]] = field(default_factory=list)

    def count(self, histograms: list[list[np.ndarray]]) -> None:
        """Take the number of classes per value of each piece of each part."""
        self.near = []
        for of_part in histograms:
            rows = []
            for counts in of_part:
                bits = len(counts).bit_length() - 1
                at = np.arange(len(counts), dtype=np.uint64)
                rings = [masks(bits, d)[len(masks(bits, d - 1)) if d else 0 :] for d in range(self.distance + 1)]
                rows.append(np.stack([sum((counts[(at ^ m).astype(np.int64)] for m in ring), np.zeros(len(counts))) for ring in rings], axis=1))
            self.near.append(rows)

    def costs(self, fps: np.ndarray, part: int) -> np.ndarray:
        """For each fingerprint, what thresholds of -1, 0, 1 up to the distance cost in a part."""
        folded = np.zeros((len(fps), self.distance + 1))
        folded[:, 0] = self.total
        for bits, near in zip(pieces(self.parts[part]), self.near[part], strict=True):
            chance = near[pick(fps, bits)] / max(self.total, 1)
            folded = np.stack([sum(folded[:, a] * chance[:, d - a] for a in range(d + 1)) for d in range(self.distance + 1)], axis=1)
        probes = [sum(comb(len(self.parts[part]), k) for k in range(d + 1)) for d in range(self.distance + 1)]
        out = np.zeros((len(fps), self.distance + 2))
        out[:, 1:] = CANDIDATE * np.cumsum(folded, axis=1) + probes
        return out

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per fingerprint the threshold of each part, their sum being distance - parts + 1, that cost least; and that cost.

        With u = threshold + 1 there are distance + 1 units to deal out. ``best[s]`` is the least cost of the parts so far with s of them.
        """
        units = self.distance + 1
        best = np.full((len(fps), units + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for part in range(len(self.parts)):
            cost = self.costs(fps, part)
            choices = np.full((len(fps), units + 1, units + 1), np.inf)  # [row, units in all, units here]
            for s in range(units + 1):
                for u in range(s + 1):
                    choices[:, s, u] = best[:, s - u] + cost[:, u]
            taken.append(choices.argmin(axis=2))
            best = choices.min(axis=2)
        rows, s = np.arange(len(fps)), np.full(len(fps), units)
        out = np.empty((len(fps), len(self.parts)), np.int64)
        for part in reversed(range(len(self.parts))):
            u = taken[part][rows, s]
            out[:, part] = u - 1
            s = s - u
        return out, best[:, units]

    def probes(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, values to look up, fingerprint of each)."""
        chosen, _ = self.thresholds(fps)
        for part, bits in enumerate(self.parts):
            values = pick(fps, bits).view(np.uint64)
            for threshold in range(self.distance + 1):
                rows = chosen[:, part] == threshold
                if rows.any():
                    ball = masks(len(bits), threshold)
                    yield part, (values[rows][:, None] ^ ball[None, :]).ravel(), np.repeat(fps[rows], len(ball))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of a column of signed numbers, in slices."""
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_CLASSES):
            yield batch.column(0).slice(begin, SLICE_CLASSES).to_numpy().view(np.uint64)


def bit_counts(classes: DataFrame) -> tuple[np.ndarray, int]:
    """How many classes have both of two bits, for all pairs of bits; and how many classes there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, total = np.zeros((BITS, BITS)), 0
        for fps in _numbers(batches):
            bits = ((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
            both += bits.T @ bits
            total += len(fps)
        i, j = np.triu_indices(BITS)
        counts = np.concatenate([both[i, j].astype(np.int64), [total]])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(counts)], names=["at", "n"])

    rows = classes.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    i, j = np.triu_indices(BITS)
    counts = np.zeros(len(i) + 1)
    for row in rows:
        counts[row["at"]] = row["n"]
    both = np.zeros((BITS, BITS))
    both[i, j] = both[j, i] = counts[:-1]
    return both, int(counts[-1])


def _counted(classes: DataFrame, plans: list[Plan]) -> None:
    """Give each plan the number of classes per value of each piece: counted in tasks, summed, at most 2^PIECE values a piece."""
    cut = [bits for plan in plans for part in plan.parts for bits in pieces(part)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(bits), np.int64) for bits in cut]
        for fps in _numbers(batches):
            for bits, of_piece in zip(cut, counts, strict=True):
                of_piece += np.bincount(pick(fps, bits), minlength=len(of_piece))
        for k, of_piece in enumerate(counts):
            at = np.flatnonzero(of_piece)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(of_piece[at])], names=["piece", "at", "n"])

    rows = classes.select("fp").mapInArrow(run, "piece int, at int, n long").groupBy("piece", "at").agg(F.sum("n").alias("n")).toPandas()
    counts = [np.zeros(1 << len(bits)) for bits in cut]
    for k, of_piece in rows.groupby("piece"):
        counts[int(k)][of_piece["at"].to_numpy()] = of_piece["n"].to_numpy()
    following = iter(counts)
    for plan in plans:
        plan.count([[next(following) for _ in pieces(part)] for part in plan.parts])


def planned(classes: DataFrame, distance: int = DISTANCE, parts: tuple[int, ...] = PARTS) -> Plan:
    """Of the numbers of parts, the plan whose cheapest thresholds cost least over all classes."""
    both, total = bit_counts(classes)
    plans = [Plan(grouped(both, total, m), distance, total) for m in parts]
    _counted(classes, plans)
    if len(plans) == 1:
        return plans[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = np.zeros(len(plans))
        for fps in _numbers(batches):
            costs += [plan.thresholds(fps)[1].sum() for plan in plans]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(plans)), pa.int32()), pa.array(costs)], names=["at", "cost"])

    costs = classes.select("fp").mapInArrow(run, "at int, cost double").groupBy("at").agg(F.sum("cost").alias("cost")).collect()
    return plans[min(costs, key=lambda r: (r["cost"], r["at"]))["at"] if costs else 0]


def _keys(classes: DataFrame, rows) -> DataFrame:
    """(part, value, fp) of what ``rows`` makes of a slice of fingerprints: parts, values and fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps in _numbers(batches):
            for part, values, owners in rows(fps):
                columns = [pa.array(np.full(len(values), part, np.int32)), pa.array(values.view(np.int64)), pa.array(owners.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "value", "fp"])

    return classes.select("fp").mapInArrow(run, "part int, value long, fp long")


def close_pairs(classes: DataFrame, distance: int = DISTANCE, parts: tuple[int, ...] = PARTS, heavy: int = HEAVY) -> DataFrame:
    """(a, b): all pairs of the different numbers in column ``fp`` that are within the distance, some of them more than once."""
    plan = planned(classes, distance, parts)

    def values(fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for part, bits in enumerate(plan.parts):
            yield part, pick(fps, bits), fps

    def neighbours(fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ball = masks(BITS, distance)
        for begin in range(0, len(fps), 100):
            some = fps[begin : begin + 100]
            yield 0, (some[:, None] ^ ball[None, :]).ravel(), np.repeat(some, len(ball))

    index = stored(_keys(classes, values), "index")
    probes = _keys(classes, plan.probes)
    hot = stored(index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > heavy).select("part", "value"), "hot")
    other = None
    if hot.limit(1).count():
        probes = stored(probes, "probes")
        meets = stored(probes.join(hot, ["part", "value"], "left_semi").select("fp").distinct(), "meets")
        probes = probes.join(meets, "fp", "left_anti")
        other = _keys(meets, neighbours).where("value > fp").select(F.col("fp").alias("a"), F.col("value").alias("b"))
        other = other.join(classes.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")
    found = probes.withColumnRenamed("fp", "a").join(index.withColumnRenamed("fp", "b"), ["part", "value"])
    found = found.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")
    return found.unionByName(other) if other is not None else found


def simhash_groups(texts: DataFrame, size: int = SHINGLE, distance: int = DISTANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, fingerprint (16 hexadecimal digits), component_id: the smallest id reachable by links of at most ``distance`` bits."""
    rows = stored(fingerprinted(texts, size, id_column, text_column), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    links = stored(close_pairs(classes, distance), "links")
    # A component has the name of its smallest fingerprint until its smallest id is known.
    parts = classes.join(connected_components(links).withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    parts = stored(parts, "parts")
    named = parts.groupBy("component").agg(F.min("low").alias("component_id"))
    named = stored(parts.select("fp", "component").join(named, "component").select("fp", "component_id"), "named")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("id").alias(id_column), fingerprint.alias("fingerprint"), "component_id")


def document_simhash(documents: DataFrame) -> DataFrame:
    """Of every document: its fingerprint of three-word shingles, and its component at two bits."""
    return simhash_groups(documents)
