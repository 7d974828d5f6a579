"""Connected components by rounds of joins, and the distribution of groups over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from bizmetrics.llm.common import stored, tidy


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns ``a`` and ``b``, whole numbers); a component is named by its smallest node.

    Rounds of the large-star and small-star steps: first every node's larger neighbours, then its smaller ones, are linked to its smallest
    neighbour. Links only ever become a star per component; the rounds are logarithmic in its size. Minima are combined before
    they are exchanged, and each round's links are written to the shared folder, so that neither lineage nor a hub is gathered anywhere.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    previous = None
    while True:
        # Large star: neighbours above a node go to the smallest of the node and its neighbours.
        both = edges.union(edges.select("b", "a"))
        lowest = stored(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")), "lowest")
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a != b").distinct(), "large")
        # Small star: a node and its neighbours below it go to the smallest of these.
        lowest = stored(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(lowest.select("a", F.col("low").alias("b")))
        edges = stored(small.where("a != b").distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("hash")).first()
        if previous == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        previous = state


def by_group(rows: DataFrame, keys: list[str], function: Callable[[pa.Table], Iterable[tuple]], schema: pa.Schema) -> DataFrame:
    """The rows that ``function`` makes of each group; many groups in a task, one at a time in memory. Groups must be of bounded size.

    Rows are exchanged by the keys and sorted, and a task walks over its groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key: tuple = ()
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for begin, end in zip(starts, starts[1:], strict=False):
                key = tuple(c[begin] for c in columns)
                if held and key != held_key:
                    out.extend(function(pa.Table.from_batches(held).combine_chunks()))
                    held = []
                    if len(out) >= 10_000:
                        yield made()
                        out.clear()
                held_key = key
                held.append(batch.slice(begin, end - begin))
        if held:
            out.extend(function(pa.Table.from_batches(held).combine_chunks()))
        if out:
            yield made()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), from_arrow_schema(schema))


def in_blocks(rows: DataFrame, size: str, by: str, block: int) -> DataFrame:
    """Groups of more than ``block`` rows cut into blocks: each row once for each pair of blocks that its own is in.

    Adds ``own`` (its block), ``one`` and ``two`` (the pair, ``one <= two``). ``size`` names the column with a group's number of rows.
    """
    blocks = F.ceil(F.col(size) / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64(by), F.greatest(blocks, F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least("own", other).alias("one"), F.greatest("own", other).alias("two")))
    return rows.withColumn("own", own).withColumn("pair", F.explode(pairs)).select("*", "pair.one", "pair.two").drop("pair")


def forest(near: np.ndarray, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """The fewest edges of the symmetric matrix ``near`` that join the same rows as it does.

    With ``known``, rows that this matrix joins count as joined already.
    """
    label = np.arange(len(near))
    edges: list[tuple[int, int]] = []
    for matrix, emitted in ((known, []), (near, edges)):
        for i in range(len(near) if matrix is not None else 0):
            mates = np.flatnonzero(matrix[i])
            for other, at in zip(*np.unique(label[mates], return_index=True), strict=True):
                if other != label[i]:
                    emitted.append((i, int(mates[at])))
                    label[label == other] = label[i]
    return edges
