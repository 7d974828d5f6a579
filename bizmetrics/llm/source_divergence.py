r"""How far the sources of a language differ in the words they use, from exact term frequencies.

1. **Tokenizer.** ``bytes.translate`` with one table lowers A-Z and blanks every other ASCII byte that is no letter; ``bytes.split`` gives the terms
   ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, and a ``Counter`` per document how often it has each. A task sums these up per (lang, source) and hands on a
   sparse row per term: occurrences, and documents that have it. It does so whenever it holds ``HELD`` of them, so its memory is bounded.
2. **Vocabulary.** The terms in at least ``min_documents`` documents of a language are its V kept terms. N is a group's sum of their counts.
3. **Probabilities** are whole numbers, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), in decimals and then longs, so nothing is rounded. Two of them
   diverge by f = floor((p - q)^2 / (p + q)).
4. **Pairs of sources.** The sum of f over all kept terms is never made of sources times terms. A term that a source lacks has the source's p of count 0, so
   the sum is V f(p0, q0), plus for each source what its own terms change against the other's p0, which depends on their counts alone (a row per different
   count), plus a correction for the terms that both have. Only the last takes a row per term and pair of its sources: it meets rows by (lang, term), at most one per source
   of the language, and sums them up before they are exchanged.
5. **Terms of a source.** Those that it has more often than its language, the ``top`` of largest f; Spark cuts each task's rows to that many before it exchanges them.

A hot source or word is combined in the tasks and again before each exchange: what is exchanged is a row per task, source and different term.
There are no broadcast hints and nothing reaches the driver.

Edge cases: null text, lang and source are ''; a source without terms still has its pairs; a language without kept terms has pairs of value 0 and no
terms; ties go by the item's bytes; repeated rows count each; texts are taken whole, one at a time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizmetrics.llm.common import ship_package, stored, utf8

MIN_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms that a task holds before it hands them on.
HELD = 300_000

#: A-Z to a-z, other ASCII that is no letter to a space, bytes of other characters as they are.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in bytes(range(256)).lower())

_COUNTS = "lang string, source string, term string, count long, documents long"


def document_terms(text: str | None) -> Counter[bytes]:
    """How often a text has each of its terms."""
    return Counter(utf8(text).translate(TERM_BYTES).split())


class _Held:
    """The sums of a task, by (lang, source)."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter[bytes]] = {}
        self.documents: dict[tuple[str, str], Counter[bytes]] = {}
        self.size = 0

    def add(self, group: tuple[str, str], terms: Counter[bytes]) -> None:
        counts, documents = self.counts.setdefault(group, Counter()), self.documents.setdefault(group, Counter())
        before = len(counts)
        counts.update(terms)
        documents.update(terms.keys())
        self.size += len(counts) - before

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in self.counts.items():
            documents = self.documents[lang, source]
            columns = [
                pa.repeat(lang, len(counts)),
                pa.repeat(source, len(counts)),
                pa.array(list(counts), pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array([documents[t] for t in counts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "documents"])


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, count (occurrences), documents (that have it): a row per different term of a group."""
    ship_package(documents.sparkSession)

    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)

    given = documents.select(filled(lang), filled(source), filled(text)).toDF("lang", "source", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            for group_lang, group_source, body in zip(*batch.columns, strict=True):
                held.add((group_lang.as_py(), group_source.as_py()), document_terms(body.as_py()))
                if held.size >= HELD:
                    yield from held.batches()
                    held = _Held()
        yield from held.batches()

    counted = given.mapInArrow(run, _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term with ``count`` occurrences among ``total``, where ``kept`` terms are kept."""
    wide = "decimal(38,0)"
    top = (count + F.lit(2)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top.cast(wide), (total + F.lit(2) * kept).cast(wide))


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item (the other source or the term), value, rank."""
    counts = stored(term_counts(documents, text, lang, source), "counts")
    words = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("documents").alias("documents"))
    words = stored(words.where(F.col("documents") >= min_documents).select("lang", "term", "lang_count"), "words")
    langs = words.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_n"))
    kept = counts.join(words, ["lang", "term"]).select("lang", "source", "term", "count", "lang_count")

    # Every group that occurs, also without a kept term: its N and its p of a term that it lacks.
    names = documents.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
    missing = F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("n"), F.col("v"))).otherwise(F.lit(0))
    groups = stored(groups.withColumn("p0", missing), "groups")

    cells = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v")))
    cells = stored(cells.select("lang", "source", "term", "p", "p0", _share(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q")), "cells")
    found = _pairs(groups, cells).unionByName(_terms(cells, top))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """For each source every other one of its language, by falling divergence."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    f = _divergence
    base = groups.join(other, "lang").where("source != item")
    base = base.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * f(F.col("p0"), F.col("q0"))).otherwise(F.lit(0)).alias("value"))

    # What the terms of one source change where the other has none of them; those of the same p change the same.
    own = cells.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")).join(other, "lang").where("source != item")
    own = own.groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (f(F.col("p"), F.col("q0")) - f(F.col("p0"), F.col("q0")))).alias("value"))

    # And what that misses for the terms that both have.
    left = cells.select("lang", "term", "source", "p", "p0")
    right = cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    p, p0, q, q0 = map(F.col, ("p", "p0", "q", "q0"))
    both = left.join(right, ["lang", "term"]).where("source < item")
    both = both.groupBy("lang", "source", "item").agg(F.sum(f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)).alias("value"))

    def turned(rows: DataFrame) -> DataFrame:
        return rows.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    # f has no direction, so each part counts for both ends.
    parts = base.unionByName(own).unionByName(turned(own)).unionByName(both).unionByName(turned(both))
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return summed.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))


def _terms(cells: DataFrame, top: int) -> DataFrame:
    """The terms that a source has more often than its language, by falling divergence."""
    rows = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))


def source_audit(documents: DataFrame) -> DataFrame:
    """Of every source of a language: its divergence from each other source, and the terms that set it apart."""
    return divergence(documents)
