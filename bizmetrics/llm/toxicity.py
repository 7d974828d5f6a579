"""Toxicity by a classifier chain: each category's linear model sees the text's words and the probabilities of the categories before it.

**Training.** At most ``SAMPLE`` labelled rows, those with the smallest hash of their id, are joined with their texts; the bound is a parameter and the
only one on data. Words, word beginnings and runs of symbols that at least ``MIN_DOCUMENTS`` of the sample's texts hold (at most ``VOCABULARY``, the most
frequent) become binary features, so no two share one. The chain is trained in order. A later model must not learn from probabilities
that its predecessors fitted on the same rows, so these come out of fold: rows are dealt to ``FOLDS`` folds by hash of the id, and each row's
probability is that of a model which did not see its fold. For scoring, each category has a model of all rows. A category's fold models and
its final one are fitted side by side, a task each; the sample's bound is the task's. Models are L1 logistic regressions; features are not rescaled, so a word
must be both frequent and telling to get a weight.

**Scoring.** All documents pass through the chain where they are, without a shuffle. The weights that are not zero go out with the tasks.

Edge cases: a null or empty text has no words and gets the chain's base rates; rows without a label, id or text are not learned from; repeated labels of
one id count once, with the largest value; a category without both classes in the sample has its constant rate; with no labelled rows all is 0;
an empty table stays empty; columns besides those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizmetrics.llm.common import give_back, ship_package, slices, stored, tidy

SAMPLE = 12_000
FOLDS = 3
VOCABULARY = 1 << 16
MIN_DOCUMENTS = 10
PENALTY = 0.0002
ITERATIONS = 300
TOLERANCE = 1e-4  # of a step in any weight
THRESHOLD = 0.5
#: Lengths of word beginnings that are features too: inflected and compound languages share stems, not words.
BEGINNINGS = (4, 5, 6, 7)
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[!#$%&*|<>]+")
CACHED_WORDS = 100_000
#: Features that a step of the fit handles at a time.
PART = 500_000
SLICE_BYTES = 2_000_000

#: The chain over the columns of ``labels``: category, and the value that stands for it.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))


@dataclass(frozen=True)
class Chain:
    """Per category: bias, weights by feature, and weights of the probabilities before it."""

    categories: tuple[str, ...]
    biases: tuple[float, ...]
    weights: tuple[dict[str, float], ...]
    before: tuple[tuple[float, ...], ...]

    def probabilities(self, sums: Sequence[float]) -> list[float]:
        """The chain's probabilities of a text whose weights have these sums."""
        known: list[float] = []
        for bias, total, before in zip(self.biases, sums, self.before, strict=True):
            known.append(float(_sigmoid(bias + total + sum(w * p for w, p in zip(before, known, strict=False)))))
        return known


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, np.float64)))


def forms(word: str) -> list[str]:
    """A word's features: itself, and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def words_of(text: str | None) -> set[str]:
    """The different words and runs of symbols of a text, in lower case."""
    return set(TOKEN.findall(text.lower())) if text else set()


def _parts(rows: list[np.ndarray], counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows that have features, in parts of about ``PART`` features: their places, features, where each row's begin, and how many it has.

    A step's arrays are those of a part, whatever the sample's size.
    """
    some = np.flatnonzero(counts)
    out = []
    for own in np.split(some, np.searchsorted(np.cumsum(counts[some]), np.arange(PART, counts.sum(), PART))):
        if len(own):
            many = counts[own]
            out.append((own, np.concatenate([rows[i] for i in own]).astype(np.int32), np.cumsum(many) - many, many))
    return out


def fit(rows: list[np.ndarray], extra: np.ndarray, labels: np.ndarray, features: int, penalty: float, iterations: int = ITERATIONS) -> np.ndarray:
    """Weights of the features, the extra columns and the bias, by accelerated proximal steps.

    Each coordinate has a step of its own: for binary rows, the squares of a sum are at most the row's size times the sum of squares.
    """
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    # Dense columns: the extra ones and the bias. A row without features has no slot for a sum, so it gets none.
    dense = np.hstack([extra, np.ones((len(rows), 1))])
    n = len(rows)
    parts = _parts(rows, counts)

    def spread(of_row: np.ndarray) -> np.ndarray:
        """A row's value added to each of its features."""
        total = np.zeros(features)
        for some, flat, _, many in parts:
            total += np.bincount(flat, weights=np.repeat(of_row[some], many), minlength=features)
        return total

    sizes = (counts + dense.shape[1]).astype(np.float64)
    bound = np.concatenate([spread(sizes), (dense**2 * sizes[:, None]).sum(axis=0)])
    step = 1.0 / np.maximum(bound / (4 * n), 1e-12)
    shrink = np.full(features + dense.shape[1], penalty)
    shrink[-1] = 0.0
    weights = look = np.zeros(features + dense.shape[1])
    pace = 1.0
    for _ in range(iterations):
        margin = dense @ look[features:]
        for some, flat, starts, _ in parts:
            margin[some] += np.add.reduceat(look[flat], starts)
        error = _sigmoid(margin) - labels
        slope = np.concatenate([spread(error), dense.T @ error]) / n
        moved = look - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink, 0.0)
        if float(np.abs(new - weights).max()) < TOLERANCE:
            return new
        if float(((look - new) * (new - weights)).sum()) > 0:  # overshot: start the acceleration again
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look = new + (pace - 1) / faster * (new - weights)
        weights, pace = new, faster
    return weights


def training_rows(texts: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, text, a 0/1 column per category and the fold, of at most ``sample`` labelled rows."""
    known = labels.select(F.col(f"`{id_column}`").alias("id"), *((F.col(f"`{column}`") == value).cast("double").alias(f"is_{name}") for name, column, value in categories))
    known = known.dropna().groupBy("id").agg(*(F.max(f"is_{name}").alias(f"is_{name}") for name, *_ in categories))
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).dropna()
    # Labels of other texts take no place in the sample.
    chosen = known.join(given.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)
    joined = given.join(F.broadcast(chosen), "id")  # ``sample`` rows at most
    return joined.dropDuplicates(["id"]).withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int"))


def _vocabulary(rows: DataFrame) -> list[str]:
    """The sample's frequent features; at most ``VOCABULARY`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(list({form for word in words_of(text.as_py()) for form in forms(word)}), pa.string())], names=["feature"])

    counts = rows.select("text").mapInArrow(tidy(run), "feature string").groupBy("feature").count().where(F.col("count") >= MIN_DOCUMENTS)
    return [row["feature"] for row in counts.orderBy(F.desc("count"), "feature").limit(VOCABULARY).collect()]


def _fitter(place: int, name: str, earlier: list[dict[int, np.ndarray]], size: int, penalty: float):
    """What fits the models of a category: a function of one model's training rows."""

    def fit_model(table: pa.Table) -> pa.Table:
        model = table.column("model")[0].as_py()
        lists = table.column("features").combine_chunks()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        features = np.split(pc.list_flatten(lists).to_numpy(zero_copy_only=False), ends[:-1]) if len(lists) else []
        folds = table.column("fold").to_numpy()
        extra = np.zeros((len(features), place))
        for i, own in enumerate(features):  # out of fold: by the models that have not seen the row
            for k in range(place):
                w = earlier[k][int(folds[i])]
                extra[i, k] = _sigmoid(w[own].sum() + w[size : size + k] @ extra[i, :k] + w[-1])
        y = table.column(f"is_{name}").to_numpy()
        weights = fit(features, extra, y, size, penalty) if 0 < y.sum() < len(y) else constant(y.mean(), size + place + 1)
        used = np.flatnonzero(weights)
        del features, extra
        give_back()
        return pa.table({"model": pa.array(np.full(len(used), model), pa.int32()), "feature": pa.array(used, pa.int32()), "weight": pa.array(weights[used])})

    return fit_model


def train(texts: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE, penalty: float = PENALTY, id_column: str = "doc_id", text_column: str = "text") -> Chain:
    """Fit the chain on at most ``sample`` labelled rows."""
    spark = texts.sparkSession
    ship_package(spark)
    names = tuple(name for name, *_ in categories)
    rows = stored(training_rows(texts, labels, categories, sample, id_column, text_column), "sample")
    vocabulary = _vocabulary(rows)
    numbers = spark.sparkContext.broadcast({feature: i for i, feature in enumerate(vocabulary)})  # VOCABULARY entries at most

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = [sorted({known[form] for word in words_of(t.as_py()) for form in forms(word) if form in known}) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("fold"), *(part.column(f"is_{n}") for n in names), pa.array(found, pa.list_(pa.int32()))], names=["fold", *(f"is_{n}" for n in names), "features"])

    schema = "fold int, " + ", ".join(f"is_{n} double" for n in names) + ", features array<int>"
    ready = stored(rows.select("text", "fold", *(f"is_{n}" for n in names)).mapInArrow(tidy(featured), schema), "features")
    size = len(vocabulary)
    fitted: list[dict[int, np.ndarray]] = []  # per category, the models by fold that they have not seen; FOLDS: the final one
    for place, name in enumerate(names):
        wanted = [FOLDS] if place + 1 == len(names) else list(range(FOLDS + 1))
        fit_model = _fitter(place, name, list(fitted), size, penalty)
        models = ready.withColumn("model", F.explode(F.array(*map(F.lit, wanted)))).where("model <> fold")
        found = {m: constant(0.0, size + place + 1) for m in wanted}
        weights = models.groupBy("model").applyInArrow(fit_model, "model int, feature int, weight double").collect()  # VOCABULARY x FOLDS rows at most
        for m in {row["model"] for row in weights}:
            found[m] = np.zeros(size + place + 1)
        for row in weights:
            found[row["model"]][row["feature"]] = row["weight"]
        fitted.append(found)
    numbers.destroy()  # the features are stored
    final = [found[FOLDS] for found in fitted]
    return Chain(
        names,
        tuple(float(w[-1]) for w in final),
        tuple({vocabulary[i]: float(w[i]) for i in np.flatnonzero(w[:size])} for w in final),
        tuple(tuple(map(float, w[size:-1])) for w in final),
    )


def constant(rate: float, size: int) -> np.ndarray:
    """Weights of a model that always says ``rate``."""
    weights = np.zeros(size)
    weights[-1] = np.clip(np.log(max(rate, 1e-300)) - np.log(max(1 - rate, 1e-300)), -700, 700)
    return weights


def score(texts: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text", *kept: Column, with_text: bool = False) -> DataFrame:
    """The id, ``kept`` columns, and ``p_<category>`` of each text; ``_text``, the text itself, if it is wanted."""
    spark = texts.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(chain)  # at most VOCABULARY weights per category
    text = F.col(f"`{text_column}`").cast("string").alias("_text")
    given = texts.select(F.col(f"`{id_column}`").alias(id_column), *kept, text)
    columns = [f for f in given.schema if with_text or f.name != "_text"]
    out = T.StructType(columns + [T.StructField(f"p_{name}", T.DoubleType()) for name in chain.categories])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Chain = shared.value
        every = {f: i for i, f in enumerate(sorted(set().union(*own.weights)))}
        weights = np.array([[w.get(f, 0.0) for w in own.weights] for f in every]).reshape(len(every), len(own.weights))
        cache: dict[str, tuple[int, ...]] = {}
        for part in (part for batch in batches for part in slices(batch, "_text", SLICE_BYTES)):
            if len(cache) > CACHED_WORDS:
                cache.clear()
            rows = []
            for text in part.column("_text"):
                found: set[int] = set()
                for word in words_of(text.as_py()):
                    held = cache.get(word)
                    if held is None:
                        held = cache[word] = tuple(every[form] for form in forms(word) if form in every)
                    if held:
                        found.update(held)
                rows.append(own.probabilities(weights[sorted(found)].sum(axis=0).tolist()))
            columns = np.array(rows).reshape(len(rows), len(own.categories))
            names = [n for n in part.schema.names if with_text or n != "_text"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *(pa.array(c) for c in columns.T.copy())], names=[*names, *(f"p_{n}" for n in own.categories)])
        cache.clear()

    return given.mapInArrow(tidy(run), out)


def document_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's probabilities, and whether it is toxic."""
    scored = score(documents, train(documents, labels))
    return scored.select("doc_id", (F.col("p_toxic") > THRESHOLD).alias("toxic"), *(F.round(f"p_{name}", 6).alias(f"p_{name}") for name, *_ in CATEGORIES))
