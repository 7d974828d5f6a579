"""A training corpus from raw documents: toxic documents, near-duplicates and benchmark leaks go, secrets are masked, the rest is tokenized.

Each stage is a function of (spark, docs, sf_dir) over all that its predecessor kept. ``run`` writes each stage's rows as
Parquet in the shared folder and reads them again, so a lost executor costs a stage's tasks at most.

The stages that compare documents judge each text by itself, also where it has no id or shares one with other texts.

Edge cases: null and empty texts stay; of repeated rows one stays; columns may have any name, and all but the last stage return them as they are; no column
keeps an unmasked text but by the input's own choice; ``n_chars`` may be missing; texts may have any length; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizmetrics.llm import decontamination, near_duplicates, secret_scan, sentence_pieces, toxicity
from bizmetrics.llm.common import stored

TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    chain = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    rest = F.struct(F.col("`doc_id`"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text"))).alias("_rest")
    scored = toxicity.score(docs, chain, "doc_id", "text", rest, with_text=True).where(F.col("p_toxic") <= toxicity.THRESHOLD)
    return scored.select(*(F.col("_text").alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns))


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, so that no name of theirs can meet one of a stage's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def _text_key(text: Column) -> Column:
    """What tells texts apart; null for no text."""
    return F.unhex(F.sha2(text.cast("string").cast("binary"), 256))


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Rows packed as ``row``, with a number per document as ``key``, and whether any isn't its id.

    The id is the key, except where it is null or different texts share it; there, it is a hash of both.
    """
    rows = _packed(docs).select("row", F.col("row.doc_id").alias("id"))
    h = F.coalesce(_text_key(F.col("row.text")), F.lit(b""))
    texts = rows.where("id is not null").groupBy("id").agg(F.min(h).alias("low"), F.max(h).alias("high"))
    shared = stored(texts.where("low != high").select(F.col("id").alias("shared")), "shared")
    if not shared.limit(1).count() and not rows.where("id is null").limit(1).count():
        return rows.select("row", F.col("id").cast("long").alias("key")), False
    key = F.when(F.col("id").isNull() | F.col("shared").isNotNull(), F.xxhash64("id", h)).otherwise(F.col("id").cast("long"))
    return rows.join(shared, rows["id"] == shared["shared"], "left").select("row", key.alias("key")), True


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group at five words and 80 percent; of repeated rows, the first by their columns.

    Rows without an id go if their group has a row with one; if not, nothing names the one to keep, so all stay.
    """
    keyed, mixed = _keyed(docs)
    found = near_duplicates.near_duplicates(keyed.select("key", F.col("row.text").alias("text")), shingle=5, percent=80, id_column="key")
    found = stored(found.select("key", "component_id", "kept"), "groups")
    gone = found.where("not kept").select("key").distinct()
    if mixed:
        ids = keyed.select("key", F.col("row.doc_id").alias("id")).distinct()
        members = stored(found.select("key", "component_id").distinct().join(ids, "key"), "members")
        first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("first"))
        gone = members.join(first, "component_id").where("not first.unnamed and key != first.key").select("key").distinct()
    kept = keyed.join(gone, "key", "left_anti")
    repeated = stored(found.groupBy("key").count().where("count > 1").select("key"), "repeated")
    if repeated.limit(1).count():
        several = kept.where("row.doc_id is not null").join(repeated, "key", "left_semi")
        one = several.groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row", "key")
        alone = kept.join(repeated, "key", "left_anti").unionByName(kept.where("row.doc_id is null").join(repeated, "key", "left_semi"))
        kept = alone.unionByName(one)
    return kept.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. The text alone decides, whatever its id."""
    keyed = _packed(docs).withColumn("key", _text_key(F.col("row.text")))
    found = decontamination.decontaminate(keyed.select("key", F.col("row.text").alias("text")), _table(spark, sf_dir, "benchmark"), id_column="key")
    hit = stored(found.where("contaminated").select("key").distinct(), "contaminated")
    return keyed.join(hit, "key", "left_anti").select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked and, where they have ``n_chars``, their number of characters as it is then."""
    masked = secret_scan.redact(_packed(docs).withColumn("text", F.col("row.text")))
    own = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("text") != F.col("row.text"), F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return masked.select(*(column.alias(name) for name, column in own.items()))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document: ids and scores."""
    import public_tokenizers

    return sentence_pieces.sample(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("sentencepiece", tokenize),
]

#: No SQL states a fitted classifier or sampled segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
