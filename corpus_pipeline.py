"""A corpus pipeline: toxic documents go, one document of each class of near copies stays, byte
strings that an earlier document has are cut, documents with benchmark passages go, and the
rest is encoded.

Each stage takes all that the one before it kept and (but for the last) returns the columns it
got, whatever their names. Nothing else goes: documents without text or without words pass all
stages, and rows that repeat a doc_id, or have none, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bagminhash, bpe, decontaminate, repeats, toxicity
from tidegauge.llm.frames import free_name, importable, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: As many numbers of contaminated documents are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic passage scores less than the threshold."""
    importable(spark)
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    names = [free_name(docs.columns, x) for x in ("score", "predicted")]
    scored = toxicity.score(docs, model, names=names)
    return scored.where(F.col(names[1]) == 0).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    importable(spark)
    names = [free_name(docs.columns, x) for x in ("class_id", "class_size", "is_first")]
    return bagminhash.near_duplicates(docs, names=names).where(F.col(names[2])).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters that lie wholly in repeated byte strings."""
    importable(spark)
    cut = repeats.remove_repeats(docs.select("doc_id", "text", F.struct(*docs.columns).alias("given")))
    fresh = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    # A text that was NULL stays NULL.
    fresh["text"] = F.when(F.col("given.text").isNotNull(), fresh["text"])
    if "n_chars" in fresh:
        fresh["n_chars"] = F.when(F.col("given.text").isNotNull(), fresh["n_chars"]).otherwise(F.col("given.n_chars"))
    return cut.select(*(fresh.get(c, F.col("given").getField(c)).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows go by a number that is stored with them,
    so one without an id, or with another's, goes by its own text alone."""
    row = free_name(docs.columns, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = decontaminate.contaminated(numbered, _table(spark, sf_dir, "benchmark"), doc_id=row)
    found = stored(found.select(F.col("doc_id").alias(row)).distinct(), "contaminated")
    few = found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return numbered.join(F.broadcast(found) if few else found, row, "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens, and digests of its ids and of what they decode to."""
    import public_tokenizers

    importable(spark)
    coded = bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", *bpe.digests())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Fitted classifiers and signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written to the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
