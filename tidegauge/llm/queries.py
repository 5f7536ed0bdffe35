"""One query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    bagminhash,
    boilerplate,
    bpe,
    decontaminate,
    language,
    licences,
    periodic,
    quality,
    repeats,
    tokenfiles,
    topk,
    toxicity,
    whitening,
)
from tidegauge.llm.frames import goes_at_exit, held_out, importable
from tidegauge.workspace import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bagminhash.near_duplicates(docs).select("doc_id", "class_id", "class_size")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    named = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return named.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.remove_repeats(docs, depth=50)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, items)


def _licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def _top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, _tokenizer("word_bpe_49k.json"))
    return coded.select("doc_id", *bpe.digests())


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = work_dir(spark, "tokens")
    parts = tokenfiles.write_token_files(docs, _tokenizer("byte_bpe_50k.json"), folder, end_id=2)
    goes_at_exit(spark, folder)
    read = tokenfiles.read_token_files(parts)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def with_period(doc_id: Column, text: Column) -> Column:
    """``text``, which for a tenth of the documents goes on with a period: with h = crc32 of the
    decimal id, h % 10 = 0, g = h div 10, n words, a = g % n and p = 1 + (n - a) div (3 + g % 8),
    each word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    # Whole periods, cut to the number of words there were.
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(text)


def _periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", with_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    place = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", F.array_max(place)["run"])
    return found.select(
        "doc_id",
        "n_runs",
        *(F.col("longest")[x].alias(x) for x in ("start", "length", "period")),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def _main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = boilerplate.main_text(pages)
    return text.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_bagminhash_dedup": _near_duplicates,
        "op2_quality_ftrl": _quality,
        "op3_language_cnn": _language,
        "op4_suffix_repeats": _repeats,
        "op5_spaced_seeds": _decontaminate,
        "op6_bpe_encoding": _bpe,
        "op7_licence_scan": _licences,
        "op8_top_k": _top_k,
        "op9_toxicity": _toxicity,
        "op10_token_files": _token_files,
        "op11_periodic_runs": _periodic,
        "op12_main_text": _main_text,
        "op13_whitening": _whitened,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_spaced_seeds": decontaminate.contaminated_sql(),
        "op7_licence_scan": licences.scan_sql(),
        "op8_top_k": topk.top_k_sql(k=5, every=50),
    }
