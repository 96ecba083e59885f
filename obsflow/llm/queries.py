"""The queries over ``documents``, ``benchmark`` and ``pages``, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm import (
    contamination,
    infill,
    language,
    maxent,
    near_duplicates,
    pages,
    pieces,
    quality,
    repeats,
    secrets,
    signature_trees,
    urls,
    whitening,
)
from obsflow.llm.batches import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


HELD_OUT_TOKENS = f"{fold('doc_id', 7)} = 2"


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = docs.where(f"NOT ({HELD_OUT_TOKENS})")
    counts = maxent.count_tokens(training)
    scored = maxent.score(docs, counts, maxent.train(training, counts))
    return scored.select(
        "doc_id", F.expr(HELD_OUT_TOKENS).alias("held_out"), "n_tokens", "n_known", F.lit(counts.total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


HELD_OUT_LANGUAGE = f"{fold('doc_id', 4)} = 2"


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(f"NOT ({HELD_OUT_LANGUAGE})"))
    return language.predict(docs, model).select("doc_id", F.expr(HELD_OUT_LANGUAGE).alias("held_out"), "lang_pred", "score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_checked(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("repeated"),
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # Null where a deviation does not fit.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.join_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_model,
        op3_decontamination,
        op4_language_id,
        op5_secret_scan,
        op6_sentencepiece,
        op7_url_filter,
        op8_repeats,
        op9_near_duplicates,
        op10_page_text,
        op11_infill,
        op12_whitening,
        op13_jaccard_join,
    )
}
