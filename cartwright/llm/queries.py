"""The numbered operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    alignment,
    chat,
    curriculum,
    decontaminate,
    fingerprints,
    language,
    line_dedup,
    ngram_join,
    packing,
    periodicity,
    quality,
    token_counts,
    url_filter,
)
from cartwright.llm.common import fold

#: Action, host, path of each rule.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
GOOD_FROM = 0.3
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Learned from the labels outside the held-out fold."""
    return quality.fit(documents, labels.filter(fold(F.col("doc_id"), 5) != 0))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model(documents, table(spark, folder, "labels"))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = quality.with_score(documents, model)
    predicted = (F.col("score") >= GOOD_FROM).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"), n=4, num=85, den=100)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = fingerprints.beside_next(
        documents, ["text", "_print"], lambda df: fingerprints.with_fingerprint(df, "text", "_print")
    )
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.char_length("text") - half), F.left("next_text", half))
    both = fingerprints.with_fingerprint(both.withColumn("_edited", edited), "_edited", "_edited_print")
    both = fingerprints.with_likeness(both, "_print", "_edited_print", "near_edited")
    both = fingerprints.with_likeness(both, "_print", "next__print", "near_next")
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("_print")).alias("fingerprint"),
        fingerprints.as_text(F.col("_edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(documents, token_counts.read_vocabulary())
    return counted.select("doc_id", "n_words", "n_tokens")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.fit(documents.filter(~held_out))
    judged = language.with_language(documents.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    matched = decontaminate.with_matches(documents, table(spark, folder, "benchmark"))
    return matched.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    values = ", ".join(f"('{action}', '{host}', '{path}')" for action, host, path in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(action, host, path)")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_align(spark: SparkSession, folder: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    linked = alignment.linked_pairs(documents, f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model")
    return linked.withColumn("doc_id", F.col("doc_id").cast("long"))


def with_repetition(documents: DataFrame) -> DataFrame:
    """In a tenth of the documents the words from some place on become a repetition."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(periodicity.words_of(F.col("text"))).cast("long")
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8))
    edited = periodicity.repeated_from(F.col("text"), start.cast("int"), period.cast("int"))
    return documents.withColumn("text", F.when((h % 10 == 0) & (n > 0), edited).otherwise(F.col("text")))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = with_repetition(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodicity.with_runs(documents)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("b")))
    )
    return found.withColumn("_longest", longest).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest")["a"]).alias("start"),
        F.col("_longest")["length"].alias("length"),
        (-F.col("_longest")["b"]).alias("period"),
        F.floor(1000 * F.col("_longest")["length"] / -F.col("_longest")["b"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_pack(spark: SparkSession, folder: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(documents, f"{tokenizers}/word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_ngram_join,
        op3_line_dedup,
        op4_fingerprints,
        op5_chat,
        op6_token_counts,
        op7_language,
        op8_decontaminate,
        op9_mix,
        op10_url_filter,
        op11_align,
        op12_runs,
        op13_pack,
    )
}
