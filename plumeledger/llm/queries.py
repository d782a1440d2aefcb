"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    divergence,
    embedding_dedup,
    html_extraction,
    language_id,
    minhash_dedup,
    packing,
    pii,
    quality,
    spelling_variants,
    substring_dedup,
    token_counts,
    tool_calls,
)
from .oracle import ORACLE as ORACLE
from .shared import Scratch, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, nameless=True
    )
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, capacity=2048, end_id=1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per line of every document; a token across a line break goes to the line that
    holds most of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count(docs, BYTE_RANKS, public_tokenizers.PATTERN, rule="most")
    return counted.select(
        "doc_id", "section", "start", "end", F.col("n_tokens").cast("long").alias("n_tokens"), "n_crossing"
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = Scratch(spark, "pii").stage(pii.annotate(docs).drop("text"))
    found = pii.spans(found, pii.train(found))
    of_kind = lambda k: F.size(F.filter("__pii_base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(pii.BASE)],
        F.sha2(pii.as_text(F.col("__pii_base")), 256).alias("base_sha256"),
        pii.as_text(F.col("__pii_spans")).alias("spans"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda column: quality.fold(column, 3) == 1
    found = language_id.predict(docs, language_id.train(docs, held_out))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda column: quality.fold(column, 4) == 2
    net = quality.train(docs, table(spark, sf_dir, "labels"), "quality", held_out)
    found = quality.score(docs.select("doc_id", "text"), net)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.7).cast("int").alias("predicted"),
    )


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tool_calls.format_turns(table(spark, sf_dir, "conversations"), tool_calls.TURN_SCHEMAS)
    return found.select(
        "conv_id", "call_id", "turn", "name", "status", "rank", "missing",
        F.array_join("errors", ",").alias("errors"), "message",
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=3, top=200)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"), every=31)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cover_tree": op1_cover_tree,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_html_extraction": op5_html_extraction,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_quality": op9_quality,
    "op10_tool_calls": op10_tool_calls,
    "op11_source_divergence": op11_source_divergence,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
