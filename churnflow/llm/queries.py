"""The registered queries of this subpackage: each operator over its whole table, with the digests asked for."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.llm import (
    binslack, bpe, decontamination, infilling, language, personal, quality, ranked, secret_scan, simhash, substrings, suffixes, topk,
)
from churnflow.llm.common import read_table

#: The key of the pseudonyms; a real run names its own.
PSEUDONYM_KEY = os.environ.get("CHURNFLOW_PSEUDONYM_KEY", "example key")
_SIZE = "aggregate(removed, 0L, (n, s) -> n + s.end - s.start)"


def _count(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), slack=decontamination.SLACK)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontamination.item_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"), decontamination.item_digest(F.col("near_items")).alias("near_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeated_windows(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.expr(_SIZE).alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantized(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = personal.pseudonymized(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    counts = [_count("found", kind) for kind in personal.PATTERNS]
    return done.select("doc_id", *counts, "text", F.sha2("text", 256).alias("text_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeated_strings(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.expr(_SIZE).alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin(*secret_scan.BASE))
    counts = [_count("spans", kind) for kind in secret_scan.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.written(base), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return done.select("doc_id", *bpe.digests())


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binslack.packed(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = infilling.transformed(read_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_substring_dedup, op3_topk_search, op4_simhash, op5_quality, op6_pii, op7_suffix_dedup, op8_secrets,
    op9_language, op10_bpe, op11_packing, op12_infilling, op13_ranked_search,
)}
