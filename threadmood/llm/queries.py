"""The operators of this package as queries; the SQL they are checked against is in sql.py."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmood.llm import byte_bpe, chat, html_text, language_model, merkle, near_copies, neighbours, packing, passages, periodic, quality, set_join, sharding
from threadmood.llm.shared import let

RANK_FILE = "byte_bpe_50k.tiktoken"
TOKENIZER_FILE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("quality", 6).alias("quality"),
    )


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(_table(spark, sf_dir, "documents"), words=2)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_repeats(_table(spark, sf_dir, "documents"), digest=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.lower(F.hex("kept")).alias("kept_sha256"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    ids = byte_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return byte_bpe.decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("tokens").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.read_windows(chat.format_windows(turns.unionByName(extra))))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    row = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.digest_of(*row, small))
    leaves = docs.select("doc_id", "source", merkle.digest_of(*row, F.col("text")).alias("leaf"), tampered.alias("tampered"))
    found = merkle.proofs(merkle.build(leaves, "doc_id", "source", "leaf", "tampered"))
    return found.withColumnsRenamed({"id": "doc_id", "proof": "proof_sha256"})


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """documents, the words of every tenth by crc32 of its id repeating from some word on."""
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("int")

    def repeating(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.floor(1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        repeated = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
        return F.array_join(repeated, " ")

    planted = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.withColumn("text", F.when(planted, let(words, repeating)).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    more_periods = lambda run, best: run["length"] * best["period"] > best["length"] * run["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, run: F.when(more_periods(run, best), run).otherwise(best))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.set_join(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_copies": op2_near_copies,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_html_extraction": op4_html_extraction,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_neighbours": op7_neighbours,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_packing": op9_packing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_set_join": op13_set_join,
}
