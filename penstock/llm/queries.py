"""Each operator applied to its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.llm import audit, common, covertree, kneser_ney, licences, mixing, packing, periods, quality, sharding, simhash, spans, suffixes, toxicity
from penstock.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(common.documents(spark, sf_dir), max_repeats=2.0)
    return mix.select("row.doc_id", "row.source", "n_tokens", "weight", "epoch", "block", "place")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = spans.cut(common.documents(spark, sf_dir))
    return cut.select(
        "row.doc_id", "n_sentences", "removed", F.md5("cleaned").alias("cleaned_md5")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    parts = packing.pieces(common.documents(spark, sf_dir), *files, with_ids=False)
    return packing.packed(parts)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(common.documents(spark, sf_dir), licences.known_licences(spark))
    return found.select("row.doc_id", "canonical_chars", "digest", "licence")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(common.documents(spark, sf_dir), radius=3)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards, texts included, and reads them back."""
    path = scratch_path(spark, "shards")
    sharding.write(sharding.sharded(common.documents(spark, sf_dir), shards=40), path)
    text = F.col("row.text")
    return spark.read.parquet(path).select(
        "row.doc_id",
        sharding.size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(common.documents(spark, sf_dir), ["doc_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *[f"s.{c}" for c in base], "base_failed", "kept", "quality")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = common.remainder(F.col("doc_id"), 10) == 0
    model = kneser_ney.fit(docs.where(~held_out))
    return kneser_ney.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = common.remainder(F.col("doc_id"), 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = covertree.vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return covertree.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.deduplicated(common.documents(spark, sf_dir))
    return cut.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.found_runs(common.documents(spark, sf_dir), plant=True)


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_packing": op3_packing,
        "op4_licences": op4_licences,
        "op5_simhash": op5_simhash,
        "op6_sharding": op6_sharding,
        "op7_quality": op7_quality,
        "op8_language_model": op8_language_model,
        "op9_toxicity": op9_toxicity,
        "op10_cover_tree": op10_cover_tree,
        "op11_filter_audit": op11_filter_audit,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_licences": licences.scan_sql(),
        "op10_cover_tree": TOP_K_SQL,
        "op11_filter_audit": audit.audit_sql(),
    }
