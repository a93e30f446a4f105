"""The operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import (
    byte_bpe,
    chat_format,
    ego_join,
    lattice_lm,
    mixing,
    pair_rank,
    rule_lists,
    simhash,
    spelling,
    token_align,
    token_files,
    toxicity,
    url_rules,
)
from .common import crc_mod, read

Query = Callable[[SparkSession, str], DataFrame]

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ACCEPT = 0.3
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block"))
EXTRA_CONVERSATION = (-7, ("user", "assistant"), r"\### Assistant: </turn> ok")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ranks = read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS)
    out = byte_bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", (F.length("bpe.ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("bpe.ids", 256).alias("ids_sha256"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2,
                                      public_tokenizers.path(PIECES))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), end_id=2)
    return token_files.read_token_files(manifest, digest=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"))
    return _scored(docs, 4, 2, toxicity.toxic_score(model))


def _scored(docs: DataFrame, mod: int, rest: int, score: Column) -> DataFrame:
    out = docs.select("doc_id", (crc_mod("doc_id", mod) == rest).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    ranked, plan, r = mixing.mix_plan(docs)
    out = mixing.with_copies(ranked, plan, r, "copies")
    return out.select("doc_id", F.col(f"{r}.size").alias("size"), "source_size", "target",
                      (F.col("copies") * F.col(f"{r}.size")).alias("taken"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = rule_lists.learn_rules(docs, read(spark, sf_dir, "labels"))
    out, r = rule_lists.apply_rules(docs.select("doc_id", "text"), rules)
    return out.select("doc_id", f"{r}.n_words", f"{r}.word_chars", f"{r}.n_symbols",
                      F.col(f"{r}.l.dup").alias("n_dup_lines"), f"{r}.n_repeat_words", f"{r}.base_failed", f"{r}.kept",
                      f"{r}.rule")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = pair_rank.fit_quality(docs, read(spark, sf_dir, "labels"))
    return _scored(docs, 5, 0, pair_rank.quality_score(model))


def op9_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_vectors(read(spark, sf_dir, "embeddings"), 0.95)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, roles, text = EXTRA_CONVERSATION
    more = spark.createDataFrame([(conv, i, r, text) for i, r in enumerate(roles)],
                                 T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                                               T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    out = chat_format.read_segments(chat_format.format_segments(rows.unionByName(more)))
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_align.align_tokens(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES])))
    return url_rules.judge_urls(pages, rules).select("page_id", "judged.*")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_lattice_lm, op3_simhash, op4_token_files, op5_toxicity, op6_mix, op7_rules,
                                      op8_quality, op9_ego_join, op10_chat, op11_token_align, op12_url_filters,
                                      op13_spelling)}
