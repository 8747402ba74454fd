"""Registered queries of the corpus operators and the comparison SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from . import (
    chat_events, histogram_pack, language_svm, lexical_search, license_join, line_dedup, minimax_shards, minmax_dedup, quality_qda, rans_blocks,
    scaled_sketch, spelling_trie, string_tiling,
)
from .common import settle, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file; operators take any path."""
    return public_tokenizers.path(name)


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = lambda spark, sf_dir: function(settle(spark), sf_dir)
    return function


@query
def op1_minmax_dedup(spark, sf_dir):
    return minmax_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("doc_key", "representative")


@query
def op2_license_join(spark, sf_dir):
    found = license_join.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = sorted(set(license_join.PHRASES.values()))
    starts = F.concat(*[F.col(f"places.{x}") for x in labels])
    base = F.array_compact(F.array(*[F.when(F.size(f"places.{x}") > 0, F.lit(x)) for x in labels]))
    every = F.array_sort(F.array_union(base, F.col("spans.label")))
    return found.select(
        "doc_id", "n_words", "n_base", F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), "score",
        F.size("spans").cast("bigint").alias("n_spans"),
    )


@query
def op3_rans_blocks(spark, sf_dir):
    folder = scratch_dir(spark, "rans")
    rans_blocks.write(table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"))
    return rans_blocks.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_string_tiling(spark, sf_dir):
    found = string_tiling.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("tiles", F.to_json("tiles"))


@query
def op5_quality_qda(spark, sf_dir):
    features = quality_qda.stored_features(table(spark, sf_dir, "documents"))
    model = quality_qda.fit(features, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = features.select("doc_id", quality_qda.held_out(F.col("doc_id")).alias("held_out"), quality_qda.scorer(model)("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op6_minimax_shards(spark, sf_dir):
    placed = minimax_shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_histogram_pack(spark, sf_dir):
    cut = histogram_pack.pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    narrow = cut.select("row", "doc_id", "piece", "start", F.col("length"), F.crc32("ids").alias("ids_crc32"))
    return histogram_pack.assign(narrow).drop("row").withColumn("length", F.col("length").cast("bigint"))


@query
def op8_language_svm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_svm.identified(docs.select("doc_id", "text"), language_svm.fit(docs))
    return found.select(
        "doc_id", language_svm.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


@query
def op9_chat_events(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    log = chat_events.log_of(conversations.unionByName(extra))
    return chat_events.read_back(chat_events.formatted(log))


@query
def op10_scaled_sketch(spark, sf_dir):
    pairs = scaled_sketch.edited(scaled_sketch.with_next(table(spark, sf_dir, "documents").select("doc_id", "text")))
    both = scaled_sketch.fingerprint(pairs, "edited", "edited_sketch")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array_join("sketch", "").alias("fingerprint"),
        F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        scaled_sketch.likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text") == F.col("edited")).alias("near_edited"),
        scaled_sketch.likeness(F.col("sketch"), F.col("next_sketch"), F.col("same_text")).alias("near_next"),
    )


@query
def op11_cuckoo_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.LineIndex.empty(spark).insert(docs).kept(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op12_trie_variants(spark, sf_dir):
    return spelling_trie.variants(table(spark, sf_dir, "documents"))


@query
def op13_best_positions(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
