"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import (chat, contamination, lexical, line_dedup, mixing, negatives, packing, pstable, quality, sharding, simhash, toxicity,
                          warc)
from tidemark.llm.common import table
from tidemark.llm.oracles import ORACLES  # noqa: F401  (read by the entry module)


def op1_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("row.doc_id", "row.source", "size", "source_size", F.round("target", 6).alias("target"), "copies", "taken")


def op2_embedding_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors by cosine inside a label."""
    found = pstable.linked(table(spark, folder, "embeddings"))
    return found.select("row.vec_id", "n_links", "component_id", "kept")


def op3_divergence_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, distances to the language references and the verdict of every document."""
    judged = quality.judge(table(spark, folder, "documents"))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def op4_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a WARC record, read back: payloads of revisits are those of the responses they refer to."""
    pages = table(spark, folder, "pages")
    records = warc.archived(pages).select(
        F.col("page").cast(pages.schema["page_id"].dataType).alias("page_id"),
        F.coalesce(F.octet_length("payload"), F.col("declared_bytes")).cast("long").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("payload_digest")).alias("payload_digest"), "record_type",
        F.col("refers_to").cast(pages.schema["page_id"].dataType).alias("refers_to"),
        (F.col("block_ok") & F.coalesce("payload_ok", F.lit(True))).alias("digests_hold"))
    return records


def op5_snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every logged conversation, and the size and digest of the rendered text of those kept."""
    facts, parts = chat.format_chats(table(spark, folder, "conversations"))
    sizes = parts.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum(F.length("text")).alias("rendered_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", F.md5("text").alias("d")))), lambda p: p["d"]), ",").alias("rendered_md5"))
    return facts.join(sizes, "conv", "left").select("conv_id", "n_turns", "kept", "covered_by", "n_parts", "rendered_chars", "rendered_md5")


def op6_line_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the line chunks, and the passages of 50 words and more, that occur earlier in the corpus."""
    return line_dedup.remove_repeated(table(spark, folder, "documents"), least_words=50).select("doc_id", "n_chunks", "n_removed", "text")


def op7_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and place in it of every document, and its shard with one more."""
    return sharding.assign(table(spark, folder, "documents"), shards=16).withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that no model of these queries learns from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op8_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every whole text, by a model of the labels outside the held-out fifth."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.score(docs.select("doc_id", "text"), model, columns=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in bins of 2048 words, as lists of ids and word spans."""
    return packing.pack(table(spark, folder, "documents"))


def op10_simhash_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), shingle=3, distance=2)
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_slot_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its positives; a seventh of the labels is moved on first."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_wu_manber_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words and items of the benchmark's windows in every whole document."""
    found = contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), columns=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))
    return found.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_bit_sliced_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents of highest score for every item of the benchmark."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_pareto_mix, op2_embedding_near_dups, op3_divergence_quality, op4_warc_round_trip, op5_snapshot_collapse, op6_line_chunk_dedup,
    op7_hash_tree_shards, op8_subword_toxicity, op9_best_fit_packing, op10_simhash_near_dups,
    op11_slot_hard_negatives, op12_wu_manber_contamination, op13_bit_sliced_search)}
