"""The corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is written
and read again as the next one's ``docs``; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_dedup, mixing, packing, simhash, toxicity
from tidemark.llm.common import put, table
from tidemark.llm.queries import held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier scores at 0.5 or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return toxicity.score(docs.select(COLUMNS), model, name="_score").where("_score < 0.5").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines, and passages of 50 words and more, that occur earlier in the corpus leave their texts; every document stays."""
    cleaned = line_dedup.remove_repeated(docs.select(COLUMNS), least_words=50)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits of each other stays."""
    return simhash.deduplicate(docs.select(COLUMNS), shingle=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come none, one or two times, as the mix of their sources asks."""
    mixed = mixing.mix(docs.select(COLUMNS)).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2048 words as lists of document ids and word spans."""
    return packing.pack(docs.select(COLUMNS))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The toxicity model, fingerprints and best-fit search have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = put(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
