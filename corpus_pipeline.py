"""The corpus pipeline: documents to packed training sequences, one operator a stage.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's docs. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlog.llm import histogram_pack, language_svm, minmax_dedup, quality_qda, string_tiling
from emberlog.llm.common import settle, stored, table
from emberlog.llm.queries import tokenizer

# score from which a document stays; it leans towards keeping, as the language model's own threshold does
LEAST_QUALITY = 0.5
# near duplicates: 100 * intersection >= 80 * union of five-word shingles
NEAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is at least as likely of quality 1 as of quality 0; without labels all stay.

    Null and empty texts are scored like any other, and rows with equal texts stay or go together. Columns may have any name.
    """
    settle(spark)
    features = quality_qda.stored_features(docs)
    model = quality_qda.fit(features, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return quality_qda.scored(rows, model, "score").filter(F.col("score") >= LEAST_QUALITY).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without letters and those that fit no learned language go.

    The threshold is set from labelled rows that the machines have not seen (``language_svm.Model.least``). Rows with
    equal texts stay or go together. Columns may have any name.
    """
    settle(spark)
    model = language_svm.fit(docs.select("doc_id", "text", "lang"))
    found = language_svm.identified(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, "found")
    known = F.col("found.lang") != language_svm.UNKNOWN
    return found.filter(known & (F.col("found.score") >= model.least)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the smallest doc_id, null ones last, and of equal rows any one.

    Documents without words are near to nothing; equal rows of them are still one.
    """
    settle(spark)
    return minmax_dedup.deduplicated(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; equal rows stay or go together, and a null text is clean."""
    settle(spark)
    return string_tiling.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: sequence_id, length, pieces (with doc_id), ids. A null text is empty; every row is packed."""
    settle(spark)
    return histogram_pack.sequences(histogram_pack.pieces(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality), ("language ID", language), ("near-duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packing),
]

# trained models and packing are beyond SQL; tests/llm compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the whole documents table."""
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
