"""Five stages from raw documents to token ids, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. ``run`` writes each stage's rows as Parquet into
the shared folder and reads them again for the next, so a lost executor costs one
stage at most.

Null and empty texts are scored like a text about which compressed sizes say nothing;
they are one near-duplicate class of texts without words, of which the smallest id
stays; they hold no benchmark item and no personal data, and have no ids. Rows without an
id are kept or dropped by the same rules; of repeated rows one stays. Very long texts
are worked on whole. An empty table gives no rows. Columns beyond those of documents
pass through all stages (the last replaces ids, n_byte_ids, ids_crc32 and round_trip).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm import compression_quality, decontamination, near_copies, personal_data, unigram
from sokhan.llm.common import shared_folder, table

#: Documents that score less are dropped.
QUALITY = 0.3
#: Texts whose five-word shingles are as similar are near copies; a class of them keeps one document.
SHINGLE, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on labels, doesn't reject."""
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    return compression_quality.score(docs, model).filter(F.col("quality_score") >= QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    return near_copies.keep_one(docs, shingle=SHINGLE, similarity=SIMILARITY).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other values."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    return personal_data.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether these decode to the text."""
    out = unigram.encode_documents(docs, unigram.vocabulary_path())
    return out.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("redact", redact), ("encode", encode)]
#: SQL can express neither dictionaries, fingerprints nor the Viterbi search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
