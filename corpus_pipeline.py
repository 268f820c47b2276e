"""Corpus preparation: each stage applies one operator to all that the stage before it kept.

All stages but the last return the columns of ``documents``; other columns of
their input are left out.  Null and empty texts pass the classifier by the score
of its bias, are alike for the near-dedup, have no words, no private data and
no tokens (null ones null ids).  Rows are told apart by id and text: ids may be
null or repeat.  An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import bpe, decontaminate, pii, quality, simhash
from assayframe.llm.queries import ACCEPT, PSEUDONYM_KEY, RANKS, quality_model
from assayframe.llm.shared import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    rows = quality.scored(docs, quality_model(spark, docs, sf_dir), to="__score")
    return rows.where(F.col("__score") >= ACCEPT).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of similar texts (five-word shingles, similarity 0.8), whatever ids are null or shared."""
    return simhash.first_of_groups(docs).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    rows = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return rows.where(~F.col("contaminated")).select(COLUMNS)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms of the same format."""
    rows = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether these decode to the text's bytes."""
    rows = bpe.with_tokens_and_bytes(docs, RANKS, public_tokenizers.PATTERN)
    same = F.col("decoded").eqNullSafe(F.col("text").cast("binary"))
    return rows.select(*COLUMNS, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("decodes"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII pseudonyms", replace_private),
    ("byte-level BPE", tokenise),
]

#: The classifier, the fingerprints' components, the pseudonyms and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last keeps is written, so later ones don't make it again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
