"""A corpus pipeline: toxicity, near-duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
to the shared folder and gives it to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.llm.mixing import mixed_documents
from earworm.llm.pieces import encode_pieces, piece_model
from earworm.llm.pii import sanitised
from earworm.llm.simhash import without_near_duplicates
from earworm.llm.store import documents, written
from earworm.llm.toxicity import fit_chain, without_toxic
from earworm.session import table_scope


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that a stage may have changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic or severely toxic go."""
    return without_toxic(docs, fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at 3 bits of the 3-word SimHash stays."""
    return without_near_duplicates(docs, shingle=3, radius=3)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are replaced in the texts."""
    return _recounted(sanitised(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often (0, 1, 2 times) as the mix of sources takes them."""
    return _recounted(mixed_documents(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text that is left, checked by decoding."""
    return encode_pieces(docs, piece_model())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("encoding", encoding)]

#: Model fitting, SimHash and Viterbi are beyond SQL: tests/llm hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.  What a stage has
    written for itself is dropped when its result is."""
    docs = documents(spark, sf_dir)
    *stages, (_, last) = STAGES
    for name, stage in stages:
        with table_scope(spark):
            docs = written(stage(spark, docs, sf_dir), name, outer=True)
    return last(spark, docs, sf_dir)
