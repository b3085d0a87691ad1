"""From raw documents to packed sequences: five stages, each written and read again.

Every stage takes all that the one before it kept. The first four return the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import langid, linededup, mixing, packing, simhash
from tablesync.llm.common import saved, table


#: A label that a prediction with at least this score contradicts is corrected.
SURE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its language; those in none go.

    The languages are learnt from the stage's own labelled documents. A document without
    text or letters is in no language; it goes, and so does no other. A null ``lang`` becomes
    the predicted one, and a ``lang`` that the prediction contradicts with a score of
    ``SURE`` or more is corrected, unless the document is itself in the sample that its label's
    language was learnt from (64 documents a language). Without labelled documents there is nothing to learn and
    nothing is filled in. Rows that repeat are treated alike; an empty table stays empty.
    """
    model = langid.learn(docs)
    if not model:
        return docs.where(langid.has_letters("text"))
    found = langid.identify(docs, model)
    found = found.where(F.col("lang_pred") != langid.UNDETERMINED)
    wrong = F.col("lang").isNull() | ((F.col("lang") != F.col("lang_pred")) & (F.col("score") >= SURE))
    return found.withColumn("lang", F.when(wrong, F.col("lang_pred")).otherwise(F.col("lang"))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go from every document."""
    out = linededup.dedup_lines(docs, min_docs=10, min_chars=1)
    out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, words=4, distance=4)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: some documents once, some twice, some not, shard by shard."""
    out = mixing.mix(docs, mixing.WEIGHTS)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_to_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of one length."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing_to_weights),
    ("packing", packing_to_sequences),
]

#: Language ID, fingerprints, draws and tokens can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
