"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's documents.  All but the last return the columns of ``documents``, further
columns included.

Cases, in every stage: an empty table stays empty; a null or empty text is a document without words,
which the classifier scores like any other, which is nobody's copy and holds no passage, and which
packs to its end id alone; a null id is kept as such; rows that repeat id and text are copies, of
which the near-duplicate stage keeps one; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forumshift.llm import decontaminate, minhash, packing, pii, quality, queries
from forumshift.llm.staging import drop_stages, stage, staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.3 or more).  Without any labels every
    document scores 0.5 and stays."""
    return quality.keep_good(docs, queries.quality_model(spark, sf_dir, docs), threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: the one of the
    least id.  Documents without words are all kept."""
    return minhash.keep_first(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words or more cut out; documents made of them dropped.  An empty
    benchmark cuts nothing."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by the name of their kind; every document stays."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids, by sequence and offset; every id of every document is in one."""
    return packing.pack(docs, queries.vocabulary("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# The first and last stages are a trained network and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage has written goes when the next one has
    read it."""
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(staged())
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stages(spark, staged()[kept:-1])                  # but for the stage just written
    return docs
