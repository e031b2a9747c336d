"""The corpus pipeline: toxicity, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All
but the last return the columns of documents.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import mixing, ngram_join, packing, secrets, toxicity
from roadpulse.llm.catalog import LEVELS, WEIGHTS
from roadpulse.llm.common import free_name, set_aside
from roadpulse.session import checkpoint_dir

#: Words that an encoder remembers while packing, when executors still hold the memory of the stages before.
PACKING_WORDS = 250_000
#: Share of the tokens left that the mixture takes; each document is used once at most.
MIX_SHARE = (9, 10)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model is fitted on the labelled documents that came in.

    Where no labelled document came in nothing is fitted, and all documents stay.
    """
    weights = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not toxicity.fitted(weights):
        return docs
    name = free_name(docs, "toxic_score")
    return toxicity.score(docs, weights, name).where(F.col(name) < 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return ngram_join.drop_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents stay."""
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, each once."""
    own, restored = set_aside(docs, "doc_id", "text", "lang", "source")
    return restored(mixing.mix(own, LEVELS, WEIGHTS, share=MIX_SHARE, max_epochs=1, seed=17))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, in sequences of up to 1024 tokens."""
    return packing.pack(docs, with_ids=True, remembered=PACKING_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fitted weights, redaction and token ids have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            at = f"{folder}/{number}-{name}"
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
    return docs
