"""A training-data pipeline of the operators in ``nimbus.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbus.llm import exact_dedup, near_dedup, packing, source_mix, toxicity
from nimbus.llm.common import written
from nimbus.llm.queries import tokenizer_path
from nimbus.sources.tables import load

#: Words of a shingle in the near dedup stage; the pairs of words of op3 are that query's own.
NEAR_SHINGLE = 5


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose toxicity score reaches the threshold of their language."""
    return toxicity.reject(docs, load(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (by runs of five words) one document stays."""
    return near_dedup.drop_near(docs, shingle=NEAR_SHINGLE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights; a document comes as often as the mix takes it."""
    return source_mix.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    packed = packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("near dedup", near), ("source mix", mix), ("packing", pack)]
#: Training, sketches and random rounding are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's output written and read again."""
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs
