"""From raw documents to packed training sequences, stage by stage.

Each stage takes all documents that the one before it kept, as a written table. Quality classifier and
rules remove documents, near-duplicates are thinned to one of each group, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import histogram_packing, minhash_dedup, quality_model, rule_cascade
from wayfare.llm.queries import public_tokenizer
from wayfare.session import ship_package, written
from wayfare.sources.tables import table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_cascade.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return minhash_dedup.deduplicated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return histogram_packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", accept_quality),
    ("quality_rules", apply_rules),
    ("near_duplicates", drop_near_duplicates),
    ("best_fit_packing", pack_sequences),
]

# fitted models and hashed minhashes are outside SQL; tests compare each stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
