"""The corpus pipeline: stages over ``documents``, each written as Parquet and
reread as the next one's input.

Toxic documents go, of identical texts one stays, of near-duplicates one stays,
sources are mixed to their target weights (a document may then be there up to
three times, or not at all), and what is left is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from signalyard.llm import bagminhash, common, exact_dedup, mixing, packing, toxicity

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a grammar learned from the
    labels of ``docs``.  Texts that are null or empty score as clean."""
    grammar = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(*common.COLUMNS), grammar)
    return scored.filter(F.col("toxicity") < toxicity.THRESHOLD).select(*common.COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts (null is empty) the row with the largest doc_id."""
    table = common.numbered(docs)
    kept = exact_dedup.numbered_groups(table).filter("kept").select("row")
    return table.join(kept, "row").select(*common.COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each class of near-duplicates; texts without words are
    one class."""
    table = common.numbered(docs)
    kept = bagminhash.numbered_classes(table).filter("kept").select("row")
    return table.join(kept, "row").select(*common.COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, to the nearest whole
    document: 0 to 3 times.  Documents without words are not in a mix."""
    table = common.numbered(docs)
    taken = mixing.copies(mixing.mix(table, row=F.col("row")))
    return (table.join(taken, "row")
            .select(*common.COLUMNS, F.explode(F.sequence(F.lit(1), "copies"))).select(*common.COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), end_id=0)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("packing", pack_sequences)]

#: SQL cannot express the stages; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``sf_dir``'s documents."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        path = common.shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
