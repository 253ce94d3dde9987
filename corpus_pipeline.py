"""A corpus from raw documents to packed sequences, one operator of the subpackage per stage.

Every stage works on what its predecessor kept. Toxic documents go; one document of each group of
near-duplicates stays; repeated passages are cut out; sources are mixed to their targets, a document
taken twice being two rows; the mix is packed into sequences. All stages but the last return the
columns of documents. Nulls, empty and repeated rows and empty tables are handled as the operators'
docstrings say.
"""

from __future__ import annotations

from curbstar.llm import minhash, mixing, packing, repeats, toxicity
from curbstar.llm.common import Scratch, read
from curbstar.llm.queries import tokenizer_path
from pyspark.sql import DataFrame, SparkSession


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: the classifier and the tokenizer are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's result written and read again."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
