"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents; their decisions take effect:

1. quality: documents that fail the base rules or the compression bands go;
2. near_duplicates: one document of each group of near copies stays;
3. decontamination: documents that hold a benchmark window go;
4. personal_data: spans are replaced by their kinds, n_chars follows;
5. tokens: columns token_ids and decoded are added.

Limits, counts and the lexicon are learned from the documents that reach their
stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textrec.llm import compression, group_jaccard, lexicon, pii, positional
from textrec.llm.common import table
from textrec.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return group_jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return positional.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path(lexicon.VOCABULARY)
    return lexicon.encode_documents(docs, path, lexicon.build_lexicon(docs, path))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

#: zstandard, the random field and the tokenizer have no SQL; tests/llm checks
#: the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
