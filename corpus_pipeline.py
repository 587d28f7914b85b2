"""The corpus pipeline: documents through five operators, each stage stored before the next reads it.

1. quality rules: documents that the policy rejects go;
2. n-gram Jaccard join: of each group of near-duplicates the smallest doc_id stays, null last;
3. benchmark decontamination: contaminated documents go;
4. mixing sources to target weights: a document appears as often as the mix takes it;
5. token-ID / binary output: bit-packed shards, read back to one row for each document written.

Edge cases: null and empty texts have too few words for stage 1.  Very long texts go through whole.
Rows that are equal, or tie as copies, leave one row at stage 2; rows that share a doc_id, or have
none, but differ in text are documents of their own.  A null doc_id is written last.  Further columns
of documents, whatever their names, are carried up to stage 4 and are not read.  Of an empty table
nothing is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import decontam, jaccard, mixing, quality, tokenbin
from folioframe.llm.common import stored
from folioframe.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenbin.tokenize(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("token output", token_output),
]

#: The token stage has no SQL: the library's vocabulary is no relation.  tests/llm checks the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
