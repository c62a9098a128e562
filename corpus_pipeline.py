"""The corpus pipeline: documents in, token digests of the documents that stay out.

Each stage calls one operator of ``eventide.llm`` on all its predecessor kept;
what a stage returns is written as Parquet into the folder that
``spark.checkpoint.dir`` names and read again as the next one's input.  All
stages but the last return the columns of ``documents``:

1. language ID: documents judged ``und`` (null text, or no letter) go;
2. SimHash near-dedup: of each class the document with the smallest id stays;
3. benchmark decontamination: documents with a hit word go;
4. PII: spans are replaced by their kind in brackets, all documents stay;
5. BPE encoding and decoding: n_tokens and digests of ids and decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import bpe, decontam, langid, pii, simhash
from eventide.llm.queries import vocab_path
from eventide.llm.staging import staged
from eventide.sources.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, vocab_path(), digest=True)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontaminate), ("PII", redact_pii),
          ("BPE encoding and decoding", encode)]

#: Loopy messages, connected components and BPE merges have no SQL form; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
