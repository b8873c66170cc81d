"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir), is written as Parquet and read again.

Every stage but the last returns the columns of `documents`. What a stage decides takes effect on
the next one's input: rejected languages, later copies and leaking documents are gone, the language
found is in `lang`, and the rows stand in the order of the mixture, in which the last stage encodes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.llm import decontaminate, jaccard, language, mixing, token_output
from demesne.llm.common import table
from demesne.llm.queries import END_ID, tokenizer_path
from demesne.session import checkpoint_root, tune


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents whose language is not accepted go."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, with five words and 0.8: one document of each component stays."""
    return jaccard.one_of_each(docs, 5, 80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that leak a test item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: all rows, written in the order of the mixture."""
    return mixing.mix_in_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids in the order in which the rows were written, as digests per document."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    placed = docs.select("doc_id", "text", part.alias("_file"), F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_at"))
    return token_output.encode_documents(placed, tokenizer_path(), END_ID, ["_file", "_name", "_at"])


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID output", encoded),
]

#: Language models and tokenization are not stated in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(tune(spark), sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return out
