"""The corpus pipeline: toxic documents, near copies and benchmark leaks go, the rest is mixed and
written as token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents; between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import decontaminate, mixing, simhash, token_pack, toxicity
from threadloom.llm.common import stored, table
from threadloom.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not reject; it learns from the labels of these documents."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Near copies are linked as by the SimHash operator: three-word shingles, at most three bits apart.
    """
    return simhash.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight wants it."""
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in packed files; one row per document as read back from them."""
    return token_pack.op8(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]

# Networks, random rounding and token files are nothing that SQL can state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
