"""Registered queries of the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import (
    collocations, decontaminate, html_text, lexical_search, mixing, packing, repetition, secrets,
    sharding, simhash, suffix_tree, token_pack, toxicity,
)
from threadloom.llm.common import table
from threadloom.llm.expected import (
    collocations_sql, decontamination_sql, repetition_sql, search_sql,
)

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_virtual_slots(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.op1(table(spark, directory, "documents"))


def op2_suffix_tree(spark: SparkSession, directory: str) -> DataFrame:
    return suffix_tree.scores(table(spark, directory, "documents"))


def op3_pivotal_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.op3(table(spark, directory, "documents"))


def op4_decoding_worklist(spark: SparkSession, directory: str) -> DataFrame:
    return secrets.secret_scan(table(spark, directory, "documents"))


def op5_spaced_seeds(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.op5(
        table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op6_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.op6(table(spark, directory, "documents"))


def op7_site_templates(spark: SparkSession, directory: str) -> DataFrame:
    return html_text.main_text(table(spark, directory, "pages"))


def op8_bit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return token_pack.op8(table(spark, directory, "documents"), tokenizer_path())


def op9_recurrent_network(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.op9(table(spark, directory, "documents"), table(spark, directory, "labels"))


def op10_repetition_coverage(spark: SparkSession, directory: str) -> DataFrame:
    return repetition.repetition(table(spark, directory, "documents"))


def op11_stratified_search(spark: SparkSession, directory: str) -> DataFrame:
    return lexical_search.ranked(
        table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op12_count_streams(spark: SparkSession, directory: str) -> DataFrame:
    return collocations.collocations(table(spark, directory, "documents"))


def op13_cutting_stock(spark: SparkSession, directory: str) -> DataFrame:
    return packing.op13(table(spark, directory, "documents"), tokenizer_path(BYTE_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_virtual_slots,
        op2_suffix_tree,
        op3_pivotal_mixing,
        op4_decoding_worklist,
        op5_spaced_seeds,
        op6_simhash,
        op7_site_templates,
        op8_bit_packing,
        op9_recurrent_network,
        op10_repetition_coverage,
        op11_stratified_search,
        op12_count_streams,
        op13_cutting_stock,
    )
}

# The other queries hold packings, random draws, trained models, files or hashes that SQL has not;
# their tests compare them with brute force.
ORACLE: dict[str, str] = {
    "op5_spaced_seeds": decontamination_sql(),
    "op10_repetition_coverage": repetition_sql(),
    "op11_stratified_search": search_sql(),
    "op12_count_streams": collocations_sql(),
}
