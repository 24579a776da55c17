"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Texts become sequences of word hashes; words are runs of letters and digits in lower case. A mask
selects some positions of a window and ignores the others, so a seed still matches where an ignored
word has been replaced. Seeds of all positions and masks of the documents meet those of the
benchmark in a hash join. A benchmark seed carries the words around it, so each hit is verified in
the same row: some aligned stretch of `STRETCH` words (or the whole of a shorter item) must agree in
at least `AGREE` of its words. Only verified hits are grouped.

The masks lose nothing: wherever the replaced words of such a stretch stand, some mask at some place
of it ignores them all. For `LONG` words or more, with at most two replaced, three masks of six words
do; shorter items have masks of four words, which the documents are only asked for if there are any.

Benchmark seeds are broadcast, at most about `MOST_BROADCAST` at a time: a larger set is dealt into
blocks by seed, and the documents meet one block after the other.

Cases: null and empty texts and items have no words and match nothing; items of fewer than five
words are never looked for, as a few common words would match them; long texts are compared whole;
repeated rows give one result for each (doc_id, item_id), with null ids as ids of their own; empty
tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import stored, whole_row

# 1 marks the positions that count. Items of less than LONG words have masks of their own.
MASKS = ("1101111", "111100011", "1100011011")
SHORT_MASKS = ("1111", "11011", "10111", "11101")
NUMBERED = list(enumerate(MASKS + SHORT_MASKS))
LONG = 11
SHORTEST = 5
STRETCH = 13
AGREE = 0.8
AROUND = 24
MOST_BROADCAST = 200_000
LONGEST_MASK = max(map(len, MASKS))
LEAST_PLACES = min(map(len, MASKS + SHORT_MASKS))


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.array_remove(F.split(F.lower(text.cast("string")), r"[^\p{L}\p{N}]+"), "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)),
                      F.array().cast("array<bigint>"))


def _seed(number: int, mask: str, words: str, at: str) -> Column:
    """The seed of a mask at a position; null where the window leaves the text."""
    chosen = [F.get(F.col(words), F.col(at) + i) for i, bit in enumerate(mask) if bit == "1"]
    fits = F.col(at) + len(mask) <= F.size(words)
    return F.when(fits, F.xxhash64(F.lit(number), *chosen))


def _seeds(sequences: DataFrame, numbered: list[Column], words: str, at: str) -> DataFrame:
    """One row per position and mask that fits, with `at` and `seed`.

    The outer explode keeps Spark from deriving a filter that would compute the words twice.
    """
    whole = F.size(words) >= LEAST_PLACES
    places = F.when(whole, F.sequence(F.lit(0), F.size(words) - LEAST_PLACES))
    return (
        sequences.select("*", F.explode_outer(places).alias(at))
        .select("*", F.explode(F.array(*numbered)).alias("seed")).filter("seed is not null")
    )


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """Seeds with item_id, place q of the seed, and the item's words around it (`near` from `low`)."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("item"))
    long, short = F.size("item") >= LONG, F.size("item").between(SHORTEST, LONG - 1)
    numbered = [F.when(long if i < len(MASKS) else short, _seed(i, mask, "item", "q"))
                for i, mask in NUMBERED]
    low = F.greatest(F.lit(0), F.col("q") - AROUND)
    return _seeds(items, numbered, "item", "q").select(
        "seed", "item_id", "q", F.size("item").alias("item_words"), low.alias("low"),
        F.slice("item", low + 1, LONGEST_MASK + 2 * AROUND).alias("near"))


def overlaps(docs: DataFrame, benchmark: DataFrame, stretch: int = STRETCH,
             agree: float = AGREE, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """One row per contaminated document and item: how well and where they overlap.

    Columns doc_id, item_id, agreement (share of equal words in the best stretch), first_word and
    last_word (of the document, between the verified seeds).
    """
    seeds = stored(benchmark_seeds(benchmark), "benchmark-seeds")
    known, shortest = seeds.agg(F.count("*"), F.min("item_words")).first()
    blocks = max(1, -(-known // most_broadcast))
    masks = NUMBERED if known and shortest < LONG else NUMBERED[:len(MASKS)]
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        word_hashes(F.col("text")).alias("words"))
    numbered = [_seed(i, mask, "words", "p") for i, mask in masks]
    every = _seeds(words, numbered, "words", "p")
    found = []
    for block in range(blocks):
        mine = F.pmod("seed", F.lit(blocks)) == block
        part = every if blocks == 1 else every.filter(mine)
        found.append(_verified(part.join(F.broadcast(seeds.filter(mine)), "seed"), stretch, agree))
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(
        F.max("agreement").alias("agreement"), F.min("p").alias("first_word"),
        F.max("p").alias("last_word"))


def _verified(hits: DataFrame, stretch: int, agree: float) -> DataFrame:
    """Hits beside which some stretch agrees well enough, one row per such stretch."""
    # Every stretch of the item's words against the document's on the same alignment. Written out
    # word by word, so that seeds, join and check are one generated loop without copies of texts.
    span = F.least(F.lit(stretch), F.col("item_words"))
    aligned = hits.select("*", span.alias("span"), F.explode(
        F.sequence(F.lit(0), F.size("near") - span)).alias("s"))
    there = F.col("p") - F.col("q") + F.col("low") + F.col("s")
    equal = [
        F.when(F.lit(k) < F.col("span"), F.get("near", F.col("s") + k).eqNullSafe(
            F.get("words", there + k)).cast("int")).otherwise(0)
        for k in range(stretch)
    ]
    agreement = reduce(add, equal) / F.col("span")
    return aligned.select("doc_id", "item_id", "p", agreement.alias("agreement")).filter(
        F.col("agreement") >= agree)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that overlap an item; all columns unchanged."""
    found = overlaps(docs, benchmark).select("doc_id").distinct()
    found = found.select(F.col("doc_id").alias("leaked"))
    keyed = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("id"))
    return keyed.join(found, F.col("id").eqNullSafe(F.col("leaked")), "left_anti").select("row.*")


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return overlaps(docs, benchmark)
