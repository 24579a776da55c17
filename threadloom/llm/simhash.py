"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit where over half the shingle hashes have it. Fingerprints within 3 bits agree
within 1 bit in one of two 32-bit segments. So each fingerprint is in a table under both segments,
and looks up the Hamming ball of radius 1 around its own. Of two segments that differ in one bit one
has an odd number of ones; only that side enumerates its ball. Matches are verified over all 64 bits
within the join.

Segments that many fingerprints share would make the matches grow with the square of their number.
Fingerprints under such a segment are linked exactly in another way: two fingerprints within 3 bits
have a common centre within 1 bit of the one and 2 bits of the other, and all within 1 bit of a
centre are within 3 bits of all within 2 bits of it. So at every centre one of the nearer ones links
to all others, which is a star instead of all pairs.

Copies share a fingerprint and are counted once. Links become components over fingerprints.

Cases: null and empty texts have fingerprint zero, linked like any other; fewer words than a shingle
make one shingle of the whole sequence; null ids never name a component that has another id;
repeated rows are rows of the same component; an empty table gives no rows; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import long_id, stored, whole_row, words_of
from threadloom.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
# A segment under which more fingerprints stand goes the way of centres.
CROWDED = 64
CHUNK = 50_000
# Stands for a null id, so that it is never the smallest.
LAST_ID = (1 << 63) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, stops = first[:n].tolist(), ends[len(words) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + CHUNK], stops[at:at + CHUNK])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, hash of the text, fingerprint as a signed long; stored, as texts are read once."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select(long_id(), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return stored(rows.mapInArrow(compute, "doc_id long, text_hash long, fp long"), "fingerprints")


def _segments():
    """Both segments as numbers that also tell which segment it is."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32))
    return F.array(low, high)


def _table(fps: DataFrame) -> DataFrame:
    return fps.select("fp", F.explode(_segments()).alias("key"))


def _probes(fps: DataFrame) -> DataFrame:
    """The segment itself, and its ball of radius 1 if it has an odd number of ones."""
    odd = F.bit_count(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))) % 2 == 1
    flips = F.when(odd, F.sequence(F.lit(-1), F.lit(31))).otherwise(F.array(F.lit(-1)))
    flip = F.expr("case when bit < 0 then 0L else shiftleft(1L, bit) end")
    return (
        _table(fps).select(F.col("fp").alias("probe"), "key", F.explode(flips).alias("bit"))
        .select("probe", F.col("key").bitwiseXOR(flip).alias("key"), (F.col("bit") < 0).alias("own"))
    )


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _centre_edges(near: DataFrame, far: DataFrame) -> DataFrame:
    """Links between `near` and `far` within 3 bits, as stars around common centres."""
    one = F.expr("shiftleft(1L, i)")
    two = F.expr("case when i = j then shiftleft(1L, i) else shiftleft(1L, i) ^ shiftleft(1L, j) end")
    bits = F.sequence(F.lit(0), F.lit(63))
    inner = near.select("fp", F.explode(bits).alias("i")).select(
        "fp", F.col("fp").bitwiseXOR(one).alias("centre")).unionByName(
        near.select("fp", F.col("fp").alias("centre")))
    outer = far.select("fp", F.explode(bits).alias("i")).select(
        "fp", "i", F.explode(F.sequence(F.col("i"), F.lit(63))).alias("j")).select(
        "fp", F.col("fp").bitwiseXOR(two).alias("centre")).unionByName(
        far.select("fp", F.col("fp").alias("centre")))
    heads = inner.groupBy("centre").agg(F.min("fp").alias("u"))
    return (inner.unionByName(outer).join(heads, "centre").filter("fp <> u")
            .select("u", F.col("fp").alias("v")).distinct())


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Edges u, v that connect the same fingerprints as all pairs within 3 bits do."""
    under = _table(fps)
    hot = stored(under.groupBy("key").count().filter(F.col("count") > crowded).select("key"), "hot")
    cold = under.join(hot, "key", "left_anti")
    found = _probes(fps).join(
        cold.hint("shuffle_hash"), "key").filter(
        _near("probe", "fp") & (~F.col("own") | (F.col("probe") < F.col("fp"))))
    edges = found.select(F.col("probe").alias("u"), F.col("fp").alias("v"))
    far = under.join(hot, "key", "left_semi").select("fp").distinct()
    near = _probes(fps).join(hot, "key", "left_semi").select(F.col("probe").alias("fp")).distinct()
    return edges.unionByName(_centre_edges(near, far))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, crowded: int = CROWDED) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (a fingerprint), component_id."""
    rows = fingerprints(docs, shingle)
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), crowded))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component: that with the smallest id, all its columns unchanged."""
    return first_of_each(docs, near_duplicates(docs))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document with the smallest id of each root; `found` has doc_id, text_hash and root.

    Several rows with that id and text count as one document; one of them stays.
    """
    last = F.coalesce("doc_id", F.lit(LAST_ID))
    keep = found.groupBy("root").agg(
        F.min(F.struct(last.alias("id"), "text_hash")).alias("kept"))
    text_hash = F.xxhash64(F.col("text").cast("string"))
    keyed = docs.select(
        whole_row(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        text_hash.alias("hash"))
    chosen = keep.select(F.col("kept.id").alias("id"), F.col("kept.text_hash").alias("hash"))
    one = Window.partitionBy("id", "hash").orderBy(F.xxhash64("row"))
    return (
        keyed.join(chosen, ["id", "hash"], "left_semi")
        .withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
    )


def op6(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
