"""Ranked lexical search over a length-stratified index.

Documents whose normaliser m is equal form a stratum, and a stratum is kept in blocks of bounded
size. A block holds its postings by term and, within a term, by frequency: within a stratum a term's
impact depends on its frequency alone, so it is computed once per frequency and stands for every
posting of that run. The greatest frequency of each term in a stratum bounds what any document there
can score. A first visit scores, for each item, the strata of the highest bounds until they are sure
to hold as many matches as are wanted; the last score found is the item's threshold. The second visit
scores every other block whose bound reaches the threshold, so the results are exact.

The index keeps the terms that the stated items ask for, of all documents; document counts and
lengths are over all terms. Items are indexed and searched in blocks of at most `ITEM_BLOCK` rows.

Cases: a null text has no terms, neither in a document nor in an item; items without terms, or whose
terms no document holds, have no rows; rows of one item id are one item, a null id being an id like
any other; repeated documents are ranked each for itself; a null doc_id follows all others among
equal scores; a text of any length is read whole; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import long_id, stored

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# The same on texts: what is left of all characters when ASCII but letters and digits is cut out.
TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
# Rows of items that are searched at a time; their terms and thresholds are sent to every task.
ITEM_BLOCK = 500_000
BLOCK_DOCUMENTS = 4_096
LAST = np.iinfo(np.int64).max

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


@dataclass
class Index:
    """`blocks`: one row per block, with columns

    m, docs (ids), codes and tfs (term and frequency of each run), ends (of the runs in `places`) and
    places (of the documents in `docs`, run by run). `weights`: one row per term, columns term, code
    and w; both are stored tables.
    """

    blocks: DataFrame
    weights: DataFrame


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) terms; every byte of a character beyond ASCII belongs to a term."""
    return [] if text is None else TERM.findall(text.encode("utf-8", "surrogatepass").lower())


def item_terms(items: DataFrame) -> DataFrame:
    """Each item's terms, once each: item_id, term."""
    words = F.regexp_extract_all(
        F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(TERM_SQL), F.lit(0))
    return items.select(long_id("item_id"), F.explode(words).alias("term")).distinct()


def _count_terms(codes: dict[bytes, int]):
    """Per document its length in terms, and the wanted terms among them with their frequencies."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, own, tfs = [], [], []
            for text in batch.column(1):
                terms = terms_of(text.as_py())
                n.append(len(terms))
                found = Counter(filter(None.__ne__, map(codes.get, terms)))
                own.append(list(found))
                tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(own, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "codes", "tfs"])

    return count


def _invert(rows: pa.Table) -> pa.Table:
    """One block of documents of equal m, by term and frequency."""
    codes, tfs = rows.column("codes").combine_chunks(), rows.column("tfs").combine_chunks()
    place = np.repeat(np.arange(len(rows), dtype=np.int32),
                      codes.value_lengths().to_numpy(zero_copy_only=False))
    code, tf = codes.flatten().to_numpy(), tfs.flatten().to_numpy()
    order = np.lexsort((place, tf, code))
    code, tf, place = code[order], tf[order], place[order]
    last = np.flatnonzero(np.append((code[1:] != code[:-1]) | (tf[1:] != tf[:-1]), len(code) > 0))
    lists = [(rows.column("doc_id").combine_chunks(), pa.int64()), (code[last], pa.int32()),
             (tf[last], pa.int32()), (last + 1, pa.int32()), (place, pa.int32())]
    columns = [pa.ListArray.from_arrays([0, len(values)], pa.array(values, kind))
               for values, kind in lists]
    return pa.table([rows.column("m").slice(0, 1).combine_chunks(), *columns],
                    names=["m", "docs", "codes", "tfs", "ends", "places"])


BLOCKS = ("m long, docs array<long>, codes array<int>, tfs array<int>, ends array<int>, "
          "places array<int>")


def build(docs: DataFrame, terms: list[str], block_documents: int = BLOCK_DOCUMENTS) -> Index:
    """Index all documents for these terms; terms that no document holds have no row in `weights`."""
    spark = docs.sparkSession
    codes = {term.encode("utf-8", "surrogatepass"): code for code, term in enumerate(terms)}
    counted = stored(
        docs.select(long_id(), F.col("text").cast("string").alias("text"))
        .mapInArrow(_count_terms(codes), "doc_id long, n long, codes array<int>, tfs array<int>")
        .withColumn("row", F.monotonically_increasing_id()), "term-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
    n, length = total.n, total.l or 0
    known = spark.createDataFrame(list(enumerate(terms)), "code int, term string")
    df = counted.select(F.explode("codes").alias("code")).groupBy("code").agg(
        F.count("*").alias("df"))
    weights = stored(known.join(df, "code").select(
        "term", "code",
        F.floor(1000 * F.log((F.lit(2.0 * n) + 2) / (2 * F.col("df") + 1))).alias("w")), "weights")
    strata = counted.filter(F.size("codes") > 0).withColumn(
        "m", F.expr(f"100 - 50 + ((50 * n * {n}L) div {max(length, 1)}L)"))
    # A crowded stratum is dealt to blocks by row, so that no id can crowd one.
    sizes = strata.groupBy("m").agg(F.ceil(F.count("*") / F.lit(block_documents)).alias("blocks"))
    dealt = strata.join(sizes, "m").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    blocks = (dealt.select("m", "block", "doc_id", "codes", "tfs").repartition("m", "block")
              .groupBy("m", "block").applyInArrow(_invert, BLOCKS))
    return Index(stored(blocks, "index"), weights)


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def first_visits(index: Index, asked: DataFrame, top: int) -> DataFrame:
    """For each item the strata of the highest bounds, until `top` matches are sure: item, m.

    `asked` has columns item, code, w. A stratum is sure to hold as many matches as the term that most
    of its documents hold has postings there. There are at most `top` strata per item.
    """
    runs = index.blocks.select(
        "m", F.explode(F.arrays_zip("codes", "tfs", "ends", F.concat(
            F.array(F.lit(0)), F.slice("ends", F.lit(1), F.greatest(
                F.size("ends") - 1, F.lit(0)))).alias("starts"))).alias("run"))
    heads = runs.groupBy("m", F.col("run.codes").alias("code")).agg(
        F.max("run.tfs").alias("tf"), F.sum(F.col("run.ends") - F.col("run.starts")).alias("sure"))
    bounds = heads.join(asked.filter("w > 0"), "code").groupBy("item", "m").agg(
        F.sum(F.expr("w * ((1000000000L * tf) div (1000L * tf + 20 * m))")).alias("bound"),
        F.max("sure").alias("sure"))
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "m")
    before = F.sum("sure").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return bounds.select("item", "m", F.coalesce(before, F.lit(0)).alias("before")).filter(
        F.col("before") < top).select("item", "m")


class _Asked:
    """The items of a search: their terms with weights, as flat arrays."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.items, first = np.unique(table[:, 0], return_index=True)
        self.codes, self.weights = table[:, 1], table[:, 2]
        self.ends = np.append(first[1:], len(table))
        self.starts = first


def _score(asked: _Asked, top: int, visits: dict[int, list[int]] | None, least: np.ndarray):
    """Scores of the documents in each block, for items that may reach their least score there.

    With `visits`, only the items that are to see a block's stratum are scored.
    """
    wanted = {m: np.array(sorted(items)) for m, items in visits.items()} if visits else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                m = batch.column("m")[row].as_py()
                if wanted is not None and m not in wanted:
                    continue
                docs, codes, tfs, ends, places = (
                    batch.column(c)[row].values for c in ("docs", "codes", "tfs", "ends", "places"))
                known = docs.is_valid().to_numpy(zero_copy_only=False)
                ids = np.where(known, docs.fill_null(0).to_numpy(), LAST)
                codes, tfs, ends, places = (
                    x.to_numpy().astype(np.int64) for x in (codes, tfs, ends, places))
                lengths = np.diff(ends, prepend=0)
                impacts = impact(tfs, m)  # once per run
                each = np.repeat(impacts, lengths)
                # Runs of one term are neighbours, the last with its greatest frequency.
                last = np.flatnonzero(np.append(codes[1:] != codes[:-1], True))
                stops = ends[last]
                starts = np.append(0, stops[:-1])
                term, greatest = codes[last], impacts[last]
                at = np.searchsorted(term, asked.codes)
                at[at == len(term)] = 0
                held = term[at] == asked.codes
                worth = np.where(held, greatest[at] * asked.weights, 0)
                bounds = np.add.reduceat(worth, asked.starts)
                visited = np.flatnonzero((bounds > 0) & (bounds >= least))
                if wanted is not None:
                    visited = np.intersect1d(visited, np.searchsorted(asked.items, wanted[m]))
                found: list[tuple[np.ndarray, ...]] = []
                for item in visited[np.argsort(-bounds[visited], kind="stable")]:
                    scores = np.zeros(len(ids), np.int64)
                    for i in range(asked.starts[item], asked.ends[item]):
                        if held[i] and asked.weights[i]:
                            a, b = starts[at[i]], stops[at[i]]
                            scores[places[a:b]] += asked.weights[i] * each[a:b]
                    good = np.flatnonzero(scores >= max(least[item], 1))
                    if len(good) > top:
                        good = good[np.lexsort((ids[good], -scores[good]))[:top]]
                    found.append((np.full(len(good), asked.items[item]), ids[good], scores[good],
                                  known[good]))
                if found:
                    item, doc, value, real = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item), pa.array(doc, mask=~real), pa.array(value)],
                        names=["item", "doc_id", "score"])

    return score


FOUND = "item long, doc_id long, score long"


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(index: Index, asked: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents of each item: item, rank, doc_id, score.

    `asked` has columns item and code and is at most one block of items.
    """
    weighted = asked.join(index.weights, "code").select("item", "code", "w")
    rows = [tuple(r) for r in weighted.collect()]
    if not rows:
        return index.blocks.sparkSession.createDataFrame(
            [], "item long, rank int, doc_id long, score long")
    terms = _Asked(rows)
    least = np.zeros(len(terms.items), np.int64)
    visits: dict[int, list[int]] = {}
    for item, m in first_visits(index, weighted, top).collect():
        visits.setdefault(m, []).append(item)
    first = _best(index.blocks.filter(F.col("m").isin(list(visits)))
                  .mapInArrow(_score(terms, top, visits, least), FOUND), top)
    # An item with fewer matches than wanted so far keeps the threshold 0.
    for item, score in first.filter(F.col("rank") == top).select("item", "score").collect():
        least[np.searchsorted(terms.items, item)] = score
    return _best(index.blocks.mapInArrow(_score(terms, top, None, least), FOUND), top).select(
        "item", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, item_block: int = ITEM_BLOCK,
           block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """The `top` highest-scoring documents of each item: item_id, rank, doc_id, score."""
    pairs = stored(item_terms(items), "item-terms")
    ids = stored(pairs.select("item_id").distinct().withColumn(
        "item", F.monotonically_increasing_id()), "items")
    pairs = pairs.join(ids, pairs.item_id.eqNullSafe(ids.item_id)).select("item", "term")
    # Blocks of whole items, by a hash of their number; one block if all rows fit.
    blocks = -(-pairs.count() // item_block) or 1
    results = []
    for block in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        terms = sorted(r.term for r in own.select("term").distinct().collect())
        index = build(docs, terms, block_documents)
        coded = own.join(index.weights.select("term", "code"), "term").select("item", "code")
        results.append(search(index, coded, top))
    found = results[0]
    for result in results[1:]:
        found = found.unionByName(result)
    return found.join(ids, "item").select("item_id", "rank", "doc_id", "score")
