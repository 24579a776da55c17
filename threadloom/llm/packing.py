"""Packing of documents into sequences of a bounded length by cutting-stock column generation.

Every document is encoded, ended by an id of its own and cut into pieces of `capacity` ids and one
rest. Spark counts the pieces of each length; from that histogram, at most `capacity` rows, the
driver makes patterns (`cutting_stock`). Pieces are then ranked within their length by document, and
a rank says which sequence of which pattern a piece lies in, and where. Ids never leave the table of
pieces: only lengths and keys are sorted.

Cases: null and empty texts are documents of the end id alone; long texts are encoded whole and make
as many pieces as they need; repeated rows are documents each for itself; null ids come first in the
ranking; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm import cutting_stock
from threadloom.llm.common import long_id, stored
from threadloom.llm.encoding import encoder_of
from threadloom.operators.ranking import dense_row_number

CAPACITY = 1024
END_ID = 0
ROWS_A_BATCH = 4_096

PIECES = ("doc_id long, start long, length int, doc_tokens long, ids_crc32 long, ids binary")


def _cutter(tokenizer_path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        # Ids are kept in 16 bits where the vocabulary fits them.
        narrow = "<u2" if encoder.vocabulary <= 1 << 16 else "<u4"

        def rows(key, text):
            ids = np.append(encoder.encode(text), np.uint32(END_ID)).astype("<u4")
            kept = ids.astype(narrow)
            for start in range(0, len(ids), capacity):
                own = ids[start:start + capacity]
                yield (key, start, len(own), len(ids), zlib.crc32(own),
                       kept[start:start + capacity].tobytes())

        def batch_of(some):
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*some), types)],
                names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

        waiting = []
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                for row in rows(key.as_py(), text.as_py() or ""):
                    waiting.append(row)
                    if len(waiting) == ROWS_A_BATCH:
                        yield batch_of(waiting)
                        waiting = []
        if waiting:
            yield batch_of(waiting)

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One stored row per piece, numbered in column `piece`: its place in the document, and its ids."""
    cut = docs.select(long_id(), F.col("text").cast("string").alias("text")).mapInArrow(
        _cutter(tokenizer_path, capacity), PIECES)
    return stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")


class Layout:
    """Where the r-th piece of each length goes.

    A pattern that holds n pieces of a length takes n of that length's ranks for each sequence that
    follows it, so a pattern and a length make one interval of ranks.
    """

    def __init__(self, plan: list[tuple[dict[int, int], int]]):
        taken: dict[int, int] = {}
        intervals = []
        sequence = 0
        for pattern, times in plan:
            offset = 0
            for length, n in sorted(pattern.items(), reverse=True):
                first = taken.get(length, 0)
                intervals.append((length, first, n, sequence, offset))
                taken[length] = first + n * times
                offset += length * n
            sequence += times
        table = np.array(sorted(intervals), np.int64).reshape(-1, 5)
        self.length, self.first, self.n, self.sequence, self.offset = table.T
        self.sequences = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        order = np.lexsort((rank, length))
        # Both sides in order of (length, rank): each piece belongs to the last interval before it.
        keys = np.concatenate([self.length, length[order]])
        ranks = np.concatenate([self.first, rank[order]])
        piece = np.repeat([0, 1], [len(self.length), len(order)])
        both = np.lexsort((piece, ranks, keys))
        latest = np.cumsum(piece[both] == 0) - 1
        at = np.empty(len(length), np.int64)
        at[order[both[piece[both] == 1] - len(self.length)]] = latest[piece[both] == 1]
        turn, slot = np.divmod(rank - self.first[at], self.n[at])
        return self.sequence[at] + turn, self.offset[at] + slot * length


def _placer(layout: Layout):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                            for c in ("length", "rank"))
            sequence, offset = layout.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*(c for c, name in zip(batch.columns, batch.schema.names) if name != "rank"),
                 pa.array(sequence), pa.array(offset)],
                names=[*(n for n in batch.schema.names if n != "rank"), "sequence_id", "offset"])

    return place


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece, beside its key; the ids stay in the table of pieces."""
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}
    layout = Layout(cutting_stock.plan(histogram, capacity))
    keys = ["piece", "doc_id", "start", "length", "doc_tokens", "ids_crc32"]
    order = [F.col("length"), F.col("doc_id").asc_nulls_first(), F.col("start"),
             F.col("ids_crc32"), F.col("piece")]
    numbered = dense_row_number(cut.select(*keys), order, "number", lambda df: stored(df, "ranked"))
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    # The map has one entry per length, at most as many as the capacity.
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else None
    rank = (F.col("number") - 1 - starts[F.col("length")]) if before else F.lit(0)
    ranked = numbered.select(*keys, rank.cast("long").alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*keys).schema)
    return ranked.mapInArrow(_placer(layout), f"{schema}, sequence_id long, offset long")


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """Ids of every sequence, its pieces in order, without padding."""
    own = packed.select("piece", "sequence_id", "offset").join(cut.select("piece", "ids"), "piece")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return own.groupBy("sequence_id").agg(
        F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("hex")
    ).select("sequence_id", F.unhex("hex").alias("ids"))


def op13(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(pieces(docs, tokenizer_path)).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "doc_tokens", "sequence_id", "offset")
