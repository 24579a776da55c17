"""Token ids in bit-packed binary files with block offsets.

File format, little endian: magic `TLPK0001`; then blocks; then a footer; then the footer's length
(8 bytes) and the magic again. A block holds `block_ids` ids (the last one fewer), each in `bits`
bits, lowest bit first, padded to whole bytes. The footer is `bits`, `block_ids`, the number of ids
and of documents (8 bytes each), the byte offset of every block, and the first id of every document.
`bits` is the least that holds every id of the vocabulary. Any run of ids is read by seeking to its
blocks and unpacking them with numpy.

Files are written by tasks under names of their own and listed by the rows that the task returns, so
a retried or repeated task leaves a file that no manifest names. The manifest is a Parquet table.

Cases: null and empty texts are documents with the end id alone; long texts are encoded whole in
pieces that end at white space; equal ids are ordered by text; null ids come first; an empty table
gives no files and no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import long_id, new_folder, qualified, stored
from threadloom.llm.encoding import END, letters_encoder

MAGIC = b"TLPK0001"
BLOCK_IDS = 65_536
END_ID = 1
# ASCII punctuation that the vocabulary's words never share with letters before it.
TAIL_BYTE = np.isin(np.arange(256), np.frombuffer(b".,;:!?%&$#*", np.uint8))
ASCII_LETTER = np.isin(np.arange(256) | 32, np.arange(97, 123)) & (np.arange(256) < 128)
# Stands between pieces that are encoded together.
PART = "|"
REMEMBERED = 400_000
FILE_BYTES = 64 * 1024 * 1024

MANIFEST_SCHEMA = ("part int, place long, doc_id long, path string, first long, n_tokens long, "
                   "file_tokens long")
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, path string, first long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in `bits` bits each, lowest bit first, padded to whole bytes."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    every = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
    return np.packbits(every.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of a packed block."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype(np.uint32)
    every = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = every.reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class PackedWriter:
    """Writes one file block by block; holds one block of ids and the offsets in memory."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.sink.write(MAGIC)
        self.position, self.total = len(MAGIC), 0
        self.offsets: list[int] = []
        self.starts: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: np.ndarray) -> None:
        self.starts.append(self.total)
        self.total += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            together = np.concatenate(self.waiting)
            whole = len(together) - len(together) % self.block_ids
            for at in range(0, whole, self.block_ids):
                self._block(together[at:at + self.block_ids])
            self.waiting, self.held = [together[whole:].copy()], len(together) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.position)
        self.sink.write(data)
        self.position += len(data)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        head = np.array([self.bits, self.block_ids, self.total, len(self.starts)], "<u8")
        footer = b"".join(x.tobytes() for x in (
            head, np.array(self.offsets, "<u8"), np.array(self.starts, "<u8")))
        self.sink.write(footer)
        self.sink.write(np.array([len(footer)], "<u8").tobytes() + MAGIC)
        self.sink.close()


class PackedReader:
    """Random access to the ids of one file; holds the footer and one block in memory."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a packed token file")
        length = int(np.frombuffer(tail[:8], "<u8")[0])
        source.seek(size - 16 - length)
        footer = np.frombuffer(source.read(length), "<u8").astype(np.int64)
        self.bits, self.block_ids, self.total, self.documents = (int(x) for x in footer[:4])
        blocks = -(-self.total // self.block_ids) if self.total else 0
        self.offsets, self.starts = footer[4:4 + blocks], footer[4 + blocks:]
        self.held, self.ids = -1, np.zeros(0, np.uint32)

    def _block(self, number: int) -> np.ndarray:
        if number != self.held:
            n = min(self.block_ids, self.total - number * self.block_ids)
            self.source.seek(int(self.offsets[number]))
            self.ids = unpack(self.source.read(-(-n * self.bits // 8)), n, self.bits)
            self.held = number
        return self.ids

    def pieces(self, first: int, n: int) -> Iterator[np.ndarray]:
        """Ids first .. first+n-1, block by block."""
        while n > 0:
            block, at = divmod(first, self.block_ids)
            piece = self._block(block)[at:at + n]
            yield piece
            first, n = first + len(piece), n - len(piece)

    def read(self, first: int, n: int) -> np.ndarray:
        parts = list(self.pieces(first, n))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _parted(texts: pa.Array) -> pa.Array:
    """The texts with a space between a letter and punctuation behind it, where words are cut anyway.

    Letters are those of ASCII and Latin-1; others are left to the tokenizer.
    """
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    starts = offsets - offsets[0]
    letter = ASCII_LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    before = np.zeros(len(data) + 1, bool)
    before[1:-1] = letter[:-1] & TAIL_BYTE[data[1:]]
    before[starts] = False  # not across the edge of two texts
    at = np.flatnonzero(before)
    wider = np.insert(data, at, 32)
    moved = starts + np.searchsorted(at, starts, side="left")
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(moved.astype(np.int64)), pa.py_buffer(wider))


class Encoder:
    """Ids of texts by the tokenizers library, each different piece of a block encoded once.

    Pieces are what stands between ASCII white space, so joining their ids equals encoding the
    whole text; so does cutting ASCII punctuation off after a letter. Arrow cuts and numbers the
    pieces of a block; what is Python's is done once per different piece, and ids are gathered by
    numpy. New pieces are encoded many at a time: those of small letters by the same merges in
    tiktoken, the others by the library, parted by a sign that none of them holds and whose token
    ends each. What is remembered from block to block is bounded and changes nothing but speed.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        parted = self._ids(PART)
        self.part = parted[0] if len(parted) == 1 else None
        self.letters = letters_encoder(self.tokenizer)
        self.ends_word = np.zeros(self.vocabulary, bool)
        if self.letters:
            suffix = self.tokenizer.model.end_of_word_suffix
            for token, number in self.tokenizer.get_vocab().items():
                self.ends_word[number] = token.endswith(suffix)
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, new: list[str]) -> None:
        letters, others = [], []
        for piece in new:
            small = self.letters and piece.isalpha() and piece.islower()
            if small and (piece.isascii() or unicodedata.is_normalized("NFC", piece)):
                letters.append(piece)
            elif PART in piece or self.part is None:
                self.known[piece] = np.array(self._ids(piece), "<u4").tobytes()
            else:
                others.append(piece)
        mark = END.decode()
        for at in range(0, len(letters), 20_000):
            some = letters[at:at + 20_000]
            ids = np.array(self.letters.encode_ordinary(mark.join(some) + mark), "<u4")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            self._cut(some, ids, [0, *stops[:-1]], stops)
        for at in range(0, len(others), 20_000):
            some = others[at:at + 20_000]
            ids = np.array(self._ids(f" {PART} ".join(some)), "<u4")
            stops = np.append(np.flatnonzero(ids == self.part), len(ids))
            self._cut(some, ids, np.append(0, stops[:-1] + 1), stops)

    def _cut(self, pieces: list[str], ids: np.ndarray, starts, stops) -> None:
        """Remember each piece's part of ids; should their number differ, encode them one by one."""
        if len(stops) != len(pieces):
            self.known.update((p, np.array(self._ids(p), "<u4").tobytes()) for p in pieces)
            return
        data = ids.tobytes()
        self.known.update(zip(pieces, (
            data[4 * a:4 * b] for a, b in zip(map(int, starts), map(int, stops)))))

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each ended by the end id, and where each text's ids end."""
        texts = pc.fill_null(texts, "")
        # Case goes anyway; names of special tokens alone are told apart by it.
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        lists = pc.ascii_split_whitespace(
            _parted(pc.if_else(plain, pc.ascii_lower(texts), texts)))
        pieces = lists.flatten().dictionary_encode()
        names = pieces.dictionary.to_pylist()
        known = self.known
        self._learn([p for p in names if p not in known])
        own = [*map(known.__getitem__, names), np.array([END_ID], "<u4").tobytes()]
        while len(known) > REMEMBERED:  # the newest go: frequent pieces come early
            known.popitem()
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        flat = np.frombuffer(b"".join(own), "<u4")
        # The end id follows the last piece of each text.
        last = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        order = np.insert(pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64), last,
                          len(names))
        n = sizes[order]
        ends = np.cumsum(n)
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.arange(ends[-1] if len(ends) else 0)
                   + np.repeat(starts[order] - (ends - n), n)]
        return ids, ends[last + np.arange(len(last))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends = self.encode_block(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1])


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of a worker process, which remembers pieces from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = "file://" + folder[len("file:"):]
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def _blocks(batches: Iterator[pa.RecordBatch], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of about this size of text; a longer text is a block of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(
            zero_copy_only=False)
        number = np.cumsum(sizes, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _writer(folder: str, tokenizer_path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        filesystem, root = _filesystem(folder)
        out, path, rows, part, place = None, "", [], 0, 0

        def finish():
            out.close()
            total = out.total
            for at in range(0, len(rows), 50_000):
                some = rows[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(some), pa.int32())]
                    + [pa.array([r[0] for r in some], pa.int64()),
                       pa.array([r[1] for r in some], pa.int64()),
                       pa.array([path] * len(some)),
                       pa.array([r[2] for r in some], pa.int64()),
                       pa.array([r[3] for r in some], pa.int64()),
                       pa.array([total] * len(some), pa.int64())],
                    names=["part", "place", "doc_id", "path", "first", "n_tokens", "file_tokens"])

        for block in _blocks(batches):
            every, ends = encoder.encode_block(block.column("text"))
            starts = [0, *ends.tolist()]
            for own, key, a, b in zip(block.column("part").to_pylist(),
                                      block.column("doc_id").to_pylist(), starts, starts[1:]):
                ids = every[a:b]
                if out is None or out.total * out.bits // 8 >= FILE_BYTES:
                    if out is not None:
                        yield from finish()
                    path = f"{root}/{uuid.uuid4().hex}.bin"
                    filesystem.create_dir(root, recursive=True)
                    out = PackedWriter(filesystem.open_output_stream(path),
                                       bits_for(encoder.vocabulary))
                    rows, part = [], own
                rows.append((place, key, out.total, len(ids)))
                place += 1
                out.add(ids)
        if out is not None:
            yield from finish()

    return write


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        opened, reader, source = None, None, None
        for batch in batches:
            sums = []
            for path, first, n in zip(*(batch.column(c).to_pylist()
                                        for c in ("path", "first", "n_tokens"))):
                if path != opened:
                    if source is not None:
                        source.close()
                    source = filesystem.open_input_file(path)
                    opened, reader = path, PackedReader(source)
                crc = 0
                for piece in reader.pieces(first, n):
                    crc = zlib.crc32(np.ascontiguousarray(piece, "<u4").tobytes(), crc)
                sums.append(crc)
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64()), batch.column("path"),
                 batch.column("first")],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "path", "first"])
        if source is not None:
            source.close()

    return read


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, files: int | None = None
                 ) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the stored manifest.

    The table is dealt out by ranges of (doc_id, text hash), sorted within each range, and each
    range is written as one file or, beyond `FILE_BYTES`, several.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    dealt = (
        docs.select(long_id(), F.col("text").cast("string").alias("text"))
        .repartitionByRange(files, F.col("doc_id"), tie)
        .sortWithinPartitions(F.col("doc_id"), tie)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    return stored(dealt.mapInArrow(_writer(folder, tokenizer_path), MANIFEST_SCHEMA), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: place of its ids in the whole, their number and crc32.

    Files are put in order by their totals, one row a file.
    """
    folder = qualified(manifest.sparkSession, folder)
    order = Window.orderBy("part", "file_place").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.groupBy("path").agg(
        F.min("part").alias("part"), F.min("place").alias("file_place"),
        F.max("file_tokens").alias("tokens"),
    ).select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("before"))
    return (
        manifest.join(files, "path")
        .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens",
                "path", "first")
        .mapInArrow(_reader(folder), DOCUMENT_SCHEMA)
    )


def op8(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the packed files, then read every document back from them."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer_path), folder).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
