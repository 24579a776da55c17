"""Language-model scores by a probabilistic suffix tree over words.

Words in training texts are counted exactly; the root of the tree is their smoothed distribution, the
base. A text is preceded by an end. A context of up to `DEPTH` words is looked at if it is followed
`LEAST_CONTEXT` times by a word in training texts, and it is kept if the words after it diverge from
those after its suffix, that is if they raise the likelihood by more than their number. A kept context
gives each word (n + SMOOTHING * p) / (total + SMOOTHING), where p is what its suffix gives, so every
distribution sums to 1. Each token is scored in the longest kept suffix of what precedes it.

These floors do not depend on the input: the tree grows with the corpus and lies in no single place.
Positions are dealt by what precedes them, so that all positions below a context meet in one bucket,
which counts its branch of the tree and scores its positions; there are buckets for every
`BUCKET_TOKENS` tokens. Contexts that hold a third of that, or a hundredth of all tokens, would crowd a
bucket. They are counted level by level before, kept on the driver and broadcast, and positions behind
them are dealt by the next longer context. At least `HOT_SHARE` of all tokens makes a context hot, so
there are at most 1/share of them on each level; beyond 1e10 tokens a bucket must hold that share. Only the words that a hot
context is followed by in fewer than `PAIR_SHARE` of all tokens have a floor that rises: its suffix
predicts these, the branches behind it still tell them apart.

Words below `KNOWN_SHARE`, whose counts are joined to the texts by word, stand for themselves in
contexts, told apart by 31 bits of a hash. After a context they are one symbol, whose probability is
shared among them as in the base; at most 1/share words are symbols of their own.

Cases: null and empty texts are the end alone; texts are read whole; repeated rows count and are
scored each for itself; null ids count as the empty id text; without training rows all counts are 0
and the tree is its root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import crc_of_id, long_id, stored, words_of

KNOWN_SHARE = 2e-6
HOT_SHARE, MOST_COLD_SHARE = 5e-5, 1e-2
PAIR_SHARE = 2e-7
LEAST_CONTEXT = 20
DEPTH = 3
SMOOTHING = 20.0
# A context is kept if it gains this many nats, and one for each next symbol that it names.
LEAST_GAIN = 5.0
OTHER, END = 0, 1
HELD_COUNTS = 300_000
BLOCK_TOKENS = 500_000
BUCKET_TOKENS = 1_500_000
BATCH_BYTES = 4_000_000
# Of zstd, for positions.
LEVEL = 3
# Cells of 64 bits in which words are marked by their symbols.
CELLS = 1 << 20
# Symbols of words below KNOWN_SHARE begin here; the last number stands for nothing before a text.
RARE = 1 << 31
NOTHING = (1 << 32) - 1

ENCODED = ("row long, doc_id long, held_out boolean, n_tokens long, ids binary, "
           "rare array<binary>")
DEALT = "bucket long, positions binary, texts binary"
SUMS = "part long, positions binary, texts binary"
SCORED = "row long, n_known long, n_rare long, base double, tree double"
# Older words, the word, text of the block; row and whether it is for training; sums by row.
POSITION = ["<u4"] * (DEPTH + 1) + ["<u4"]
BLOCK_ROW = ["<i8", "u1"]
POSITION_SUM = ["<i8", "<f4"]
TEXT_SUM = ["<i8", "<i8", "<i8", "<f8", "<f8"]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(long_id(), F.col("text").cast("string").alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (crc_of_id() % 10 == 0).alias("held_out"), "text")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for value in batch.column(0):
            counts.update(words_of(value.as_py()))
            counts[b""] += 1  # the end
            if len(counts) > HELD_COUNTS:
                yield flush()
    if counts:
        yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over training texts; the end is the empty word."""
    training = _texts(docs).filter("not held_out").select("text")
    return stored(
        training.mapInArrow(_count_words, "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("c")), "words")


@dataclass
class Words:
    """Totals, and ids of the known words: 0 any other word, 1 the end, then by falling count."""

    tokens: int
    distinct: int
    ids: dict[bytes, int]
    counts: np.ndarray
    least_known: int

    @property
    def outside(self) -> float:
        """Smoothed number of tokens of all words that are not known."""
        known = self.counts[1:]
        return (self.tokens - float(known.sum())
                + 0.1 * (max(0, self.distinct - int((known > 0).sum())) + 1))

    @property
    def base_total(self) -> float:
        return self.tokens + 0.1 * (self.distinct + 1)

    @property
    def root(self) -> np.ndarray:
        """log10 of each known word, and of all others together."""
        share = self.counts + 0.1
        share[OTHER] = self.outside
        return np.log10(share / self.base_total)

    @property
    def kind(self) -> str:
        return "<u2" if len(self.counts) < 1 << 16 else "<u4"


def known_words(counts: DataFrame) -> Words:
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(1, int(np.ceil(KNOWN_SHARE * tokens)))
    rows = counts.filter((F.col("c") >= least) | (F.length("word") == 0)).toArrow().to_pydict()
    pairs = sorted(((-c, bytes(w)) for w, c in zip(rows["word"], rows["c"]) if w))
    ends = sum(c for w, c in zip(rows["word"], rows["c"]) if not w)
    ids = {w: i + 2 for i, (_, w) in enumerate(pairs)}
    array = np.array([0, ends, *(-c for c, _ in pairs)], np.int64)
    return Words(tokens, distinct, ids, array, least)


def _encoder(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        get, kind = words.ids.get, words.kind
        for batch in batches:
            totals, ids, rare = [], [], []
            for value in batch.column(3):
                own = words_of(value.as_py())
                numbers = [get(w, OTHER) for w in own]
                numbers.append(END)
                totals.append(len(numbers))
                numbers = np.array(numbers, kind)
                ids.append(numbers.tobytes())
                place = np.flatnonzero(numbers == OTHER)
                rare.append([own[i] for i in place.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(totals, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(rare, pa.list_(pa.binary()))],
                names=["row", "doc_id", "held_out", "n_tokens", "ids", "rare"])

    return encode


@dataclass
class Tree:
    """Hot nodes of all levels; node 0 is the root. Children are found by parent and older symbol."""

    root: np.ndarray  # log10 of each known word
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # keys, nodes
    kept: np.ndarray = field(default_factory=lambda: np.ones(1, bool))
    rest: np.ndarray = field(default_factory=lambda: np.zeros(1))  # log10 share left to the suffix
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def symbols(self) -> int:
        return len(self.root)

    def walk(self, past: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The node of each position at level 1, 2, ...; -1 where there is none.

        `past` are the symbols before the positions, the newest first.
        """
        node = np.zeros(len(past[0]), np.int64)
        for (keys, nodes), older in zip(self.levels, past):
            found = (node >= 0) & (older < self.symbols)
            key = node * self.symbols + older
            at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            found &= (keys[at] == key) if len(keys) else False
            node = np.where(found, nodes[at] if len(nodes) else -1, -1)
            yield node

    def score(self, past: list[np.ndarray], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token in its longest hot suffix that is kept, and levels of hot suffixes."""
        out, depth = self.root[symbols], np.zeros(len(symbols), np.int64)
        for level, node in enumerate(self.walk(past), 1):
            depth[node >= 0] = level
            use = np.flatnonzero((node >= 0) & self.kept[node])
            if len(use):
                out[use] = self._in_node(node[use], symbols[use], out[use])
        return out, depth

    def _in_node(self, node, symbol, suffix):
        """log10 of symbols after kept nodes, given what they have after the suffix."""
        code = node * self.symbols + symbol
        at = np.minimum(np.searchsorted(self.pairs, code), max(0, len(self.pairs) - 1))
        named = (self.pairs[at] == code) if len(self.pairs) else np.zeros(len(code), bool)
        logs = self.logs[at] if len(self.logs) else 0.0
        return np.where(named, logs, self.rest[node] + suffix)


def _blocks(batches, columns: list[str], kind: str):
    """Blocks of texts: their other columns, ids of all tokens, start of each token's text, text."""
    for batch in batches:
        ids = batch.column("ids")
        first = 0
        size = 0
        for i in range(batch.num_rows):
            size += len(ids[i].as_buffer())
            if size >= 2 * BLOCK_TOKENS or i == batch.num_rows - 1:
                own = [np.frombuffer(ids[k].as_buffer(), kind) for k in range(first, i + 1)]
                length = np.array([len(x) for x in own])
                stop = np.cumsum(length)
                yield ([batch.column(c).slice(first, i + 1 - first) for c in columns],
                       np.concatenate(own), np.repeat(stop - length, length),
                       np.repeat(np.arange(len(own)), length))
                first, size = i + 1, 0


def _past(symbols: np.ndarray, start: np.ndarray, depth: int) -> list[np.ndarray]:
    """Symbols before each position, the newest first; before a text stands an end, then nothing."""
    place, past = np.arange(len(symbols)), [np.full(len(symbols), NOTHING)] * DEPTH
    for k in range(1, depth + 1):
        older = place - k
        past[k - 1] = np.where(older >= start, symbols[np.maximum(older, 0)],
                               np.where(older == start - 1, END, NOTHING))
    return past


def _pair_counter(shared, kind: str):
    """Counts (node, next symbol) at the deepest level of the tree, per block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for _, ids, start, _ in _blocks(batches, [], kind):
            symbols = ids.astype(np.int64)
            node = None
            for node in tree.walk(_past(symbols, start, len(tree.levels))):
                pass
            inside = node >= 0
            code, n = np.unique(node[inside] * tree.symbols + symbols[inside], return_counts=True)
            for at in range(0, len(code), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[at:at + 100_000]), pa.array(n[at:at + 100_000])],
                    names=["code", "n"])

    return count


def _full(tree: Tree, parent_rows: np.ndarray, symbol: np.ndarray, parent_of: list[np.ndarray]
          ) -> np.ndarray:
    """log10 of symbols after the nodes named by rows, through all kept nodes above them."""
    out = tree.root[symbol]
    for nodes in parent_of:
        node = nodes[parent_rows]
        use = np.flatnonzero((node > 0) & tree.kept[node])
        if len(use):
            out[use] = tree._in_node(node[use], symbol[use], out[use])
    return out


def grow(encoded: DataFrame, words: Words, depth: int = DEPTH) -> Tree:
    """The hot part of the tree, level by level; each level counts its pairs in one pass."""
    tree = Tree(words.root)
    if not words.tokens:
        return tree
    least_context = int(np.ceil(max(
        LEAST_CONTEXT, HOT_SHARE * words.tokens,
        min(MOST_COLD_SHARE * words.tokens, BUCKET_TOKENS / 3))))
    least_pair = max(1, int(np.ceil(PAIR_SHARE * words.tokens)))
    spark = encoded.sparkSession
    training = encoded.filter("not held_out").select("ids")
    # Children to be looked at: parent node and older symbol. All words may precede the root.
    older = np.flatnonzero(words.counts >= least_context)
    parents = np.zeros(len(older), np.int64)
    chains: list[list[int]] = [[0]]  # the nodes from the root to each node
    sequences: list[tuple[int, ...]] = [()]  # symbols of each node, the newest first
    for level in range(1, depth + 1):
        if not len(parents):
            break
        nodes = np.arange(len(tree.kept), len(tree.kept) + len(parents))
        keys = parents * tree.symbols + older
        order = np.argsort(keys)
        tree.levels.append((keys[order], nodes[order]))
        tree.kept = np.concatenate([tree.kept, np.zeros(len(nodes), bool)])
        tree.rest = np.concatenate([tree.rest, np.zeros(len(nodes))])
        for parent, symbol, node in zip(parents.tolist(), older.tolist(), nodes.tolist()):
            chains.append([*chains[parent], node])
            sequences.append((*sequences[parent], symbol))
        shared = spark.sparkContext.broadcast(tree)
        table = stored(
            training.mapInArrow(_pair_counter(shared, words.kind), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n"))
            .withColumn("node", F.expr(f"code div {tree.symbols}L")), "pairs")
        totals = table.groupBy("node").agg(F.sum("n").alias("total")).toArrow()
        named = table.filter(F.col("n") >= least_pair).select("code", "n").toArrow()
        shared.unpersist()
        _add_level(tree, level, chains, totals, named)
        # A longer context is its suffix and one more symbol before it; how often it occurs is
        # how often its newest symbol follows all its older ones.
        code = named.column("code").to_numpy()
        often = named.column("n").to_numpy() >= least_context
        before, symbol = code[often] // tree.symbols, code[often] % tree.symbols
        node_of = {s: i for i, s in enumerate(sequences) if len(s) == level}
        found = []
        for b, s in zip(before.tolist(), symbol.tolist()):
            # After the symbols of node b (newest first) comes s: the sequence s, b's symbols.
            whole = (s, *sequences[b])
            suffix = node_of.get(whole[:-1])
            if suffix is not None and END not in whole[:-1]:
                found.append((suffix, whole[-1]))
        parents = np.array([f[0] for f in found], np.int64)
        older = np.array([f[1] for f in found], np.int64)
    return tree


def _add_level(tree: Tree, level: int, chains: list[list[int]], totals: pa.Table,
               named: pa.Table) -> None:
    """Decides which nodes of the newest level are kept and adds their distributions."""
    total = np.zeros(len(tree.kept))
    total[totals.column("node").to_numpy()] = totals.column("total").to_numpy()
    code, n = named.column("code").to_numpy(), named.column("n").to_numpy().astype(np.float64)
    order = np.argsort(code)
    code, n = code[order], n[order]
    node, symbol = code // tree.symbols, code % tree.symbols
    above = np.array([c + [0] * (level + 1 - len(c)) for c in chains])
    # What the suffix gives each named symbol: the chain of kept nodes without the node itself.
    suffix = _full(tree, node, symbol, [above[:, k] for k in range(1, level)])
    size = len(tree.kept)
    left = total - np.bincount(node, n, size)
    share = (SMOOTHING + left) / (SMOOTHING + np.maximum(total, 1e-9))
    p = (n + (SMOOTHING + left[node]) * 10.0 ** suffix) / (total[node] + SMOOTHING)
    gain = np.bincount(node, n * (np.log(p) - suffix * np.log(10)), size)
    gain += left * np.log(np.maximum(share, 1e-300))
    keep = (total > 0) & (gain > LEAST_GAIN + np.bincount(node, minlength=size))
    new = np.zeros(size, bool)
    new[tree.levels[-1][1]] = True
    keep &= new
    tree.kept |= keep
    tree.rest = np.where(keep, np.log10(share), tree.rest)
    mine = keep[node]
    pairs = np.concatenate([tree.pairs, code[mine]])
    logs = np.concatenate([tree.logs, np.log10(p[mine])])
    order = np.argsort(pairs)
    tree.pairs, tree.logs = pairs[order], logs[order]


def _packed(columns: list[np.ndarray], kinds: list[str]) -> bytes:
    """Columns as planes of equal bytes, which compress where numbers are small or sorted."""
    planes = b"".join(
        np.ascontiguousarray(c.astype(kind)).view(np.uint8).reshape(len(c), -1).T.tobytes()
        for c, kind in zip(columns, kinds))
    codec = pa.Codec("zstd", compression_level=LEVEL)
    return len(columns[0]).to_bytes(8, "little") + codec.compress(planes, asbytes=True)


def _unpacked(parts: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    width = sum(np.dtype(kind).itemsize for kind in kinds)
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for part in parts:
        if not part:
            continue
        n, at = int.from_bytes(part[:8], "little"), 0
        part = pa.decompress(part[8:], n * width, "zstd", asbytes=True)
        for column, kind in zip(columns, kinds):
            size = np.dtype(kind).itemsize
            planes = np.frombuffer(part, np.uint8, n * size, at).reshape(size, n)
            column.append(np.ascontiguousarray(planes.T).view(kind).ravel())
            at += n * size
    return [np.concatenate(c) if c else np.zeros(0, kind) for c, kind in zip(columns, kinds)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _marked(words: DataFrame) -> DataFrame:
    """cell, bits: words by their symbols; words that share a bit are marked together."""
    return (
        words.select(_slot().alias("slot")).groupBy(F.expr("slot div 64").alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits"))
    )


def _slot() -> Column:
    return (F.crc32("word") % (RARE - 1) + RARE) % (64 * CELLS)


def _bits(marked: DataFrame) -> np.ndarray:
    rows = marked.toArrow()
    bits = np.zeros(CELLS, np.int64)
    bits[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return bits


def _dealer(shared, buckets: int, depth: int):
    """Positions behind the hot contexts, dealt by the shortest context that is not hot.

    Sums over all other positions of a text go along once.
    """
    def dealt(numbers, packed, texts):
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(packed, pa.binary()),
             pa.array(texts, pa.binary())], names=["bucket", "positions", "texts"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tree, frequent = shared.value
        base_log = np.log10((words.counts + 0.1) / words.base_total)
        # Contexts through a newest word that is too rare are not looked at.
        enough = words.counts >= LEAST_CONTEXT
        enough[OTHER] = True
        for (rows, held, rare), ids, start, text in _blocks(
                batches, ["row", "held_out", "rare"], words.kind):
            rows = rows.to_numpy()
            trained = ~held.to_numpy(zero_copy_only=False)
            ids = ids.astype(np.int64)
            other, own = ids == OTHER, ids.copy()
            number = np.array(
                [RARE + crc32(w) % (RARE - 1) for w in rare.flatten().to_pylist()], np.int64)
            slot = number % (64 * CELLS)
            own[other] = np.where(frequent[slot >> 6] >> (slot & 63) & 1, number, NOTHING)
            past = _past(own, start, depth)
            logs, hot = tree.score(past, ids)
            newest = past[0]
            cold = (hot < depth) & enough[np.where(newest < RARE, newest, OTHER)]
            cold &= newest != NOTHING
            key = np.zeros(len(ids), np.uint64)
            for k, symbol in enumerate(past):
                cold &= (hot != k) | (symbol != NOTHING)
                key = np.where(hot >= k, _mixed(key + symbol.astype(np.uint64) + np.uint64(1)), key)
            m = len(rows)
            sums = _packed(
                [rows, np.bincount(text, ~other & (words.counts[ids] > 0), m),
                 np.bincount(text, other, m), np.bincount(text, np.where(other, 0.0, base_log[ids]), m),
                 np.bincount(text, np.where(cold, 0.0, logs), m)], TEXT_SUM)
            at = np.flatnonzero(cold)
            bucket = (key[at] % np.uint64(buckets)).astype(np.int64)
            # Sorted columns are packed best; the symbols of rare words are the widest.
            order = np.lexsort((past[1][at], newest[at], bucket))
            at, bucket = at[order], bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            numbers, packed, texts, size = [int(rows[0] % buckets)], [b""], [sums], 0
            for low, high in zip(edges, edges[1:]):
                part = at[low:high]
                which, index = np.unique(text[part], return_inverse=True)
                numbers.append(int(bucket[low]))
                packed.append(
                    len(block := _packed([rows[which], trained[which]], BLOCK_ROW))
                    .to_bytes(8, "little") + block
                    + _packed([*[p[part] for p in past], ids[part], index], POSITION))
                texts.append(b"")
                size += len(packed[-1])
                if size > BATCH_BYTES:
                    yield dealt(numbers, packed, texts)
                    numbers, packed, texts, size = [], [], [], 0
            if numbers:
                yield dealt(numbers, packed, texts)

    return deal


def _received(parts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns of positions, their rows, and whether these are for training."""
    positions, rows, trained = [], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for part in parts:
        stop = 8 + int.from_bytes(part[:8], "little")
        row, training = _unpacked([part[8:stop]], BLOCK_ROW)
        *columns, index = _unpacked([part[stop:]], POSITION)
        positions.append(columns)
        rows.append(row[index])
        trained.append(training[index].astype(bool))
    columns = [np.concatenate([p[k] for p in positions]).astype(np.int64) if positions
               else np.zeros(0, np.int64) for k in range(DEPTH + 1)]
    return columns, np.concatenate(rows), np.concatenate(trained)


def _branches(past: list[np.ndarray], symbol: np.ndarray, logs: np.ndarray, trained: np.ndarray,
              hot: np.ndarray) -> np.ndarray:
    """log10 of each position in its longest kept suffix, from all positions of the branches."""
    logs = logs.copy()
    active = np.arange(len(symbol))
    group = np.zeros(len(symbol), np.int64)
    for level, older in enumerate(past, 1):
        use = older[active] != NOTHING
        active, group = active[use], group[use]
        if not len(active):
            break
        _, group = np.unique(group << 32 | older[active], return_inverse=True)
        total = np.bincount(group, trained[active])
        # Up to the level of its hot contexts a branch is only told apart.
        known = hot[active] >= level
        use = known | (total[group] >= LEAST_CONTEXT)
        active, group, known = active[use], group[use], known[use]
        _, first, pair = np.unique(
            group << 32 | symbol[active], return_index=True, return_inverse=True)
        n = np.bincount(pair, trained[active])
        of, before = group[first], logs[active[first]]
        p = (n + SMOOTHING * 10.0 ** before) / (total[of] + SMOOTHING)
        gain = np.bincount(of, n * (np.log(p) - before * np.log(10)), len(total))
        keep = gain > LEAST_GAIN + np.bincount(of, n > 0, len(total))
        better = keep[group] & ~known
        logs[active[better]] = np.log10(p)[pair[better]]
    return logs


def _bucket_scorer(shared, parts: int):
    """Sums by row over the positions of a bucket, and those that came along, by part of the rows."""
    def score(table: pa.Table) -> pa.Table:
        tree = shared.value[1]
        (*past, symbol), row, trained = _received(
            [p for p in table.column("positions").to_pylist() if p])
        logs, hot = tree.score(past, symbol)
        logs = _branches(past, symbol, logs, trained, hot)
        rows, of = np.unique(row, return_inverse=True)
        texts = _unpacked([t for t in table.column("texts").to_pylist() if t], TEXT_SUM)
        found: dict[int, list[bytes]] = {}
        for place, columns, kinds in (
                (0, [rows, np.bincount(of, logs, len(rows))], POSITION_SUM), (1, texts, TEXT_SUM)):
            part = (_mixed(columns[0].astype(np.uint64) + np.uint64(1))
                    % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
            for low, high in zip(edges, edges[1:]):
                own = order[low:high]
                found.setdefault(int(part[own[0]]), [b"", b""])[place] = _packed(
                    [c[own] for c in columns], kinds)
        return pa.table({
            "part": pa.array(list(found), pa.int64()),
            "positions": pa.array([f[0] for f in found.values()], pa.binary()),
            "texts": pa.array([f[1] for f in found.values()], pa.binary())})

    return score


def _sum_part(table: pa.Table) -> pa.Table:
    """All sums of the rows of a part."""
    rows, known, rare, base, rest = _unpacked(table.column("texts").to_pylist(), TEXT_SUM)
    order = np.argsort(rows)
    rows = rows[order]
    row, logs = _unpacked(table.column("positions").to_pylist(), POSITION_SUM)
    return pa.table({
        "row": rows, "n_known": known[order], "n_rare": rare[order], "base": base[order],
        "tree": rest[order] + np.bincount(np.searchsorted(rows, row), logs, len(rows))})


def scores(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document: token counts, the base score and the tree's score.

    Contexts have at most `depth` words, which may be up to `DEPTH`.
    """
    spark = docs.sparkSession
    counts = word_counts(docs)
    words = known_words(counts)
    shared = spark.sparkContext.broadcast(words)
    encoded = stored(
        _texts(docs).mapInArrow(_encoder(shared), ENCODED), "encoded", compression="zstd")
    tree = grow(encoded, words, depth)
    rare_words = counts.filter((F.col("c") < words.least_known) & (F.length("word") > 0))
    # Marks bound work only: positions after rarer words need not be dealt, as no context holds these.
    frequent = _bits(_marked(rare_words.filter(F.col("c") >= LEAST_CONTEXT)))
    model = spark.sparkContext.broadcast((replace(words, ids={}), tree, frequent))
    buckets = 1 + (encoded.agg(F.sum("n_tokens")).first()[0] or 0) // BUCKET_TOKENS
    scored = (
        encoded.select("row", "held_out", "ids", "rare")
        .mapInArrow(_dealer(model, buckets, depth), DEALT)
        .groupBy("bucket").applyInArrow(_bucket_scorer(model, buckets), SUMS)
        .groupBy("part").applyInArrow(_sum_part, SCORED)
    )
    # A rare word of a training text occurs once if nothing else is said. Words that occur once are
    # shuffled only if they may stand in a held-out text; the cells are few, whatever the input.
    tokens = encoded.select("row", "held_out", F.explode("rare").alias("word"))
    asked = F.broadcast(_marked(tokens.filter("held_out")))
    told = (
        rare_words.withColumn("slot", _slot()).withColumn("cell", F.expr("slot div 64"))
        .join(asked, "cell", "left")
        .filter("c > 1 or shiftright(bits, int(slot % 64)) & 1 = 1").select("word", "c")
    )
    count = F.coalesce("c", F.when(F.col("held_out"), 0).otherwise(1))
    rare = (
        tokens.join(told, "word", "left").groupBy("row").agg(
            F.sum(F.log10(count + F.lit(0.1))).alias("rare_logs"),
            F.sum((count > 0).cast("long")).alias("rare_known"))
    )
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return (
        encoded.select("row", "doc_id", "held_out", "n_tokens").join(scored, "row")
        .join(rare, "row", "left").select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(words.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + logs - F.col("n_rare") * float(np.log10(words.base_total)))
            .alias("base_score"),
            (F.col("tree") + logs - F.col("n_rare") * float(np.log10(words.outside)))
            .alias("score"))
    )
