"""Phrases by external stream estimation: sorted count streams that are joined by merging.

For every number of words there is one stream of counts, (language, words, count). Phrases are
counted level by level: one of k words can be frequent only if both of its parts of k - 1 words are,
so each pass over the texts counts only windows that may still be frequent. What may be is told by a
bitmap of fixed size over the frequent phrases of the level before; a clash lets a window through to
the count, never keeps one out. Counts are summed within a task before they are shuffled.

The streams are then joined in order, as sort-merge joins, never by hash tables: in prefix order a
phrase meets the count of its first words (left) and the phrases that extend it to the right, in
suffix order that of its last words (right) and the extensions to the left. All arithmetic is exact.

Cases: a null text is empty; a null language is `und`, the same as a language of that name; texts of
any length are read whole; repeated rows count each for itself; an empty table gives no rows; columns
other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.llm.common import stored

LONGEST = 3
MIN_COUNT = 10
# A longer phrase with this share (in per cent) of the count replaces the phrases inside it.
CONTAINED = 50
MOST_PER_LANGUAGE = 2000
UNKNOWN = "und"
SCALE = 1_000_000

# Bits of the map of frequent phrases. It takes 8 MB at most and bounds work, not results.
BITS = 26
WORDS_A_RUN = 1_000_000
CUTS = b".,;:!?\n\x0b\x0c\r"
# A-Z become small, what cuts becomes a line feed, a tab a space.
BYTES = bytes(10 if b in CUTS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
              for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _words(k: int) -> list[str]:
    return [f"w{i}" for i in range(1, k + 1)]


class _Numbers(dict):
    """Words of a run as numbers; 0 and 1 stand for nothing and for a cut."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _hashes(language: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(language.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _slots(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """Places in the bitmap of phrases, given the hashes of their words."""
    total = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        total = (total ^ part) * _MULTIPLIER
        total ^= total >> np.uint64(29)
    return (total >> np.uint64(64 - bits)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], words_a_run: int):
    """(language, words, numbers of the words in order with 1 for every cut), of bounded size."""
    held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for language, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            language = language.as_py()
            if language not in held:
                held[language] = (_Numbers({b"": 0, b"\n": 1}), [])
                sizes[language] = 0
            numbers, runs = held[language]
            raw = text.encode("utf-8", "surrogatepass").translate(BYTES)
            tokens = raw.replace(b"\n", b" \n ").split(b" ")
            tokens.append(b"\n")
            codes = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
            runs.append(codes[codes > 0])
            sizes[language] += len(tokens)
            if sum(sizes.values()) > words_a_run:
                yield from _flush(held)
                held, sizes = {}, {}
    yield from _flush(held)


def _flush(held):
    for language, (numbers, runs) in held.items():
        yield language, list(numbers), np.concatenate(runs)


def _keys(columns: list[np.ndarray], values: int) -> np.ndarray:
    """One whole number for each row of numbers below `values`, equal for equal rows."""
    keys, size = columns[0].astype(np.int64), values
    for column in columns[1:]:
        if size * values >= 1 << 62:
            known, keys = np.unique(keys, return_inverse=True)
            size = len(known)
        keys = keys * values + column
        size *= values
    return keys


def _counter(k: int, marks: np.ndarray | None, bits: int, words_a_run: int):
    """Counts of windows of k words whose parts of k - 1 words are marked, per run of a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, words, codes in _runs(batches, words_a_run):
            if marks is None:
                at = codes[codes > 1]
                n = np.bincount(at, minlength=len(words))
                found = [np.flatnonzero(n)]
                n = n[found[0]]
            else:
                hashes = _hashes(language, words)
                # Whether the window of k - 1 words that begins at each place is marked.
                width = len(codes) - (k - 2)
                if width < 2:
                    continue
                slots = _slots([hashes[codes[i:i + width]] for i in range(k - 1)], bits)
                marked = (marks[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).view(bool)
                for i in range(k - 1):
                    marked &= codes[i:i + width] > 1
                start = np.flatnonzero(marked[:-1] & marked[1:])
                if not len(start):
                    continue
                keys = _keys([codes[start + i] for i in range(k)], len(words))
                _, first, n = np.unique(keys, return_index=True, return_counts=True)
                found = [codes[start[first] + i] for i in range(k)]
            all_words = pa.array(words, pa.binary())
            end = b"\n" + language.encode("utf-8", "surrogatepass")
            for at in range(0, len(n), 100_000):
                some = slice(at, at + 100_000)
                columns = [pc.take(all_words, pa.array(f[some])) for f in found]
                words_of_each = pc.binary_join_element_wise(*columns, b" ")
                yield pa.RecordBatch.from_arrays(
                    [pc.binary_join_element_wise(words_of_each, end, b"").cast(pa.string()),
                     pa.array(n[some].astype(np.int64))], names=["phrase", "n"])

    return count


def _marker(k: int, bits: int):
    """Place in the bitmap of each phrase: the number of a 64-bit word and a bit of it."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            seeds = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))
                     for x in set(languages)}
            parts = [np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seeds[x])
                               for x, w in zip(languages, batch.column(name).to_pylist())],
                              np.uint64) for name in _words(k)]
            slots = _slots(parts, bits)
            bit = (np.uint64(1) << (slots & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots >> 6), pa.array(bit)],
                                             names=["place", "bit"])

    return mark


def _marks(stream: DataFrame, k: int, bits: int) -> np.ndarray:
    """The bitmap in bytes; at most 2**bits / 64 rows reach the driver."""
    rows = (stream.select("lang", *_words(k)).mapInArrow(_marker(k, bits), "place long, bit long")
            .groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros((1 << bits) // 64, np.int64)
    words[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return words.view(np.uint8)


def streams(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, bits: int = BITS,
            words_a_run: int = WORDS_A_RUN) -> tuple[DataFrame, dict[int, DataFrame]]:
    """All words per language, and the stored count stream of frequent phrases of 1 .. `longest` words.

    A stream has columns lang, w1 .. wk, a.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col("text").cast("string").alias("text"))
    found, totals, marks = {}, None, None
    for k in range(1, longest + 1):
        names = _words(k)
        # One key of the words, a line feed, which no word holds, and the language.
        counts = texts.mapInArrow(_counter(k, marks, bits, words_a_run), "phrase string, n long")
        words = F.split(F.substring_index("phrase", "\n", 1), " ")
        summed = counts.groupBy("phrase").agg(F.sum("n").alias("a")).select(
            F.expr("substr(phrase, instr(phrase, '\n') + 1)").alias("lang"),
            *[words[i].alias(name) for i, name in enumerate(names)], "a")
        if k == 1:
            summed = stored(summed, "words")
            totals = summed.groupBy("lang").agg(F.sum("a").alias("n"))
        found[k] = stored(summed.filter(F.col("a") >= min_count), f"phrases-{k}")
        if k < longest:
            marks = _marks(found[k], k, bits)
    return totals, found


def _part(stream: DataFrame, k: int, at: int, name: str) -> DataFrame:
    """A count stream of k words as the part of a phrase that begins with its word `at`."""
    return stream.select(
        "lang", *[F.col(f"w{i}").alias(f"w{at + i - 1}") for i in range(1, k + 1)],
        F.col("a").alias(name))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of up to 38 digits."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    return F.call_function(
        "div", (a * a).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(7,0)"),
        (left * right).cast("decimal(38,0)"))


def candidates(found: dict[int, DataFrame]) -> DataFrame:
    """Frequent phrases with the counts of their lowest-scoring cut, and their most frequent extension.

    Columns lang, phrase, a, l, r, score and longer (0 if no frequent phrase is longer by a word).
    """
    parts = []
    for k in range(2, max(found) + 1):
        names = _words(k)
        stream = found[k]
        for cut in range(1, k):
            left, right = names[:cut], names[cut:]
            stream = (
                # Prefix order for the first words, suffix order for the rest.
                stream.join(_part(found[cut], cut, 1, f"l{cut}").hint("merge"), ["lang", *left])
                .join(_part(found[k - cut], k - cut, cut + 1, f"r{cut}").hint("merge"),
                      ["lang", *right]))
        if k + 1 in found:
            # The longest count beside each phrase, to the right in prefix order, else in suffix order.
            for at, name in ((1, "to_right"), (2, "to_left")):
                beside = (found[k + 1]
                          .groupBy("lang", *[f"w{i}" for i in range(at, at + k)])
                          .agg(F.max("a").alias(name)))
                beside = beside.select(
                    "lang", *[F.col(f"w{at + i - 1}").alias(f"w{i}") for i in range(1, k + 1)], name)
                stream = stream.join(beside.hint("merge"), ["lang", *names], "left")
            longer = F.coalesce(F.greatest("to_right", "to_left"), F.lit(0))
        else:
            longer = F.lit(0)
        cuts = F.array(*[
            F.struct(_score(F.col("a"), F.col(f"l{cut}"), F.col(f"r{cut}")).alias("score"),
                     F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"),
                     F.col(f"r{cut}").alias("r")) for cut in range(1, k)])
        parts.append(stream.select(
            "lang", F.concat_ws(" ", *names).alias("phrase"), "a",
            F.array_min(cuts).alias("best"), longer.cast("long").alias("longer")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("lang", "phrase", "a", "best.l", "best.r", "best.score", "longer")


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT,
                 most: int = MOST_PER_LANGUAGE, bits: int = BITS,
                 words_a_run: int = WORDS_A_RUN) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase inside a longer candidate leaves if the longer one holds `CONTAINED` per cent of its
    count. It is enough to look at those longer by one word, as any other is inside one of them that
    is as frequent at least.
    """
    totals, found = streams(docs, longest, min_count, bits, words_a_run)
    kept = candidates(found).filter(F.lit(100) * F.col("longer") < F.lit(CONTAINED) * F.col("a"))
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))
