"""Repetition coverage: characters inside duplicated n-grams and lines, by rolling hashes in numpy.

Words of a block of texts become numbers; an n-gram's hash is rolled from the numbers of its words,
for all texts of the block at once. An n-gram is duplicated if its hash occurs again in the same
text. A character counts once however many duplicated n-grams cover its word. Windows never cross
texts. The base counts use exact codes instead of hashes.

Cases: a null text has no words and counts like the empty text; a text of any length is processed
whole, in a block of its own if long; repeated rows are judged each for itself; an empty table gives
no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import long_id

# Largest share of a text's word characters that duplicated n-grams may cover, by n.
# The published repetition thresholds for n-grams of 5 to 10 words.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# The same for lines that equal an earlier line.
LINE_COVERAGE = 0.20
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BLOCK_CHARS = 4_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, "
    + ", ".join(f"dup_{n}_share double" for n in COVERAGE)
)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread small numbers over 64 bits (a bijection, so different words stay different)."""
    x = (x.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _repeated(doc: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each window whether the same code occurs twice or more in its text."""
    order = np.lexsort((code, doc))
    d, c = doc[order], code[order]
    same = (d[1:] == d[:-1]) & (c[1:] == c[:-1])
    hit = np.zeros(len(code), bool)
    hit[:-1] = same
    hit[1:] |= same
    out = np.empty(len(code), bool)
    out[order] = hit
    return out


def _covered(repeated: np.ndarray, start: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside any repeated window of n words."""
    edge = np.zeros(words + 1, np.int32)
    np.add.at(edge, start[repeated], 1)
    np.add.at(edge, start[repeated] + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """Counts and coverage of each text of a block."""
    m = len(texts)
    ids: dict[bytes, int] = {}
    numbers: list[int] = []
    lengths: list[int] = []
    counts = np.zeros(m, np.int64)
    symbols = np.zeros(m, np.int64)
    dup_lines = np.zeros(m, np.int64)
    dup_line_chars = np.zeros(m, np.int64)
    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").split()
        counts[i] = len(words)
        numbers.extend([ids.setdefault(w, len(ids)) for w in words])
        symbols[i] = sum(map(text.count, SYMBOLS))
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                inside = line.encode("utf-8", "surrogatepass").split()
                if inside:
                    dup_lines[i] += 1
                    dup_line_chars[i] += sum(len(w.decode("utf-8", "surrogatepass"))
                                             for w in inside)
            else:
                seen.add(line)
    width = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in ids), np.int64, len(ids))
    word = np.asarray(numbers, np.int64)
    total = len(word)
    doc = np.repeat(np.arange(m), counts)
    ends = np.cumsum(counts)
    chars = width[word] if total else np.zeros(0, np.int64)
    word_chars = np.bincount(doc, chars, m).astype(np.int64)
    out = {"n_words": counts, "word_chars": word_chars, "n_symbols": symbols,
           "n_dup_lines": dup_lines}
    left = ends[doc] - np.arange(total)  # words from here to the end of the text
    vocabulary = max(1, len(ids))
    if total:
        start = np.flatnonzero(left >= 3)
        pair = word[start] * vocabulary + word[start + 1]
        # An exact code of three words: pairs are numbered first if the product could overflow.
        if vocabulary > 2_000_000:
            pair = np.unique(pair, return_inverse=True)[1]
        code = pair * vocabulary + word[start + 2]
        inside = _covered(_repeated(doc[start], code), start, 3, total)
        out["n_repeat_words"] = np.bincount(doc, inside, m).astype(np.int64)
    else:
        out["n_repeat_words"] = np.zeros(m, np.int64)
    share = np.maximum(word_chars, 1)
    out["dup_line_share"] = dup_line_chars / share
    mixed = _mix(word)
    rolled = mixed.copy()
    for n in range(2, max(COVERAGE) + 1):
        # rolled[i] covers words i .. i+n-1
        rolled = rolled[: max(0, total - n + 1)] * MULTIPLIER + mixed[n - 1:]
        if n in COVERAGE:
            start = np.flatnonzero(left >= n)
            inside = _covered(_repeated(doc[start], rolled[start]), start, n, total)
            out[f"dup_{n}_share"] = np.bincount(doc, chars * inside, m) / share
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Blocks of rows of bounded text size; a longer text is a block of its own."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            if texts and size + len(text) > BLOCK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(key.as_py())
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _blocks(batches):
        found = measure(texts)
        failed = (found["n_words"] < MIN_WORDS) | (
            100 * found["n_repeat_words"] > 50 * found["n_words"])
        kept = ~failed & (found["dup_line_share"] <= LINE_COVERAGE)
        for n, most in COVERAGE.items():
            kept &= found[f"dup_{n}_share"] <= most
        columns = {"doc_id": pa.array(ids, pa.int64())}
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            columns[name] = pa.array(found[name])
        columns |= {"base_failed": pa.array(failed), "kept": pa.array(kept)}
        for name in ("dup_line_share", *(f"dup_{n}_share" for n in COVERAGE)):
            columns[name] = pa.array(np.asarray(found[name], np.float64))
        yield pa.RecordBatch.from_pydict(columns)


def repetition(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, coverage shares and the verdict. No shuffle."""
    return docs.select(long_id(), F.col("text").cast("string").alias("text")).mapInArrow(
        _judge, SCHEMA)
