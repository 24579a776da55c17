import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from threadloom.llm import cutting_stock, encoding, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  ", "A", "<|endoftext|> x", "don't won'T it's 's. I'LL", " a", "a ", "a  b", "a\n\nb",
       "a\nb c\n'd e", "a \nb", "a\n b", "\n", "x y z\x1cq\x85r", "日本語。漢字 😀 é",
       "ab12.5,3%%% ##$$", "\x00\x07 tab\tnew\r\nline\x0b\x0c", "a\xa0b", " x Ġ Ċ y"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library_on_texts(plain):
    rng = random.Random(2)
    letters = "aA.,<|é' ss \n tIİ12%日̸  "
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30)))
                   for _ in range(3000)]
    encoder = encoding.ByteEncoder(PATH)
    assert encoder.fast
    for text in [*texts, "x" * 30_000, " " * 30_000, "a\n\n" * 9_000]:
        assert encoder.encode(text).tolist() == plain(text)


def test_encoder_equals_the_library_on_code_points(plain):
    """Every code point of the first plane and one in sixteen beyond, between letters and signs."""
    encoder = encoding.ByteEncoder(PATH)
    points = [c for c in (*range(0x10000), *range(0x10000, 0x110000, 16))
              if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 2_000):
        text = "|".join(f"a{chr(c)}1 {chr(c)}! {chr(c)}{chr(c)}'s" for c in points[at:at + 2_000])
        assert encoder.encode(text).tolist() == plain(text)


def checked(histogram, capacity):
    plan = cutting_stock.plan(histogram, capacity)
    held = defaultdict(int)
    for pattern, times in plan:
        assert times > 0 and sum(k * n for k, n in pattern.items()) <= capacity
        for k, n in pattern.items():
            held[k] += n * times
    assert held == {k: n for k, n in histogram.items() if n}
    return plan


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 40)))
def test_plan_holds_every_piece_once(histogram):
    checked(histogram, 32)


def fewest(lengths, capacity):
    """Brute force: the least number of sequences that hold the pieces."""
    best = len(lengths)

    def put(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for at in range(len(bins)):
            if bins[at] + rest[0] <= capacity and bins[at] not in bins[:at]:
                put(rest[1:], [*bins[:at], bins[at] + rest[0], *bins[at + 1:]])
        put(rest[1:], [*bins, rest[0]])

    put(sorted(lengths, reverse=True), [])
    return best


def test_plan_is_near_the_fewest_sequences():
    rng = random.Random(3)
    for _ in range(25):
        # Odd capacity and lengths over four: no total but 8 and 16 escapes padding.
        lengths = [rng.randint(5, 23) for _ in range(rng.randint(1, 10))]
        histogram = {k: lengths.count(k) for k in lengths}
        used = sum(times for _, times in checked(histogram, 23))
        assert used <= fewest(lengths, 23) + 1


def test_columns_improve_on_the_first_plan():
    lengths, capacity = np.array([20, 34, 51]), 100
    demand = np.array([97.0, 395.0, 610.0])
    costs = cutting_stock._costs(capacity)
    values = {}
    for name, (patterns, used) in {
        "start": cutting_stock._start(lengths, demand, capacity),
        "solved": cutting_stock.solve(lengths, demand, capacity),
    }.items():
        assert np.allclose(patterns.T @ used, demand)
        values[name] = float(used @ costs[(patterns @ lengths).astype(int)])
    assert values["solved"] <= values["start"]


def test_padding_is_small_on_many_pieces():
    rng = np.random.default_rng(4)
    lengths, counts = np.unique(rng.integers(1, 1024, 30_000), return_counts=True)
    plan = checked(dict(zip(lengths.tolist(), counts.tolist())), 1024)
    totals = [(sum(k * n for k, n in p.items()), t) for p, t in plan]
    size = sum(cutting_stock.padded(total, 1024) * t for total, t in totals)
    assert sum(total * t for total, t in totals) > 0.99 * size


def check(rows, docs, plain):
    result = packing.op13(docs, PATH).collect()
    wanted = sorted((r[0] is not None, r[0] or 0, tuple([*plain(r[1]), 0])) for r in rows)
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in result:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_document[r.doc_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    pieces = []
    for known, key, ids in wanted:
        for start in range(0, len(ids), packing.CAPACITY):
            part = ids[start:start + packing.CAPACITY]
            pieces.append((key if known else None, start, len(part),
                           zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted(map(str, pieces)) == sorted(str(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)) for r in result)


def test_given_documents(test_documents, plain):
    check([(r.doc_id, r.text) for r in test_documents.collect()], test_documents, plain)


def test_odd_rows(documents, odd_rows, plain):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)] + [(99, "same text")] * 700
    check(rows, documents(*rows), plain)


def test_sequences_hold_the_ids_of_their_pieces(documents, odd_rows, plain):
    cut = packing.pieces(documents(*odd_rows), PATH)
    packed = packing.pack(cut)
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u2") for r in
           packing.sequences(cut, packed).collect()}
    for r in packed.collect():
        own = ids[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(own.astype("<u4").tobytes()) == r.ids_crc32
    assert sum(map(len, ids.values())) == sum(len(plain(r[1])) + 1 for r in odd_rows)


def test_empty_table(documents):
    assert packing.op13(documents().filter("false"), PATH).collect() == []
