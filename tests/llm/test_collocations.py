import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from threadloom.llm import collocations as co

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, longest=3, least=10, most=2000):
    """The contract, phrase by phrase."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    frequent = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in frequent.items():
        inside = any(
            other != words and other_lang == lang and 100 * b >= 50 * a
            and any(other[i:i + len(words)] == words for i in range(len(other)))
            for (other_lang, other), b in frequent.items() if len(other) > len(words))
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return Counter(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, own in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:most], 1))


def got(frame):
    return Counter(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                   for r in frame.collect())


@pytest.fixture(scope="module")
def texts(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(t, lang, "x", "y", 1) for t, lang in rows],
            "text string, lang string, w1 string, phrase string, a int")

    return build


def test_equals_counting_every_phrase(spark, test_documents):
    rows = [(r.text, r.lang) for r in test_documents.collect()]
    want = plain(rows)
    assert len(want) > 100
    assert got(co.collocations(test_documents)) == want


def test_random_words_with_any_bitmap_and_run(texts):
    rng = random.Random(5)
    rows = [(" ".join(rng.choice("a b c d E f, g. hh ii\tjj;kk\nll \x00m É é".split(" "))
                      for _ in range(rng.randint(0, 60))), rng.choice(["de", None, "und"]))
            for _ in range(200)]
    want = plain(rows, least=3, most=50)
    assert len(want) >= 100
    for bits, run in ((26, 3_000_000), (8, 40)):
        assert got(co.collocations(texts(*rows), min_count=3, most=50, bits=bits,
                                   words_a_run=run)) == want


def test_longer_phrases_and_ties(texts):
    rows = [("new york city hall. new york; york city", "en")] * 10 + [("b a\nd c", "en")] * 12
    for longest in (2, 3, 4):
        want = plain(rows, longest)
        assert got(co.collocations(texts(*rows), longest=longest)) == want
    # Equal scores go by count, then by phrase.
    assert [r.phrase for r in co.collocations(texts(*rows), longest=2).orderBy("rank").collect()][
        :2] == ["b a", "d c"]


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    one = spark.createDataFrame([("en", "x", big), ("en", "y", big + 1)], "lang string, w1 string, a long")
    two = spark.createDataFrame([("en", "x", "y", big - 1)],
                                "lang string, w1 string, w2 string, a long")
    row, = co.candidates({1: one, 2: two}).collect()
    assert int(row.score) == 1_000_000 * (big - 1) ** 2 // (big * (big + 1))


def test_odd_rows(texts, odd_rows):
    rows = [(r[1], r[2]) for r in odd_rows] + [(None, None), ("", None)]
    assert got(co.collocations(texts(*rows))) == plain(rows)


def test_empty_table(texts):
    assert co.collocations(texts()).collect() == []
    assert co.collocations(texts((None, "en"))).collect() == []


def test_keys_of_many_values_stay_apart():
    rng = np.random.default_rng(7)
    columns = [rng.integers(0, 3_000_000, 500) for _ in range(3)]
    columns = [np.append(c, c[:100]).astype(np.int32) for c in columns]
    keys = co._keys(columns, 3_000_000)
    rows = list(zip(*(c.tolist() for c in columns)))
    assert len(set(keys.tolist())) == len(set(rows)) == len(set(zip(keys.tolist(), rows)))
