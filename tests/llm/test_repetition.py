import random
import re

import numpy as np

from threadloom.llm import repetition as rp

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """All columns from their definitions."""
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))

    def inside(n):
        seen = {}
        for i in range(len(words) - n + 1):
            seen.setdefault(tuple(words[i:i + n]), []).append(i)
        return {k for starts in seen.values() if len(starts) > 1 for s in starts
                for k in range(s, s + n)}

    lines, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if line in lines and WORD.search(line):
            dup += 1
            dup_chars += sum(map(len, WORD.findall(line)))
        lines.add(line)
    repeat = len(inside(3))
    shares = {n: sum(len(words[k]) for k in inside(n)) / max(1, chars) for n in rp.COVERAGE}
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    line_share = dup_chars / max(1, chars)
    kept = (not failed and line_share <= rp.LINE_COVERAGE
            and all(shares[n] <= most for n, most in rp.COVERAGE.items()))
    return (len(words), chars, sum(c in rp.SYMBOLS for c in text), dup, repeat, failed, kept,
            round(line_share, 9), *(round(s, 9) for s in shares.values()))


def check(docs):
    wanted = sorted((str(r.doc_id), *plain(r.text)) for r in docs.collect())
    found = sorted((str(r[0]), *(round(v, 9) if isinstance(v, float) else v for v in r[1:]))
                   for r in rp.repetition(docs).collect())
    assert found == wanted


def test_equals_definitions(test_documents):
    check(test_documents)


def test_repeated_passages(documents):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        words = [f"{rng.choice('abc')}{rng.randrange(rng.choice([5, 60, 5000]))}é|" for _ in range(
            rng.randint(0, 200))]
        if words and i % 2:
            at, n = rng.randrange(len(words)), rng.randint(1, 30)
            words += words[at:at + n] + ["\n"] + words[at:at + n] + ["\n"] + words[at:at + n]
        rows.append((i, " ".join(words)))
    check(documents(*rows))


def test_windows_do_not_cross_texts(documents):
    check(documents((1, "a b"), (2, "c d"), (3, "a b"), (4, "c d a b c d a b")))


def test_many_words_use_exact_codes(monkeypatch):
    texts = [" ".join(f"w{i * 7919 % 3001}" for i in range(4000)), "a b c a b c"]
    few = rp.measure(texts)
    assert few["n_repeat_words"].tolist() == [plain(t)[4] for t in texts]


def test_odd_rows(documents, odd_rows, monkeypatch):
    check(documents(*odd_rows))


def test_empty_table(documents):
    assert rp.repetition(documents().filter("false")).collect() == []
    assert rp.measure([""])["word_chars"].tolist() == [0]
    assert np.isfinite(rp.measure(["", ""])["dup_5_share"]).all()
