import math
import zlib
from collections import Counter

import pytest

from threadloom.llm import suffix_tree as st
from threadloom.llm.common import words_of


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0


def check_base(docs):
    rows = [(r.doc_id, words_of(r.text) + [b""]) for r in docs.select("doc_id", "text").collect()]
    counts = Counter(w for key, own in rows if not held_out(key) for w in own)
    total, distinct = sum(counts.values()), len(counts)
    wanted = sorted(
        (str(key), held_out(key), len(own), sum(counts[w] > 0 for w in own), total,
         round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own), 5)
         + 0.0) for key, own in rows)
    found = st.scores(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 5) + 0.0) for r in found) == wanted
    return found


def test_base_is_exact_and_contexts_help_held_out_texts(test_documents):
    rows = [r for r in check_base(test_documents) if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_longer_contexts_are_learnt(documents):
    """A word follows from the two before it, which one word alone does not tell."""
    rows = []
    for i in range(600):
        a, b = "ab"[i % 2], "xy"[i // 2 % 2]
        rows.append((i, " ".join(f"{a} {b} {a}{b}" for _ in range(12))))
    docs = documents(*rows)

    def mean(depth):
        found = [r for r in st.scores(docs, depth).collect() if r.held_out]
        return sum(r.score for r in found) / sum(r.n_tokens for r in found)

    one, two, three = mean(1), mean(2), mean(3)
    assert two > one + 0.05 and three >= two - 1e-6


class PlainTree:
    """The same tree held whole in dictionaries; words below a count are one symbol after contexts."""

    def __init__(self, rows, least_known=1):
        texts = [words_of(text) + [b""] for key, text in rows if not held_out(key)]
        self.words = Counter(w for own in texts for w in own)
        self.known = {w for w, c in self.words.items() if c >= least_known or not w}
        others = [c for w, c in self.words.items() if w not in self.known]
        self.outside = sum(others) + 0.1 * (len(others) + 1)
        self.norm = sum(self.words.values()) + 0.1 * (len(self.words) + 1)
        self.after = {}
        for own in texts:
            for context, word in self.places(own):
                for k in range(1, len(context) + 1):
                    self.after.setdefault(context[:k], Counter())[self.symbol(word)] += 1
        self.kept = set()
        for context in sorted(self.after, key=len):
            counts = self.after[context]
            if counts.total() < st.LEAST_CONTEXT:
                continue
            gain = sum(n * math.log(self.given(context, w) / self.chance(context[:-1], w))
                       for w, n in counts.items())
            if gain > st.LEAST_GAIN + len(counts):
                self.kept.add(context)

    def symbol(self, word):
        return word if word in self.known else None

    @staticmethod
    def places(own):
        """Up to three words before each word, the newest first; an end precedes a text."""
        for i, word in enumerate(own):
            yield tuple(([b""] + own)[max(0, i + 1 - st.DEPTH):i + 1][::-1]), word

    def given(self, context, word):
        counts = self.after[context]
        return ((counts[word] + st.SMOOTHING * self.chance(context[:-1], word))
                / (counts.total() + st.SMOOTHING))

    def chance(self, context, word):
        if not context:
            return (self.outside if word is None else self.words[word] + 0.1) / self.norm
        return self.given(context, word) if context in self.kept else self.chance(context[:-1], word)

    def score(self, text):
        total = 0.0
        for context, word in self.places(words_of(text) + [b""]):
            total += math.log10(self.chance(context, self.symbol(word)))
            if word not in self.known:
                total += math.log10((self.words[word] + 0.1) / self.outside)
        return total


def check_scores(docs, least_known=1):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    plain = PlainTree(rows, least_known)
    wanted = sorted((str(key), plain.score(text)) for key, text in rows)
    found = sorted((str(r.doc_id), r.score) for r in st.scores(docs).collect())
    assert [key for key, _ in found] == [key for key, _ in wanted]
    assert [s for _, s in found] == pytest.approx([s for _, s in wanted], rel=1e-5)
    return plain


@pytest.mark.parametrize("hot_share", [2.0, 5e-3])
def test_scores_equal_those_of_a_plain_tree(test_documents, monkeypatch, hot_share):
    """With no context hot, and with those of a two-hundredth of all tokens."""
    monkeypatch.setattr(st, "HOT_SHARE", hot_share)
    monkeypatch.setattr(st, "MOST_COLD_SHARE", hot_share)
    plain = check_scores(test_documents)
    assert {len(c) for c in plain.kept} >= {1, 2}


@pytest.mark.parametrize("hot_share", [2.0, 2e-2])
def test_words_unknown_to_the_tasks_stand_in_contexts(test_documents, monkeypatch, hot_share):
    monkeypatch.setattr(st, "HOT_SHARE", hot_share)
    monkeypatch.setattr(st, "MOST_COLD_SHARE", hot_share)
    monkeypatch.setattr(st, "KNOWN_SHARE", 2e-3)
    monkeypatch.setattr(st, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(st, "BUCKET_TOKENS", 4000)
    least = st.known_words(st.word_counts(test_documents)).least_known
    assert least > st.LEAST_CONTEXT
    plain = check_scores(test_documents, least)
    assert any(plain.words[context[0]] < least for context in plain.kept)


def test_distributions_sum_to_one(test_documents):
    rows = [(r.doc_id, r.text) for r in test_documents.select("doc_id", "text").collect()]
    plain = PlainTree(rows)
    assert len(plain.kept) > 3
    for context in sorted(plain.kept)[:40]:
        total = sum(plain.chance(context, w) for w in plain.words)
        unseen = plain.chance(context, None)
        assert total + unseen == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("filler", [500, 10_000])
def test_a_context_seen_thirty_times_is_learnt_in_a_table_of_any_size(documents, filler):
    rows = [(i, f"zeta eta theta {i}") for i in range(34)]
    rows += [(1000 + i, " ".join(f"w{(i * 7 + j * j) % 5000}" for j in range(60)))
             for i in range(filler)]
    found = [r for r in st.scores(documents(*rows)).collect() if r.doc_id < 34 and r.held_out]
    assert found
    for r in found:
        assert r.score > r.base_score + 4


def test_low_bounds_leave_base_scores_unchanged(test_documents, monkeypatch):
    """Most words are left to the join when few may be known."""
    monkeypatch.setattr(st, "KNOWN_SHARE", 1e-3)
    monkeypatch.setattr(st, "HELD_COUNTS", 500)
    monkeypatch.setattr(st, "BLOCK_TOKENS", 1000)
    check_base(test_documents)


def test_odd_rows(documents, odd_rows):
    rows = check_base(documents(*odd_rows))
    assert all(math.isfinite(r.score) for r in rows)


def test_no_training_rows(documents):
    key = next(i for i in range(1000) if held_out(i))
    rows = check_base(documents((key, "a b"), (None, None)))
    assert all(r.train_tokens == 0 and math.isfinite(r.score) for r in rows)


def test_empty_table(documents):
    assert st.scores(documents().filter("false")).collect() == []


def test_encoded_texts_are_stored_once_and_packed(spark, monkeypatch):
    """Symbols of rare words, which follow from the words, were stored beside them."""
    kept = {}
    real = st.stored

    def stored(df, name, **options):
        kept[name] = (df.columns, options.get("compression"))
        return real(df, name, **options)

    monkeypatch.setattr(st, "stored", stored)
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert st.scores(docs).count() == 2
    assert kept["encoded"] == (["row", "doc_id", "held_out", "n_tokens", "ids", "rare"], "zstd")
