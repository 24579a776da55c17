import random
import zlib

import numpy as np
import pytest

from threadloom.llm import toxicity as tx


@pytest.fixture(scope="module")
def corpus():
    """Texts of invented words; toxic ones hold words of a bad stem."""
    rng = random.Random(4)
    parts = ["an", "er", "th", "on", "ea", "in", "st", "re"]

    def word():
        return "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))

    rows = []
    for i in range(900):
        words = [word() for _ in range(rng.randint(1, 160))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 50):
                words.insert(rng.randrange(len(words) + 1), "scumb" + rng.choice(parts))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, corpus):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t, _ in corpus],
                                 "doc_id long, text string, toxic int, score string")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in corpus[:800]] + [(1, 0, None)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(tables, corpus):
    rows = tx.op9(*tables).collect()
    label = {i: y for i, _, y in corpus}
    assert sorted(r.doc_id for r in rows) == sorted(label)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    apart = [r for r in rows if r.held_out]
    toxic = [r.predicted for r in apart if label[r.doc_id]]
    clean = [r.predicted for r in apart if not label[r.doc_id]]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.03


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(tx, "GRAMS", 64)
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tx.initial(5).items()}
    word = np.array([0, 1, 2, 5, 3])
    gram, count = np.array([1, 5, 5, 9, 1, 3, 3]), np.array([2, 0, 1, 3, 1])
    prior = rng.normal(size=(5, tx.PRIOR_DIM))
    x = rng.integers(0, 5, (6, 4))
    mask = np.arange(6)[:, None] < np.array([6, 3, 1, 5])
    target = np.array([1.0, 0, 1, 0])
    shown = np.ones((5, 1))

    def features():
        mean = tx._per_word(p["gram"][gram], count, np.add) / np.maximum(count, 1)[:, None]
        return np.concatenate([p["word"][word], mean, prior], axis=1)

    def loss():
        z = tx.logits(p, *tx._project(p, features()), x, mask)
        s = tx._sigmoid(z)
        return -np.mean(target * np.log(s) + (1 - target) * np.log(1 - s))

    f = features()
    grads = tx._gradients(p, f, (gram, count), word, shown, *tx._project(p, f), x, mask, target)
    for name, g in grads.items():
        flat = p[name].reshape(-1)
        for at in rng.choice(flat.size, min(4, flat.size), replace=False):
            at = at if name not in ("word", "gram") else at % (2 * tx.GRAM_DIM)
            old = flat[at]
            flat[at] = old + 2e-2
            up = loss()
            flat[at] = old - 2e-2
            down = loss()
            flat[at] = old
            assert g.reshape(-1)[at] == pytest.approx((up - down) / 4e-2, rel=0.08, abs=4e-4)


def test_every_window_of_a_long_text_is_scored(tables):
    model = tx.fit(*tables)
    scorer = tx.Scorer(model)
    calm = "ereath thonin stan " * 4000
    low, high = scorer.scores([calm, calm[:120_000] + " scumban scumber scumbst " + calm])
    assert low < 0.5 < high
    parts = [0, 48, 49, 72, 73, 1000]
    for n in parts:
        covered = {k for s in tx.windows(n) for k in range(s, min(n, s + tx.WINDOW))}
        assert covered == set(range(n))


def test_odd_rows(documents, odd_rows, tables):
    docs = documents(*odd_rows)
    model = tx.fit(*tables)
    rows = tx.scored(docs, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    kept = tx.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score < tx.THRESHOLD for r in rows)


def test_without_training_rows_or_documents(documents, tables):
    docs, labels = documents((1, "a b"), (2, None)), tables[1]
    none = labels.filter("false")
    assert [r.score for r in tx.op9(docs, none).collect()] == [0.0, 0.0]
    assert tx.accepted(docs, tx.fit(docs, none)).count() == 2
    assert tx.op9(docs.filter("false"), labels).collect() == []


def test_sample_is_bounded(tables):
    assert tx.sample(*tables, most=50).count() <= 50


def test_training_texts_without_words():
    scorer = tx.Scorer(tx.train(["", " ", ""], [1, 0, 0]))
    assert all(0 <= s <= 1 for s in scorer.scores(["", "a word", None]))
