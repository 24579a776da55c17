"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input joins the embedding of the word, the mean embedding of its character n-grams (runs
of `GRAM` bytes, hashed into `GRAMS` rows), and how much more often the word, and the worst of its
n-grams, stand in toxic training documents than expected. The latter is cross-fitted, so a document
never sees its own label. Words never seen in training are thus read by their characters. Gated recurrent units read a window of words
in both directions, attention weighs their states, and a linear layer gives the window's logit.
Overlapping windows cover the whole text; the document's score is that of its worst window, and
training passes the document's label to its worst window too.

Training is done once on the whole texts of at most `SAMPLE` labelled documents, which the driver
keeps as numbers of words. Scoring reads whole texts, task by task, without a shuffle. The model is
broadcast; its vocabulary has at most `VOCABULARY` words, others share one embedding and are read by
their n-grams.

Cases: null and empty texts are scored as one window without words; labels that are null count as no
label; without any training row all scores are 0; repeated rows are scored each for itself; an empty
table gives no rows. doc_id, lang, source and labels are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import crc_of_id, long_id, stored, words_of

SAMPLE = 6000
VOCABULARY = 20_000
WINDOW, STEP = 48, 24
GRAM, GRAMS = 4, 1 << 16
HIDDEN, ATTENTION, WORD_DIM, GRAM_DIM, PRIOR_DIM = 10, 8, 8, 6, 3
FOLDS = 4
EPOCHS, LEAST_BATCHES, BATCHES, BATCH_DOCS, RATE = 20, 120, 500, 64, 0.01
# Share of the words whose embeddings are hidden in a training step, so that none is learnt by heart.
HIDE = 0.5
THRESHOLD = 0.7
# Rows of the word table kept between blocks, and characters of a block.
REMEMBERED, BLOCK_CHARS, CHUNK = 200_000, 1_000_000, 2048
EDGES = b".,;:!?*%&$#|\"'()[]<>"


def tokens(text: str | None) -> list[bytes]:
    return [w.strip(EDGES) for w in words_of(text)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def windows(n: int) -> list[int]:
    """Starts of the windows over n words; the last one ends at the last word."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STEP), n - WINDOW]


def initial(vocabulary: int, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    inputs = WORD_DIM + GRAM_DIM + PRIOR_DIM

    def normal(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    p = {"word": normal(vocabulary + 1, WORD_DIM, scale=0.05),
         "gram": normal(GRAMS, GRAM_DIM, scale=0.05)}
    for way in "fb":
        p["Wx" + way] = normal(inputs, 3 * HIDDEN, scale=inputs ** -0.5)
        p["U" + way] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5)
        p["bx" + way] = np.zeros(3 * HIDDEN, np.float32)
    p["Wa"] = normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5)
    p["ba"] = np.zeros(ATTENTION, np.float32)
    p["va"] = normal(ATTENTION, scale=ATTENTION ** -0.5)
    p["w"] = normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5)
    p["b"] = np.full(1, -1.0, np.float32)
    return p


def _gru(proj, x, u, mask, reverse, keep=None):
    """States (time, batch, hidden) of one direction; `keep` collects what backward needs."""
    steps, batch = x.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    states = np.empty((steps, batch, HIDDEN), np.float32)
    for t in (range(steps - 1, -1, -1) if reverse else range(steps)):
        a = proj[x[t]]
        g = h @ u
        zr = _sigmoid(a[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(a[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, n, g[:, 2 * HIDDEN:]))
        h = new
        states[t] = h
    return states


def _gru_back(dstates, x, u, mask, keep, dproj, du):
    """Adds gradients of the projections and of u, from those of the states."""
    dh = np.zeros_like(dstates[0])
    for t, before, z, r, n, gn in reversed(keep):
        dh = dh + dstates[t]
        dnew = dh if mask is None else np.where(mask[t][:, None], dh, 0)
        dn = dnew * (1 - z) * (1 - n * n)
        dz = dnew * (before - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        da = np.concatenate([dz, dr, dn], axis=1)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(dproj, x[t], da)
        du += before.T @ dg
        back = dnew * z + dg @ u.T
        dh = back if mask is None else back + np.where(mask[t][:, None], 0, dh)


def _attend(p, states, mask):
    """Pooled states, attention weights and hidden attention units."""
    unit = np.tanh(states @ p["Wa"] + p["ba"])
    score = unit @ p["va"]
    if mask is not None:
        score = np.where(mask, score, np.float32(-1e9))
    score = np.exp(score - score.max(axis=0))
    weight = score / score.sum(axis=0)
    return np.einsum("tb,tbh->bh", weight, states, optimize=True), weight, unit


def logits(p, proj_f, proj_b, x, mask=None) -> np.ndarray:
    """Logits of windows x (time, batch) of rows of the projected word table."""
    states = np.concatenate([_gru(proj_f, x, p["Uf"], mask, False),
                             _gru(proj_b, x, p["Ub"], mask, True)], axis=2)
    return _attend(p, states, mask)[0] @ p["w"] + p["b"]


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words with a mark before and after each, and how many each has."""
    flat = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    code = np.zeros(max(0, len(flat) - GRAM + 1), np.uint64)
    for i in range(GRAM):
        code = (code << np.uint64(8)) | flat[i:i + len(code)]
    code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    count = np.maximum(0, length - GRAM + 1)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return code[np.repeat(np.cumsum(length) - length, count) + inside].astype(np.int64), count


def _per_word(values: np.ndarray, count: np.ndarray, ufunc) -> np.ndarray:
    """Values of n-grams reduced to one row per word; 0 for words without any."""
    out = np.zeros((len(count), *values.shape[1:]), np.float32)
    full = np.flatnonzero(count)
    if len(full):
        out[full] = ufunc.reduceat(values, (np.cumsum(count) - count)[full], axis=0)
    return out


def _mean(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    return _per_word(values, count, np.add) / np.maximum(count, 1)[:, None].astype(np.float32)


def _deviations(toxic: np.ndarray, clean: np.ndarray, n1: float, n0: float) -> np.ndarray:
    expected = (toxic + clean) * n1 / max(1, n1 + n0)
    return np.clip((toxic - expected) / np.sqrt(expected + 1) / 3, -3, 3)


def _counts(present: list[np.ndarray], labels: np.ndarray, size: int) -> tuple:
    """In how many toxic and other documents each number stands; a document has each once."""
    found = [np.zeros(size), np.zeros(size)]
    for own, label in zip(present, labels):
        found[0 if label else 1][own] += 1
    return found[0], found[1]


def priors(words: list[np.ndarray], pieces: list[np.ndarray], labels: np.ndarray, size: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """How much more often than expected known words (row 0: unknown) and n-grams are toxic."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    n = max(1, n1 + n0)
    toxic, clean = _counts(words, labels, size + 1)
    odds = (np.log((toxic + 2 * n1 / n + 1e-3) / (n1 + 2))
            - np.log((clean + 2 * n0 / n + 1e-3) / (n0 + 2)))
    known = np.stack([_deviations(toxic, clean, n1, n0), np.clip(odds / 2, -2, 2)], axis=1)
    known[0] = 0
    return (known.astype(np.float32),
            _deviations(*_counts(pieces, labels, GRAMS), n1, n0).astype(np.float32))


def _project(p, features):
    return (features @ p["Wxf"] + p["bxf"], features @ p["Wxb"] + p["bxb"])


def train(texts: Iterable[str], labels: list[int], seed: int = 11) -> dict | None:
    """Fits the network; None without training rows."""
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    # Texts become numbers of their spellings one by one, as words by themselves take far more room.
    spelled: dict[bytes, int] = {}
    docs = []
    for text in texts:
        docs.append(np.array([spelled.setdefault(w, len(spelled)) for w in tokens(text)], np.int32))
    words = list(spelled) or [b""]
    kinds = [np.unique(own) for own in docs]
    found = np.bincount(np.concatenate(kinds), minlength=len(words))
    often = sorted(np.flatnonzero(found > 1).tolist(), key=lambda i: (-found[i], words[i]))
    known = [words[i] for i in often[:VOCABULARY]]
    ids = {w: i + 1 for i, w in enumerate(known)}
    # Unknown words share row 0 of the embedding but keep their own n-grams.
    word_of = np.fromiter((ids.get(w, 0) for w in words), np.int64, len(words))
    present = [word_of[own][word_of[own] > 0] for own in kinds]
    pieces = [np.unique(grams([words[i] for i in own.tolist()])[0]) for own in kinds]
    fold = rng.permutation(len(docs)) % FOLDS
    by_fold = []
    for f in range(FOLDS):
        others = np.flatnonzero(fold != f)
        by_fold.append(priors([present[i] for i in others], [pieces[i] for i in others],
                              y[others], len(known)))
    prior, gram_prior = (np.stack(x) for x in zip(*by_fold))
    p = initial(len(known), seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    order: list[int] = []
    batches = min(BATCHES, max(LEAST_BATCHES, EPOCHS * len(docs) // BATCH_DOCS))
    for step in range(1, batches + 1):
        while len(order) < BATCH_DOCS:
            order += rng.permutation(len(docs)).tolist()
        batch, order = order[:BATCH_DOCS], order[BATCH_DOCS:]
        starts = [(d, s) for d in batch for s in windows(len(docs[d]))]
        of_doc = np.array([d for d, _ in starts])
        length = np.array([min(WINDOW, len(docs[d]) - s) for d, s in starts])
        raw = np.full((len(starts), WINDOW), -1, np.int64)
        for row, (d, s) in enumerate(starts):
            raw[row, :length[row]] = docs[d][s:s + WINDOW].astype(np.int64) * FOLDS + fold[d]
        types, x = np.unique(raw, return_inverse=True)
        x = x.reshape(raw.shape).T.copy()
        mask = np.arange(WINDOW)[:, None] < length
        real = np.maximum(types, 0)
        kind, which = real // FOLDS, real % FOLDS
        word = np.where(types < 0, 0, word_of[kind])
        gram, count = grams([words[k] for k in kind])
        spelling = (gram, count)
        shown = (rng.random(len(kind)) >= HIDE).astype(np.float32)[:, None]
        features = np.concatenate([
            p["word"][word] * shown, _mean(p["gram"][gram], count) * shown, prior[which, word],
            _per_word(gram_prior[np.repeat(which, count), gram], count, np.maximum)[:, None],
        ], axis=1)
        proj_f, proj_b = _project(p, features)
        z = logits(p, proj_f, proj_b, x, mask)
        # The worst window of each document takes the document's label.
        first = {}
        for row in np.argsort(-z, kind="stable"):
            first.setdefault(of_doc[row], row)
        rows = np.array([first[d] for d in dict.fromkeys(batch)])
        target = y[of_doc[rows]]
        grads = _gradients(p, features, spelling, word, shown, proj_f, proj_b, x[:, rows], mask[:, rows],
                           target)
        rate = RATE * min(1.0, step / 20) * (1.0 if step < 0.7 * batches else 0.3)
        for name, g in grads.items():
            m, v = moment[name]
            g = np.clip(g, -1, 1)
            if name in ("word", "gram"):
                g = g + 1e-3 * p[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p[name] -= (rate * (m / (1 - 0.9 ** step))
                        / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    known_prior, every_gram = priors(present, pieces, y, len(known))
    return {"params": p, "ids": ids, "prior": known_prior, "gram_prior": every_gram}


def _gradients(p, features, spelling, word, shown, proj_f, proj_b, x, mask, target):
    """Gradients of the mean log loss over windows with targets."""
    keep_f: list = []
    keep_b: list = []
    states = np.concatenate([_gru(proj_f, x, p["Uf"], mask, False, keep_f),
                             _gru(proj_b, x, p["Ub"], mask, True, keep_b)], axis=2)
    pooled, weight, unit = _attend(p, states, mask)
    z = pooled @ p["w"] + p["b"]
    dz = ((_sigmoid(z) - target) / len(target)).astype(np.float32)
    g = {"w": pooled.T @ dz, "b": dz.sum(keepdims=True)}
    dpooled = dz[:, None] * p["w"]
    dstates = weight[:, :, None] * dpooled
    dweight = np.einsum("tbh,bh->tb", states, dpooled)
    dscore = weight * (dweight - (weight * dweight).sum(axis=0))
    g["va"] = np.einsum("tb,tba->a", dscore, unit)
    dunit = dscore[:, :, None] * p["va"] * (1 - unit * unit)
    g["Wa"] = np.einsum("tbh,tba->ha", states, dunit)
    g["ba"] = dunit.sum(axis=(0, 1))
    dstates = dstates + dunit @ p["Wa"].T
    dfeatures = 0
    for way, proj, keep, part in (("f", proj_f, keep_f, slice(0, HIDDEN)),
                                  ("b", proj_b, keep_b, slice(HIDDEN, None))):
        dproj, du = np.zeros_like(proj), np.zeros_like(p["U" + way])
        _gru_back(dstates[:, :, part], x, p["U" + way], mask, keep, dproj, du)
        g["U" + way], g["Wx" + way], g["bx" + way] = du, features.T @ dproj, dproj.sum(axis=0)
        dfeatures = dfeatures + dproj @ p["Wx" + way].T
    dfeatures[:, :WORD_DIM + GRAM_DIM] *= shown
    g["word"] = np.zeros_like(p["word"])
    np.add.at(g["word"], word, dfeatures[:, :WORD_DIM])
    gram, count = spelling
    each = dfeatures[:, WORD_DIM:WORD_DIM + GRAM_DIM] / np.maximum(count, 1)[:, None]
    g["gram"] = np.zeros_like(p["gram"])
    np.add.at(g["gram"], gram, np.repeat(each, count, axis=0).astype(np.float32))
    return g


class Scorer:
    """Scores texts with a fitted model; remembers the projected inputs of words."""

    def __init__(self, model: dict | None):
        self.model = model
        self.rows: dict[bytes, int] = {}
        self.forward = self.backward = np.zeros((0, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        """Adds projected inputs of new words to the table."""
        p, ids, prior = (self.model[k] for k in ("params", "ids", "prior"))
        gram_prior = self.model["gram_prior"]
        parts_f, parts_b = [self.forward], [self.backward]
        for at in range(0, len(words), 20_000):
            some = words[at:at + 20_000]
            gram, count = grams(some)
            word = np.fromiter((ids.get(w, 0) for w in some), np.int64, len(some))
            f, b = _project(p, np.concatenate([
                p["word"][word], _mean(p["gram"][gram], count), prior[word],
                _per_word(gram_prior[gram], count, np.maximum)[:, None]], axis=1))
            parts_f.append(f.astype(np.float32))
            parts_b.append(b.astype(np.float32))
        self.forward, self.backward = np.concatenate(parts_f), np.concatenate(parts_b)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """One score per text, 0 to 1."""
        if self.model is None:
            return np.zeros(len(texts))
        if len(self.rows) > REMEMBERED:
            self.rows, self.forward = {}, self.forward[:0]
            self.backward = self.backward[:0]
        docs = [tokens(t) for t in texts]
        known = len(self.rows)
        rows = self.rows
        ids = [[rows.setdefault(w, len(rows)) for w in own] or [rows.setdefault(b"", len(rows))]
               for own in docs]
        if len(rows) > known:
            self._learn(list(rows)[known:])
        flat = np.fromiter((i for own in ids for i in own), np.int32)
        length = np.array([len(own) for own in docs])
        place = np.cumsum([0, *map(len, ids)])[:-1]
        worst = np.full(len(docs), -np.inf)
        long_docs = np.flatnonzero(length >= WINDOW)
        starts = [(d, place[d] + s) for d in long_docs for s in windows(length[d])]
        for at in range(0, len(starts), CHUNK):
            part = np.array(starts[at:at + CHUNK])
            x = flat[part[:, 1] + np.arange(WINDOW)[:, None]]
            z = logits(self.model["params"], self.forward, self.backward, x)
            np.maximum.at(worst, part[:, 0], z)
        short = np.flatnonzero(length < WINDOW)
        short = short[np.argsort(length[short], kind="stable")]
        for at in range(0, len(short), CHUNK):
            part = short[at:at + CHUNK]
            steps = max(1, int(length[part].max()))
            inside = np.arange(steps)[:, None] < length[part]
            x = flat[np.where(inside, place[part] + np.arange(steps)[:, None], place[part])]
            worst[part] = logits(self.model["params"], self.forward, self.backward, x, inside)
        return _sigmoid(worst)


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most `most` labelled training documents in the order of a hash, with their whole texts."""
    chosen = (
        labels.select(long_id(), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % 3 != 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        docs.select(long_id(), text.alias("text")).join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic").orderBy(F.xxhash64("text"), "toxic").limit(most)
    )


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict | None:
    """Train on whole texts, which come to the driver one by one and are kept as numbers of words."""
    kept = stored(sample(docs, labels, most), "toxicity-sample")
    order = [F.xxhash64("text"), F.col("toxic")]
    toxic = [r.toxic for r in kept.orderBy(*order).select("toxic").collect()]
    return train((r.text for r in kept.orderBy(*order).toLocalIterator()), toxic)


def _blocks(batches, column: int):
    """Slices of batches with bounded text size, as (slice, texts)."""
    for batch in batches:
        first, size, texts = 0, 0, []
        for i, value in enumerate(batch.column(column)):
            text = value.as_py()
            texts.append(text)
            size += len(text or "")
            if size > BLOCK_CHARS:
                yield batch.slice(first, i + 1 - first), texts
                first, size, texts = i + 1, 0, []
        if texts:
            yield batch.slice(first, len(texts)), texts


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part, texts in _blocks(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scorer.scores(texts), pa.float64())],
                names=["doc_id", "score"])

    return docs.select(long_id(), F.col("text").cast("string").alias("text")).mapInArrow(
        score, "doc_id long, score double")


def accepted(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold; all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part, texts in _blocks(batches, column):
            yield part.filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit(docs, labels)).select(
        "doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
