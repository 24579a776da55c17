from collections import Counter, defaultdict

import pytest

from threadloom.llm import mixing
from threadloom.llm.common import words_of


def expected_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check(docs):
    rows = mixing.op3(docs).collect()
    source = docs.select("doc_id", "text", "source").collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in rows) == Counter(
        (d.doc_id, len(words_of(d.text)), d.source) for d in source)
    sizes = defaultdict(int)
    largest = defaultdict(int)
    taken = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
        taken[r.source] += r.taken
        assert r.taken in (0, r["size"], 2 * r["size"])
    want = expected_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    return rows


def test_targets_are_met_within_half_a_document(test_documents):
    rows = check(test_documents)
    again = mixing.op3(test_documents.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_many_levels(documents):
    check(documents(*[(i, "w " * (1 + i * 7 % 90), "ab"[i % 9 == 0]) for i in range(9000)]))


def test_odd_rows(documents, odd_rows):
    check(documents(*odd_rows))


def test_fractions_are_kept_on_average(documents):
    docs = documents(*[(i, "w " * (10 + i), "abc"[i % 3]) for i in range(60)])
    digest = mixing.copies(docs).select("source", "target", "source_size").distinct().collect()
    want = {r.source: r.target / r.source_size for r in digest}
    sums = Counter()
    for seed in range(12):
        for r in mixing.copies(docs, seed=seed).collect():
            sums[r.source] += r.copies
    for s, x in want.items():
        assert abs(sums[s] / (12 * 20) - x) < 0.12


def test_mixed_repeats_whole_rows(documents, odd_rows):
    docs = documents(*odd_rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    often = Counter()
    for r in mixing.copies(docs).collect():
        often[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +often


def test_one_row_repeated_very_often(documents, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 8)
    docs = documents(*[(1, "same words here", "a")] * 700, *[(i, "w " * i, "b") for i in range(2, 40)],
                     *[(None, "no id", None)] * 30)
    rows = check(docs)
    often = Counter()
    for r in rows:
        often[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixing.mixed(docs).collect()) == +often


def test_empty_table(documents):
    empty = documents().filter("false")
    assert mixing.op3(empty).collect() == [] and mixing.mixed(empty).collect() == []


def test_no_python_in_the_plan(test_documents):
    plan = mixing.mixed(test_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
