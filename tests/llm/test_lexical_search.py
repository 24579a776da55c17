import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.llm import lexical_search as ls

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(docs, items, top=50):
    """The contract, document by document."""
    held = [(key, Counter(terms(text))) for key, text in docs]
    n = sum(1 for _, own in held if own)
    total = sum(sum(own.values()) for _, own in held)
    df = Counter(t for _, own in held for t in own)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(terms(text))
    rows = Counter()
    for key, own in asked.items():
        found = []
        for doc, tfs in held:
            if not tfs:
                continue
            m = 100 - 50 + (50 * sum(tfs.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * tfs[t]) // (1000 * tfs[t] + 20 * m)) for t in own if t in tfs)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        rows.update((key, rank, None if missing else doc, -score)
                    for rank, (score, missing, doc) in enumerate(sorted(found)[:top], 1))
    return rows


def got(frame):
    return Counter(tuple(r[c] for c in ("item_id", "rank", "doc_id", "score"))
                   for r in frame.collect())


@pytest.fixture(scope="module")
def items(spark):
    def build(*rows):
        return spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                     "item_id long, text string, term string, m int, code int")

    return build


def test_given_tables(spark, data_directory, test_documents):
    asked = spark.read.parquet(f"{data_directory}/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in test_documents.collect()],
                 [(r.item_id, r.text) for r in asked.collect()])
    assert len(want) > 1000
    for size in (4_096, 7):
        assert got(ls.ranked(test_documents, asked, block_documents=size)) == want


def test_random_texts_in_blocks_of_items(documents, items):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)] + ["É", "a-b", "A1"]

    def text(most):
        return " ".join(rng.choice(words[:rng.randint(1, 33)]) for _ in range(rng.randint(0, most)))

    docs = [(i, text(40)) for i in range(300)] + [(i, "w1 w2 w3") for i in range(300, 380)]
    asked = [(i, text(8)) for i in range(40)]
    want = plain(docs, asked, 5)
    for block in (20_000, 30):
        assert got(ls.ranked(documents(*docs), items(*asked), top=5, item_block=block,
                             block_documents=16)) == want


def test_second_visit_skips_blocks_below_the_threshold(documents, items):
    docs = [(i, "rare") for i in range(60)] + [(100 + i, "rare " + "filler " * 300) for i in range(60)]
    frame = documents(*docs, *[(300 + i, "other words") for i in range(200)])
    pairs = ls.item_terms(items((1, "rare"))).select(F.lit(0).cast("long").alias("item"), "term")
    index = ls.build(frame, ["rare"])
    asked = pairs.join(index.weights, "term").select("item", "code", "w")
    visits = [r.m for r in ls.first_visits(index, asked, 50).collect()]
    strata = sorted(r.m for r in index.blocks.collect())
    assert len(strata) == 2 and visits == strata[:1]
    least = [r.score for r in ls.search(index, asked.select("item", "code")).collect()]
    assert len(least) == 50
    scored = index.blocks.mapInArrow(
        ls._score(ls._Asked([tuple(r) for r in asked.collect()]), 50, None,
                  ls.np.array([min(least)])), ls.FOUND)
    assert {r.doc_id for r in scored.collect()} <= set(range(60))


def test_odd_rows(documents, items, odd_rows):
    asked = [(1, "ONE two"), (2, None), (3, ""), (4, "absent"), (None, "no id HERE"),
             (1, "word7 größe"), (5, "日本語"), (5, "日本語"), (6, "x")]
    assert got(ls.ranked(documents(*odd_rows), items(*asked))) == plain(
        [r[:2] for r in odd_rows], asked)


def test_ties_go_by_id(documents, items):
    docs = [(i, "same words") for i in range(200, 100, -1)] + [(i, "others") for i in range(150)]
    result = ls.ranked(documents(*docs), items((1, "same")), block_documents=9)
    assert [r.doc_id for r in result.orderBy("rank").collect()] == list(range(101, 151))


def test_empty_tables(documents, items):
    assert ls.ranked(documents(), items((1, "a"))).collect() == []
    assert ls.ranked(documents((1, "a")), items()).collect() == []
    assert ls.ranked(documents((1, None)), items((1, None))).collect() == []
