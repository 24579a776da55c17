import itertools
import random
import re

import pytest

from threadloom.llm import decontaminate as dc


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]


@pytest.fixture(scope="module")
def benchmark(spark):
    def build(*rows):
        return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                     "item_id long, text string, seed string, words string")

    return build


def found(docs, bench, **settings):
    return {(r.doc_id, r.item_id) for r in dc.overlaps(docs, bench, **settings).collect()}


def brute(docs, items):
    """Pairs with an aligned stretch that agrees well enough, by trying all alignments."""
    def split(text):
        return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]

    pairs = set()
    for d, text in docs:
        have = split(text)
        for i, item in items:
            want = split(item)
            span = min(dc.STRETCH, len(want))
            if len(want) < dc.SHORTEST:
                continue
            for shift in range(-len(want), len(have)):
                equal = [0 <= shift + k < len(have) and have[shift + k] == want[k]
                         for k in range(len(want))]
                if any(sum(equal[s:s + span]) >= dc.AGREE * span
                       for s in range(len(want) - span + 1)):
                    pairs.add((d, i))
    return pairs


def test_equals_brute_force_on_copies_and_substitutions(documents, benchmark, words):
    rng = random.Random(6)
    items = [(i, " ".join(rng.sample(words, rng.randint(15, 50)))) for i in range(30)]
    docs = []
    for d in range(120):
        body = rng.sample(words, 60)
        if d % 3 == 0:
            passage = items[d % 30][1].split()
            for k in range(rng.randint(0, 12), len(passage), 12):  # every twelfth word replaced
                passage[k] = "other"
            body[20:20] = passage
        docs.append((d, ", ".join(body).title()))
    want = brute(docs, items)
    assert len(want) >= 35
    assert found(documents(*docs), benchmark(*items)) == want


def test_short_items_and_minimum(documents, benchmark, words):
    items = [(1, " ".join(words[:5])), (2, " ".join(words[10:18])), (3, " ".join(words[20:24])),
             (4, None), (5, "")]
    docs = [(1, "x " + " ".join(words[:5]) + " y"), (2, " ".join(words[5:30])), (3, words[20])]
    assert found(documents(*docs), benchmark(*items)) == {(1, 1), (2, 2)}


def test_no_replacement_within_the_agreement_is_missed(documents, benchmark, words):
    items = [(n, " ".join(words[40 * n:40 * n + n])) for n in range(5, 14)]
    items += [(n, " ".join(words[40 * n:40 * n + n])) for n in (16, 30)]
    docs = [(0, " ".join(words[200:204]))]  # four words of the first item
    for n, item in items:
        head = min(n, dc.STRETCH)
        for many in (1, 2, 3):
            for places in itertools.combinations(range(head), many):
                have = item.split()[:head]
                for place in places:
                    have[place] = "other"
                if many < 3 or sum(places) % 20 == 0:
                    docs.append((len(docs), " ".join(have)))
    want = brute(docs, items)
    assert len(want) == 1 + 5 + 6 + 7 + 8 + 9 + 10 + 45 + 11 + 55 + 12 + 66 + 3 * (13 + 78)
    assert found(documents(*docs), benchmark(*items)) == want


def test_blocks_of_seeds_give_the_same(documents, benchmark, words):
    items = [(i, " ".join(words[50 * i:50 * i + 30])) for i in range(10)]
    docs = documents(*[(i, " ".join(words[50 * i:50 * i + 20])) for i in range(12)])
    assert found(docs, benchmark(*items), most_broadcast=50) == found(docs, benchmark(*items))


def test_odd_rows_and_cleaning(documents, benchmark, odd_rows, words):
    leak = (77, "Before. " + " ".join(words[:40]))
    docs = documents(*odd_rows, leak, leak)
    bench = benchmark((None, " ".join(words[5:40])), (1, "one two"))
    assert [(r.doc_id, r.item_id) for r in dc.overlaps(docs, bench).collect()] == [(77, None)]
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, documents(*odd_rows).collect()))


def test_empty_tables(documents, benchmark):
    docs, bench = documents((1, "a b c d e f g")), benchmark((1, "a b c d e f g"))
    assert found(docs.filter("false"), bench) == set()
    assert found(docs, bench.filter("false")) == set()
    assert dc.clean(docs, bench.filter("false")).count() == 1


def test_plan_is_generated_code_without_python(test_documents, spark, data_directory):
    bench = spark.read.parquet(f"{data_directory}/benchmark.parquet")
    plan = dc.overlaps(test_documents, bench)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
