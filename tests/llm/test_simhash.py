import random

import pytest
import xxhash

from threadloom.llm import simhash
from threadloom.llm.common import words_of
from threadloom.llm.components import components


def plain_fingerprint(text):
    words = words_of(text)
    shingles = ([b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
                if len(words) >= 3 else [b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, edges):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def near(values):
    return [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]


def expected(rows):
    fps = {i: plain_fingerprint(r[1]) for i, r in enumerate(rows)}
    root = roots(set(fps.values()), near(set(fps.values())))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            key = root[fps[i]]
            least[key] = min(least.get(key, r[0]), r[0])
    return sorted((str(r[0]), f"{fps[i]:016x}", str(least.get(root[fps[i]])))
                  for i, r in enumerate(rows))


def result(docs):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                  for r in simhash.op6(docs).collect())


def test_spark_hash_is_the_same(spark):
    text = "größe one two"
    value = spark.sql(f"select xxhash64('{text}')").first()[0]
    assert value % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_equals_brute_force(test_documents):
    rows = [(r.doc_id, r.text) for r in test_documents.collect()]
    assert result(test_documents) == expected(rows)


def test_odd_rows(documents, odd_rows):
    assert result(documents(*odd_rows)) == expected(odd_rows)


@pytest.mark.parametrize("crowded", [0, 2, 64])
def test_links_connect_what_all_pairs_connect(spark, crowded):
    rng = random.Random(crowded)
    values = {0, (1 << 64) - 1}
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            values.add(value)
        centre = (centre & 0xFFFFFFFF) | (rng.getrandbits(32) << 32)
        values.add(centre)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = [(r.u, r.v) for r in simhash.links(fps, crowded).collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in edges)
    wanted = [(a, b) for a in signed for b in signed
              if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3]
    assert roots(signed, edges) == roots(signed, wanted)


def test_crowded_segments_make_no_pairs(spark):
    """Fingerprints that share a segment and lie within 2 bits of one centre give few edges."""
    values = [1 << 40] + [(1 << 40) ^ (1 << 32 + i) ^ (1 << 32 + j)
                          for i in range(32) for j in range(i)]
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    edges = simhash.links(fps)
    assert edges.count() < 66 * len(values)
    assert components(edges).select("root").distinct().count() == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 140)}}


def test_one_document_of_each_group_stays(documents, odd_rows):
    docs = documents(*odd_rows)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {r.component_id for r in simhash.op6(docs).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(g for g in groups if g is not None)
    assert ids.count(None) == (None in groups)


def test_empty_table(documents):
    empty = documents().filter("false")
    assert result(empty) == [] and simhash.deduplicated(empty).collect() == []
