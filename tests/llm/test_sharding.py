import zlib

from threadloom.llm import sharding


def rows_of(docs, shards=8):
    return sharding.op1(docs, shards).collect()


def check_places(rows, shards):
    for shard in range(shards):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(
            range(sum(r.shard == shard for r in rows)))


def test_digests_places_and_near_equal_sizes(test_documents):
    texts = {r.doc_id: r.text for r in test_documents.collect()}
    rows = rows_of(test_documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    check_places(rows, 8)
    loads = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(loads) - min(loads) <= max(r["size"] for r in rows)


def test_equal_texts_share_a_shard(documents):
    rows = rows_of(documents(*[(i, f"text {i % 40}") for i in range(400)]))
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(shards) == 1 for shards in by_text.values())


def test_a_hot_text_is_spread(documents):
    rows = rows_of(documents(*[(i, "copy " * 20 if i % 3 == 0 else f"own text {i} " * 8)
                               for i in range(900)]))
    loads = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(loads) < 1.1 * min(loads)
    check_places(rows, 8)


def test_odd_rows(documents, odd_rows):
    rows = rows_of(documents(*odd_rows))
    assert len(rows) == len(odd_rows)
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id == 1} == {(1, 0)}
    check_places(rows, 8)


def test_empty_table(documents):
    assert rows_of(documents().filter("false")) == []


def test_map_is_versioned_and_rebalancing_moves_whole_slots(spark, test_documents):
    records = sharding.digests(test_documents)
    first = sharding.build_map(records, 8)
    grown = sharding.rebalance(first, 9)
    moved = [s for s in first.shard_of if first.shard_of[s] != grown.shard_of[s]]
    assert moved and all(grown.shard_of[s] == 8 for s in moved)
    assert max(grown.loads()) - min(grown.loads()) <= max(grown.bytes_of.values())
    shrunk = sharding.rebalance(grown, 7)
    assert set(shrunk.shard_of.values()) == set(range(7)) and shrunk.version == 3
    path = sharding.store_map(spark, first)
    sharding.store_map(spark, grown, path)
    assert sharding.load_map(spark, path, 9) == grown
    assert sharding.load_map(spark, path, 8, version=1) == first


def test_write_shards_agrees_with_placement(spark, test_documents, tmp_path):
    records = sharding.digests(test_documents)
    slot_map = sharding.build_map(records, 4)
    sharding.write_shards(test_documents, slot_map, str(tmp_path / "out"))
    stored = {r.doc_id: r.in_shard for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert stored == {r.doc_id: r.shard for r in sharding.placed(records, slot_map).collect()}


def test_a_map_loaded_by_its_path_places_all_records_as_before(spark, documents):
    docs = documents(*[(i, "copy " * 20 if i % 3 == 0 else f"own text {i} " * 8)
                       for i in range(900)])
    records = sharding.digests(docs)
    slot_map = sharding.build_map(records, 8)
    assert slot_map.hot
    path = sharding.store_map(spark, slot_map)
    sharding.store_map(spark, sharding.rebalance(slot_map, 9), path)
    loaded = sharding.load_map(spark, path, version=1)
    assert loaded == slot_map and sharding.load_map(spark, path).shards == 9

    def places(m):
        return {r.doc_id: (r.virtual_slot, r.shard) for r in sharding.placed(records, m).collect()}

    assert places(loaded) == places(slot_map)


def test_write_shards_keeps_columns_of_any_name(spark, tmp_path):
    names = ["text_key", "shard", "virtual_slot", "row", "spread", "in_shard", "slot"]
    docs = spark.createDataFrame(
        [(i, f"text {i}", *[f"{n} {i}" for n in names]) for i in range(40)],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    slot_map = sharding.build_map(sharding.digests(docs), 4)
    path = str(tmp_path / "out")
    sharding.write_shards(docs, slot_map, path)
    back = spark.read.parquet(path)
    assert back.columns == [*docs.columns, "in_shard_"]
    assert sorted(back.drop("in_shard_").collect()) == sorted(docs.collect())
