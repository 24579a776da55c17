import os

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.plans import layout
from threadloom.sinks import reports, tables as sinks
from threadloom.sources import tables as sources


@pytest.fixture(scope="module")
def frames(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, w string")
    new = spark.createDataFrame(
        [("b", 9, None), ("b", 8, "q"), ("c", None, "z")], "k string, v int, w string")
    return old, new


def as_dict(df):
    return {r.k: (r.v, r.w) for r in df.collect()}


def test_insert_ignore(frames):
    old, new = frames
    assert as_dict(sinks.insert_ignore(old, new, ["k"], [F.col("v").asc()])) == {"c": (None, "z")}


def test_upsert(frames):
    old, new = frames
    order = [F.col("v").desc()]
    assert as_dict(sinks.upsert(old, new, ["k"], order)) == {
        "a": (1, "x"), "b": (9, None), "c": (None, "z")}
    assert as_dict(sinks.upsert(old, new, ["k"], order, update=["w"])) == {
        "a": (1, "x"), "b": (2, None), "c": (None, "z")}


def files_of(path):
    """Data files of each partition of a table on the local disk."""
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith(sinks.BUCKET)}


def test_buckets_follow_the_size(spark, ws, monkeypatch):
    assert [sinks.buckets_for(n) for n in (0, 1, 128 << 20, (128 << 20) + 1, 1 << 60)] == [
        1, 1, 1, 2, sinks.MOST_BUCKETS]
    monkeypatch.setattr(sinks, "BUCKET_BYTES", 400)
    path = ws.new_path("sized")
    rows = spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS v")
    sinks.write_keyed(rows, path, ["k"])
    buckets = int(sinks.bucket_column(spark, path).removeprefix(sinks.BUCKET))
    assert buckets > 4 and len(files_of(path)) == buckets
    assert sinks.read_keyed(spark, path, rows.schema).count() == 1000


def test_interrupted_replacement_is_finished_by_the_next_merge(spark, ws, frames, monkeypatch):
    old, new = frames
    path = ws.new_path("interrupted")
    sinks.write_keyed(old, path, ["k"], buckets=4)

    def die(*_):
        raise RuntimeError("driver lost")

    finish = sinks.finish
    calls = iter([finish, die])
    monkeypatch.setattr(sinks, "finish", lambda *a: next(calls)(*a))
    with pytest.raises(RuntimeError):
        sinks.merge_into(spark, path, new, ["k"], [F.col("v").desc()])
    assert as_dict(sinks.read_keyed(spark, path, old.schema)) == as_dict(old)
    monkeypatch.setattr(sinks, "finish", finish)
    more = spark.createDataFrame([("d", 4, "d")], old.schema)
    sinks.merge_into(spark, path, more, ["k"], [F.col("v").desc()])
    assert as_dict(sinks.read_keyed(spark, path, old.schema)) == {
        "a": (1, "x"), "b": (9, None), "c": (None, "z"), "d": (4, "d")}


def test_append_and_reset(spark, ws, frames):
    old, _ = frames
    path = ws.new_path("append-test")
    sinks.append(old, path)
    sinks.append(old, path)
    assert spark.read.parquet(path).count() == 4
    sinks.reset(spark, path, old.schema)
    assert spark.read.schema(old.schema).parquet(path).count() == 0


def test_clustering_keeps_rows_and_orders_files(spark, ws, rows_of):
    posts = ws.relational["post"]
    root = ws.new_path("clustered-test")
    copy = layout.write_clustered({"post": posts}, root)["post"]
    assert rows_of(copy) == rows_of(posts)
    ranges = copy.groupBy(F.input_file_name()).agg(
        F.min("subreddit_id").alias("lo"), F.max("subreddit_id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_timing_comparison(spark):
    before = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 1.0), ("c", 3, 1.0)], layout.TIMING_SCHEMA)
    after = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 0.25), ("c", 3, 0.0)], layout.TIMING_SCHEMA)
    got = [(r["query"], r.speedup) for r in reports.timing_comparison(before, after).collect()]
    assert got == [("b", 4.0), ("a", 2.0), ("c", None)]


def test_report_keeps_its_order(spark, ws):
    found = spark.createDataFrame(
        [("t", "x", "y", "Domain-Based", False, 2, 3, "why"),
         ("t", "k", "x, y", "Primary Key", True, 0, 3, None)],
        "table_name string, determinant string, dependent string, fd_type string, holds boolean,"
        " violations long, total_groups long, description string")
    facts = spark.createDataFrame(
        [("t", "k, x, y", 1234, "k")],
        "table_name string, columns string, row_count long, primary_key string")
    examples = spark.createDataFrame(
        [("t", "x", v, "y", ["1", "2"]) for v in ("c", "a", "b")],
        "table_name string, determinant string, determinant_value string,"
        " dependent_column string, dependent_values array<string>")
    path = ws.new_path("report-test")
    reports.write_text(reports.fd_report(found, facts, examples), path)
    assert [r.value for r in spark.read.text(path).collect()] == [
        "- **Total Tables Analyzed**: 1", "- **Total Functional Dependencies Discovered**: 2",
        "### Table: `t`", "**Columns**: k, x, y", "**Row Count**: 1,234", "**Primary Key**: `k`",
        "#### Functional Dependencies", "**Primary Key Dependencies:**",
        "- `k` -> `x, y` **HOLDS**", "  - Type: Primary Key", "  - Confidence: High",
        "**Domain-Based Dependencies:**",
        "- `x` -> `y` **FAILS**", "  - Type: Domain-Based", "  - Confidence: High",
        "  - Description: why", "  - Violations: 2 violations in 3 groups",
        "  - Example violations:", "    - x=a -> y=[1, 2]", "    - x=b -> y=[1, 2]",
    ]


def test_json_sources(spark, ws, rows_of):
    path = ws.new_path("json-test")
    ws.collections["posts"].write.json(path, compression="gzip")
    back = sources.read_documents(spark, "posts", path, "json")
    assert back.schema.simpleString() == schemas.DOCUMENTS["posts"].simpleString()
    assert rows_of(back) == rows_of(ws.collections["posts"])


def test_broken_lines_are_rejected_alone(spark, ws):
    path = ws.new_path("lines")
    good = ['{"id": "a", "score": 1, "other": [1]}', '{"score": null}', "  ", "",
            '{"id": 5, "edited": 3}']
    bad = ['{"id": "b", "score": "7 points"}', '{"id": "c", "score": 3000000000}', '{"id": "d"',
           "no json", "[1]", "7", "null", '{"id": "e", "score": 1.5}', '{"id": "f", "score": {}}']
    spark.createDataFrame([(x,) for x in good + bad], "value string").write.text(path)
    kept, rejected = sources.checked_json(spark, path, ws.store)
    assert kept.columns == schemas.FLAT.names
    assert sorted(((r.id, r.score, r.edited) for r in kept.collect()), key=str) == [
        ("5", None, 3), ("a", 1, None), (None, None, None)]
    assert sorted(r.line for r in rejected.collect()) == sorted(bad)
    # The same whichever column is asked for.
    assert kept.select("id").count() == 3 and rejected.count() == len(bad)


def test_limits_at_the_source(spark, ws):
    assert sources.read_flat(spark, ws.path("flat"), ["id"], first=5).count() == 5
    assert sources.read_table(spark, "post", ws.path("post"), first=5).count() == 5


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_numbers_are_rounded_by_their_binary_value(spark, digits):
    values = [k / 800 for k in range(801)] + [k / 8 for k in range(-40, 41)] + [
        1234567.00005, 0.5, 1.5, 2.5, 1e-9, 99999.99995, 0.1 + 0.2, 100 * 0.2875]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select(
        "i", reports.fixed(F.col("v"), digits).alias("text")).collect()
    assert {r.i: r.text for r in got} == {i: f"{v:.{digits}f}" for i, v in enumerate(values)}


def test_merges_leave_untouched_buckets_alone(spark, ws):
    path = ws.new_path("buckets")
    old = spark.createDataFrame([(f"k{i}", i) for i in range(300)], "k string, v int")
    sinks.write_keyed(old, path, ["k"], buckets=16)
    before = files_of(path)
    same = spark.createDataFrame([("k8", 8), ("k9", 9)], "k string, v int")
    assert sinks.merge_into(spark, path, same, ["k"], [F.col("v").asc()]) == []
    assert files_of(path) == before and len(before) == 16
    new = spark.createDataFrame([("k7", -7), ("new", 1), ("k9", 9)], "k string, v int")
    touched = sinks.merge_into(spark, path, new, ["k"], [F.col("v").asc()])
    after = files_of(path)
    assert 1 <= len(touched) <= 2
    assert {d for d in before if before[d] != after[d]} == {
        f"{sinks.BUCKET}16={b}" for b in touched}
    got = {r.k: r.v for r in sinks.read_keyed(spark, path, old.schema).collect()}
    assert got == {**{f"k{i}": i for i in range(300)}, "k7": -7, "new": 1}


def test_a_reduction_lets_stored_and_incoming_rows_compete(spark, ws):
    path = ws.new_path("competing")
    rows = spark.createDataFrame([("a", 3), ("b", 5)], "k string, v int")
    least = lambda df: df.groupBy("k").agg(F.min("v").alias("v"))
    for more in (rows, spark.createDataFrame([("a", 9), ("b", 1), ("c", 2)], rows.schema)):
        sinks.merge_into(spark, path, more, ["k"], [], reduction=least)
    assert {r.k: r.v for r in sinks.read_keyed(spark, path, rows.schema).collect()} == {
        "a": 3, "b": 1, "c": 2}


def test_merging_into_an_empty_table(spark, ws):
    path = ws.new_path("empty-buckets")
    rows = spark.createDataFrame([("a", 1)], "k string, v int")
    assert sinks.read_keyed(spark, path, rows.schema).collect() == []
    sinks.merge_into(spark, path, rows.filter("false"), ["k"], [F.col("v").asc()])
    assert sinks.read_keyed(spark, path, rows.schema).collect() == []
    sinks.merge_into(spark, path, rows, ["k"], [F.col("v").asc()])
    assert sinks.read_keyed(spark, path, rows.schema).count() == 1


def test_judged_lines_are_stored_as_rows_or_as_text(spark, ws):
    path, stored = ws.new_path("lines"), []
    spark.createDataFrame([('{"id": "a"}',), ("no json",), ("null",)], "value string").write.text(path)
    sources.checked_json(spark, path, lambda df: stored.append(ws.store(df)) or stored[-1])
    assert sorted((r.row is None, r.line) for r in stored[0].collect() if r.line) == [
        (True, "no json"), (True, "null")]
    assert [r.row.id for r in stored[0].collect() if r.line is None] == ["a"]
    assert stored[0].columns == ["row", "line"]


def test_the_catalog_reads_the_stored_tables_themselves(ws):
    from threadloom.plans.registry import QUERIES

    files = QUERIES["src_catalog"](ws).inputFiles()
    assert files and all(f"{ws.root}/source/" in f for f in files)
    assert {f.split("/source/")[1].split("/")[0] for f in files} == {
        "comments_raw", *schemas.RELATIONAL}


def test_copies_are_packed_as_working_tables_are(spark, ws):
    path = ws.new_path("packed")
    sinks.clustered(ws.relational["subreddit"], path, "subreddit_id")
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(path).inputFiles())


def test_stored_and_incoming_rows_compete_in_one_shuffle(spark, ws, monkeypatch):
    """Keys come in repeatedly, NULLs and equal rows included; staged rows are copied as they lie."""
    path, dealt = ws.new_path("dealt"), []
    schema = "k string, v int"
    rows = [(f"k{i}", i) for i in range(200)]
    order = [F.col("v").asc_nulls_last()]
    first = spark.createDataFrame([*rows, *[(k, v + 1) for k, v in rows], (None, 3), (None, 2)], schema)
    sinks.merge_into(spark, path, first, ["k"], order, buckets=8, competing=True)
    assert as_pairs(spark, path, schema) == sorted([*rows, (None, 2)], key=str)
    before = files_of(path)
    write = sinks._write_buckets
    monkeypatch.setattr(sinks, "_write_buckets", lambda *a: dealt.append(a) or write(*a))
    seen = spark.createDataFrame([("k5", 5), ("k6", 60), ("k7", None)], schema)
    assert sinks.merge_into(spark, path, seen, ["k"], order, competing=True) == []
    assert files_of(path) == before
    more = spark.createDataFrame([("k5", -5), ("k5", -4), ("k9", 90), ("new", None)], schema)
    touched = sinks.merge_into(spark, path, more, ["k"], order, competing=True)
    after = files_of(path)
    assert 1 <= len(touched) <= 2 and not dealt
    assert {d for d in before if before[d] != after[d]} == {f"{sinks.BUCKET}8={b}" for b in touched}
    want = {**dict(rows), None: 2, "k5": -5, "new": None}
    assert as_pairs(spark, path, schema) == sorted(want.items(), key=str)


def as_pairs(spark, path, schema):
    empty = spark.createDataFrame([], schema)
    return sorted(map(tuple, sinks.read_keyed(spark, path, empty.schema).collect()), key=str)
