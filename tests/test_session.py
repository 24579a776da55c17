import time

from threadloom import session


def test_sizes_grow_with_the_input_and_stay_bounded():
    small, large, huge = (session.sized_settings(b) for b in (10 * session.MB, 10**12, 10**14))
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    assert small[names[0]] == 1
    assert large[names[0]] == 7451
    assert huge == {names[0]: 50_000, names[1]: 500_000_000}


def test_settings_are_only_raised(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        session.prepare(spark, 1)
        assert spark.conf.get(name) == before
        session.prepare(spark, 10**10)
        assert spark.conf.get(name) == "75"
    finally:
        spark.conf.set(name, before)


def test_size_notation():
    assert session._bytes_or_count("134217728b") == 128 * session.MB
    assert session._bytes_or_count("128MB") == session._bytes_or_count("128m") == 128 * session.MB
    assert session._bytes_or_count("200") == 200


def test_tables_lie_in_the_shared_folder(spark, ws):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert ws.root.startswith(configured or "/tmp")
    assert session.path_bytes(spark, ws.path("subreddit")) > 0


def test_shuffle_files_go_when_their_query_has_ended(spark, ws):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllBlocks()
        names = (found.apply(i).name() for i in range(found.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(20_000).selectExpr("id % 700 AS k", "id AS v")
    counts = rows.groupBy("k").count()
    for run in (lambda: counts.write.parquet(ws.new_path("counts")), counts.collect, counts.collect):
        run()
        until = time.time() + 20
        while (left := shuffled() - before) and time.time() < until:
            time.sleep(0.2)
        assert not left
    assert {r[1] for r in counts.collect()} == {28, 29}
