"""Sizes of tasks and the order of joins that keep working tables from spilling as they grow."""

from threadloom import schemas, session
from threadloom.sources import mapping


def test_tasks_of_working_tables_are_small_whatever_the_session_says(spark):
    names = [*session.TASK_SIZES, "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name) for name in names}
    undo = session.prepare(spark, 6 * 10**9, session.TASK_BYTES)
    try:
        assert [session._bytes_or_count(spark.conf.get(n)) for n in session.TASK_SIZES] == [
            session.TASK_BYTES] * 2
        assert int(spark.conf.get(names[2])) == 358
        huge = session.prepare(spark, 10**13, session.TASK_BYTES)
        assert session._bytes_or_count(spark.conf.get(names[0])) == 50_000_000
        session.restore(spark, huge)
    finally:
        session.restore(spark, undo)
    assert {name: spark.conf.get(name) for name in names} == before


def test_comments_of_a_post_lie_together_after_shuffled_joins(spark, ws, rows_of):
    """Line items meet their order last, and the rows are those of the statement as written."""
    directory = ws.new_path("base")
    n = 200
    frames = {
        "nation": spark.sql("SELECT id AS n_nationkey, concat('N', id) AS n_name FROM range(3)"),
        "customer": spark.sql("SELECT id AS c_custkey, id % 4 AS c_nationkey FROM range(10)"),
        "part": spark.sql("SELECT id AS p_partkey, concat('p', id) AS p_name, 'b' AS p_brand"
                          " FROM range(20) UNION ALL SELECT NULL, 'x', 'y'"),
        "orders": spark.sql(f"SELECT if(id % 9 = 0, NULL, id) AS o_orderkey, id % 11 AS o_custkey,"
                            f" if(id % 2 = 0, 'F', 'O') AS o_orderstatus FROM range({n})"),
        "lineitem": spark.sql(f"SELECT id % {n} AS l_orderkey, id % 3 AS l_linenumber, 'R' AS l_returnflag,"
                              f" id AS l_quantity, id % 21 AS l_partkey, id % 7 AS l_suppkey"
                              f" FROM range({4 * n})"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{directory}/{name}.parquet")
    tables = {t: spark.read.parquet(f"{directory}/{t}.parquet") for t in mapping.BASE_TABLES}
    written = spark.sql(mapping.COMMENTS_SQL, **tables)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "5",
                "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        got = mapping.comments_raw(spark, directory)
        homes = got.selectExpr("link_id", "spark_partition_id() AS p").distinct().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    want = written.select([written[f.name].cast(f.dataType) for f in schemas.FLAT.fields])
    assert rows_of(got) == rows_of(want) and len(homes) > 50
    assert len({r.link_id for r in homes}) == len(homes)
