import random

from pyspark.sql import functions as F

from threadloom.operators.ranking import (
    bounded_groups,
    dense_row_number,
    first_per_key,
    heavy_keys,
    reverse_row_order,
    row_order,
)


def test_first_and_last_row_with_nulls(spark):
    df = spark.createDataFrame(
        [("k", None, "a", 1), ("k", 5, "b", 2), ("k", 5, "a", None), ("k", 5, "a", 3)],
        "key string, created_utc int, name string, v int",
    )
    first = first_per_key(df, ["key"], row_order(["v"])).first()
    last = first_per_key(df, ["key"], reverse_row_order(["v"])).first()
    assert (first.created_utc, first.name, first.v) == (5, "a", 3)
    assert (last.created_utc, last.name, last.v) == (None, "a", 1)


def test_limit_runs_before_the_shuffle(ws):
    from threadloom.operators import normalize

    plan = normalize.users(ws.flat)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.index("row_number(), 1, Final") < physical.index("Exchange hashpartitioning")
    assert physical.index("Exchange hashpartitioning") < physical.index("row_number(), 1, Partial")


def test_heavy_keys_are_bounded(spark):
    df = spark.range(10000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    )
    assert [r.k for r in heavy_keys(df, ["k"]).collect()] == [0]
    assert heavy_keys(df, ["k"], 0.0001).count() <= 10000


def test_bounded_groups_with_one_dominant_key(spark):
    random.seed(3)
    rows = [("hot" if random.random() < 0.4 else f"k{random.randrange(400)}",
             random.randrange(500), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    order = [F.col("t").asc(), F.col("i").asc()]
    got = {(r.k, r.i): r._rank for r in bounded_groups(df, ["k"], order, 7).collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        for rank, row in enumerate(sorted((t, i) for k, t, i in rows if k == key)[:7], 1):
            expected[key, row[1]] = rank
    assert got == expected


def test_dense_row_number(spark, ws):
    rows = [(random.Random(i).choice("abc"), i % 5, "same") for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, c string").repartition(6)
    got = dense_row_number(
        df, [F.col("a").asc(), F.col("b").desc()], "n", ws.store
    ).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 301))
    assert [(r.a, r.b) for r in got] == sorted(((a, b) for a, b, _ in rows), key=lambda x: (x[0], -x[1]))


def test_dense_row_number_of_nothing(spark, ws):
    df = spark.createDataFrame([], "a string")
    assert dense_row_number(df, [F.col("a").asc()], "n", ws.store).count() == 0


def test_dominant_join_key_is_split(spark, ws):
    """A link with a third of all comments is read by several tasks of the join."""
    from threadloom.operators import normalize

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    hot = ws.store(ws.flat.repartition(8).withColumn(
        "link_id", F.when(F.col("created_utc") % 3 == 0, "t3_hot").otherwise(F.col("link_id"))
    ))
    links = ws.store(hot.select("link_id").distinct())
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = normalize.linked_comments(hot, links)
        assert joined.count() == hot.count()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_large_groups_are_cut_before_the_shuffle(spark, ws):
    from threadloom.operators.ranking import bounded_groups

    cut = bounded_groups(ws.flat.select("link_id", "id"), ["link_id"], [F.col("id").asc()], 5000)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
