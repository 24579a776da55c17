import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import dependencies


@pytest.fixture(scope="module")
def random_table(spark):
    random.seed(5)
    pick = lambda *v: random.choice(v)
    rows = [(pick("a", "b", "c", None), pick(1, 2, None), pick("x", None), pick("u", "v"), i)
            for i in range(60)]
    return rows, spark.createDataFrame(rows, "k string, n int, one string, two string, id int")


def brute(rows, xs, ys):
    groups = {}
    for row in rows:
        key = tuple(row[x] for x in xs)
        if None not in key:
            groups.setdefault(key, []).append(row)
    bad = sum(any(len({r[y] for r in g} - {None}) > 1 for y in ys) for g in groups.values())
    return bad == 0 and bool(groups), bad, len(groups)


def test_check_against_brute_force(random_table):
    rows, df = random_table
    names = df.columns
    for xs, ys in [([0], [1]), ([0], [2]), ([0, 1], [2, 3]), ([4], [0, 1, 2, 3]), ([2], [0])]:
        got = dependencies.check(df, [names[x] for x in xs], [names[y] for y in ys]).first()
        assert (got.holds, got.violations, got.total_groups) == brute(rows, xs, ys)


def test_check_each_matches_single_checks(random_table):
    rows, df = random_table
    for row in dependencies.check_each(df, "k", ["n", "one", "two"]).collect():
        assert (row.holds, row.violations, row.total_groups) == brute(
            rows, [0], [df.columns.index(row.dependent)])


def test_nothing_to_check_does_not_hold(spark):
    for rows in ([], [(None, 1)]):
        df = spark.createDataFrame(rows, "x string, y int")
        got = dependencies.check(df, ["x"], ["y"]).first()
        assert (got.holds, got.violations, got.total_groups) == (False, 0, 0)


def test_examples_are_few_and_ordered(spark):
    df = spark.createDataFrame(
        [(k, v, "z") for k in ("a", "b", "c", "d") for v in (10, 9, 8, 7)] + [("0", 1, "z")],
        "x string, y int, w string")
    got = sorted((r.determinant_value, r.dependent_column, r.dependent_values)
                 for r in dependencies.examples(df, "x", ["y"]).collect())
    assert got == [(k, "y", ["7", "8", "9"]) for k in ("a", "b", "c")]
    first = dependencies.examples(df, "x", ["w", "y"]).collect()
    assert {r.dependent_column for r in first} == {"y"}


def test_keys_and_uniqueness(spark):
    df = spark.createDataFrame(
        [(i, f"k{i}", None if i == 0 else i, i % 95, i % 10) for i in range(100)],
        "id int, key string, nearly int, mostly int, few int")
    unique = {r.column_name: r.distinct_count for r in dependencies.uniqueness("t", df).collect()}
    assert unique == {"id": 100, "key": 100, "nearly": 99, "mostly": 95}
    keys = dependencies.candidate_keys("t", df, ["id"]).collect()
    assert [r.column_name for r in keys] == ["key"]
    deps = dependencies.candidate_dependencies("t", df, ["id"]).collect()
    assert [(r.determinant, r.dependent) for r in deps] == [("key", "nearly, mostly, few")]
    found = dependencies.discover({"t": df, "empty": df.limit(0)}, {"t": ["id"]})
    assert dependencies.summary({"t": df, "empty": df.limit(0)}, found).first().asDict() == {
        "total_tables": 1, "total_fds": 2}


def test_primary_key_is_listed_only_if_it_holds(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    assert dependencies.primary_key("t", df, ["id"]).count() == 0
    assert dependencies.primary_key("t", df.filter("v <> 'b'"), ["id"]).count() == 1


def test_shape_of_domain_dependencies(ws):
    found = {(r.determinant, r.dependent): r.holds
             for r in dependencies.domain("comments_raw", ws.flat).collect()}
    assert len(found) == 9
    assert not found["link_id", "author"] and not found["author", "author_flair_text"]
    assert found["link_id", "subreddit_id"] and found["id", "link_id"]


def test_examples_of_several_dependents_at_once(ws):
    def rows(df):
        return sorted((r.determinant_value, r.dependent_column, tuple(r.dependent_values))
                      for r in df.collect())

    ys = ["author", "created_utc", "subreddit_id"]
    alone = [r for y in ys for r in rows(dependencies.examples(ws.flat, "link_id", [y]))]
    assert rows(dependencies.examples_each(ws.flat, "link_id", ys)) == sorted(alone)


def test_tables_without_domain_columns_have_no_examples(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert dependencies.domain_examples("t", df).count() == 0
    assert dependencies.domain("t", df).count() == 0


def test_uniqueness_of_tiny_tables_with_an_empty_string(spark):
    for values in ([""], ["", "a"], ["", "a", "b"], ["", "a", "b", "c"]):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        got = dependencies.uniqueness("t", df).collect()
        assert [(r.distinct_count, r.row_count) for r in got] == [(len(values), len(values))]


def test_checks_use_hash_aggregates(ws):
    from threadloom.plans.registry import QUERIES

    for name in ("fd_check", "fd_domain", "fd_primary_key", "fd_examples", "fd_candidate_keys"):
        plan = QUERIES[name](ws)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        if name != "fd_examples":  # lists of a few examples are collected there
            assert "SortAggregate" not in plan


def test_columns_with_a_repeated_value_are_not_counted_whole(spark):
    df = spark.sql("SELECT id, id % 5000 AS twice, if(id = 3, NULL, id) AS gap, concat('v', id) AS name,"
                   " if(id = 9999, 0, id) AS once FROM range(10000)")
    assert {"twice", "gap"} <= set(dependencies.not_unique(df)) <= {"twice", "gap", "once"}
    found = dependencies.candidate_keys("t", df, ["id"])
    assert [r.column_name for r in found.collect()] == ["name"]
    assert "twice" not in found._jdf.queryExecution().optimizedPlan().toString()
    none = dependencies.candidate_keys("t", df.select("id", "twice"), ["id"])
    assert none.dtypes == found.dtypes and none.count() == 0
    assert dependencies.candidate_keys("t", df.select("id"), ["id"]).count() == 0
    assert dependencies.candidate_keys("t", df.filter("false"), ["id"]).count() == 0


def test_values_that_share_a_hash_are_still_told_apart(spark, random_table, monkeypatch):
    rows, df = random_table
    monkeypatch.setattr(dependencies, "_code", lambda df, column: F.lit(7))
    for row in dependencies.check_each(df, "k", ["n", "one", "two"]).collect():
        assert (row.holds, row.violations, row.total_groups) == brute(
            rows, [0], [df.columns.index(row.dependent)])


def test_few_repeated_determinants_among_many(spark):
    rows = [(i, "a", None) for i in range(2000)] + [(7, "b", "x"), (8, "a", "x"), (None, "c", "y")]
    df = spark.createDataFrame(rows, "k long, one string, two string")
    assert dependencies._seldom_repeats(df.filter("k IS NOT NULL"), ["k"])
    got = {r.dependent: r for r in dependencies.check_each(df, "k", ["one", "two"]).collect()}
    for name, place in (("one", 1), ("two", 2)):
        assert (got[name].holds, got[name].violations, got[name].total_groups) == brute(
            rows, [0], [place])


def test_a_determinant_is_shuffled_once_with_its_dependents(spark, capsys):
    """Rows met their repeated values in a join, and distinct values were shuffled twice, before."""
    df = spark.range(2000).selectExpr(
        "string(id % 500) AS k", "string(id % 3) AS one", "string(id % 5) AS two")
    dependencies.check_each(df, "k", ["one", "two"]).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "distinct" not in plan and plan.count("hashpartitioning") == 1
