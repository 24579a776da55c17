from collections import Counter

import duckdb
import pytest

from threadloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, data_directory, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_directory}/{table}.parquet'")
    df = queries.QUERIES[name](spark, data_directory)
    columns = sorted(df.columns)
    result = connection.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = Counter(tuple(str(row[i]) for i in order) for row in result.fetchall())
    assert Counter(tuple(str(r[c]) for c in columns) for r in df.collect()) == wanted
