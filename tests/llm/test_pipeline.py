from collections import Counter

import corpus_pipeline
from threadloom.llm import decontaminate, queries, simhash, token_pack, toxicity
from threadloom.llm.common import stored, table


def test_stages_agree_with_their_operators(spark, data_directory):
    docs = table(spark, data_directory, "documents")
    columns = docs.columns
    labels = table(spark, data_directory, "labels")
    benchmark = table(spark, data_directory, "benchmark")
    steps = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stored(stage(spark, current, data_directory), name)
        assert current.columns == columns
        steps[name] = current
    ids = {name: Counter(r.doc_id for r in frame.select("doc_id").collect())
           for name, frame in steps.items()}
    calm = {r.doc_id for r in toxicity.op9(docs, labels).collect() if not r.predicted}
    assert set(ids["toxicity"]) == calm
    groups = {r.component_id for r in simhash.op6(steps["toxicity"]).collect()}
    assert ids["simhash_near_dedup"] == Counter(groups)
    leaks = {r.doc_id for r in decontaminate.op5(steps["simhash_near_dedup"], benchmark).collect()}
    assert set(ids["benchmark_decontamination"]) == groups - leaks
    assert max(ids["mixing"].values()) <= 2
    assert set(ids["mixing"]) <= set(ids["benchmark_decontamination"])
    last = corpus_pipeline.STAGES[-1][1](spark, steps["mixing"], data_directory)
    assert Counter(r.doc_id for r in last.collect()) == ids["mixing"]


def test_run_gives_the_last_stage(spark, data_directory):
    rows = corpus_pipeline.run(spark, data_directory)
    want = token_pack.op8(table(spark, data_directory, "documents"), queries.tokenizer_path())
    assert rows.columns == want.columns
    total = 0
    for r in sorted(rows.collect(), key=lambda r: r.start):
        assert r.start == total
        total += r.n_tokens


def written(spark, folder, documents, labels, benchmark):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return str(folder)


def test_empty_tables_through_all_stages(spark, documents, tmp_path):
    folder = written(spark, tmp_path, documents().filter("false"), [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_odd_rows_through_all_stages(spark, documents, odd_rows, tmp_path):
    leak = (77, "one two three four five six seven eight nine ten eleven twelve thirteen")
    folder = written(spark, tmp_path, documents(*odd_rows, leak), [(r[0], 0) for r in odd_rows],
                     [(1, leak[1]), (2, None)])
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r.doc_id for r in rows} <= {r[0] for r in odd_rows}
    assert sorted(r.start for r in rows)[0] == 0 and all(r.n_tokens > 0 for r in rows)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
