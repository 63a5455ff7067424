from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm.common import materialise, read_table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_shrink(spark):
    docs = read_table(spark, SF, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, SF), "t")
        assert out.dtypes == docs.dtypes
        rows = out.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows) <= docs.count()
        if name != "personal_data":
            assert all(r == before[r["doc_id"]] for r in rows)
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_stages_take_empty_and_null_documents(spark):
    docs = read_table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (5, "a b c", None, None, None),
                                 (5, "a b c", None, None, None)], docs.schema)
    for start in (docs.where("doc_id < 0"), odd):
        cur = start
        for _, stage in corpus_pipeline.STAGES:
            cur = materialise(stage(spark, cur, SF), "t")
        cur.collect()


def test_stages_return_extra_columns_untouched(spark):
    docs = read_table(spark, SF, "documents")
    names = ["k", "_leak", "_kid", "_lid", "score", "predicted", "n_entities", "a.b", "other_1_column", "_sim2", "q`t"]
    long = docs.limit(1).withColumn("doc_id", F.lit(10**9)).withColumn("text", F.concat(F.repeat(F.lit("some words that go on. "), 20000), "text"))
    more = docs.unionByName(long).select("*", *[(F.col("doc_id") * 100 + i).cast("string").alias(n) for i, n in enumerate(names)])
    cur = more
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, cur, SF), "t")
        assert out.dtypes == more.dtypes, name
        for r in out.collect():
            assert [r[n] for n in names] == [str(r["doc_id"] * 100 + i) for i in range(len(names))], name
        cur = out
    assert corpus_pipeline.STAGES[-1][1](spark, cur, SF).select("doc_id").distinct().count() == cur.count()
