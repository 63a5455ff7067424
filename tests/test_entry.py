import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 11
    assert {"column", "count", "null_count", "total", "stddev"} <= set(df.columns)


def test_every_twin_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 94


def test_rows_only_queries_are_few():
    qs, sql = entry.queries(), entry.oracle_sql()
    rows_only = {n for n in set(qs) - set(sql) if not n.startswith("op") and n != "pipeline"}
    assert sorted(rows_only) == ["elastic_net_mae", "score_batches"]
