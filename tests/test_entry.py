def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 40 and df.columns == ["rank", "feature", "f_score"]
    assert set(E.oracle_sql()) <= set(E.queries())
