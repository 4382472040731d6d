import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year_month", "gmv", "orders", "rural_gmv", "urban_gmv"]


def test_registry_names_are_unique_and_callable():
    q = E.queries()
    assert len(q) > 100
    assert all(callable(f) for f in q.values())
