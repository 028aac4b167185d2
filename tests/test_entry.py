"""Driver contract: keys line up, the flagship runs on sf0.001."""

import __spark_entry__ as E


def test_oracle_keys_are_registered_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 56


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["step", "row", "n", "x"]
    rows = df.collect()
    assert rows and all(r.n == 1024 for r in rows)
