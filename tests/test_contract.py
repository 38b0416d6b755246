import __spark_entry__ as entry


def test_names_agree():
    q, c = entry.queries(), entry.oracle_sql()
    assert set(c) <= set(q) and len(q) > 100


def test_flagship(spark):
    df = entry.entry(spark)
    assert sorted(df.columns) == sorted(["trio", "species", "mutType", "mutNum", "totalRootNum"])
    assert df.count() == 4 * 192
