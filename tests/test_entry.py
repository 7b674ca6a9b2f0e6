import __spark_entry__ as entry


def test_entry_has_rows_and_the_feature_contract(spark):
    from surgeline.schema import FEATURE_COLUMNS

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(FEATURE_COLUMNS) <= set(df.columns)


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100
