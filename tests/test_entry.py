import __spark_entry__ as entry_module


def test_names_and_flagship(spark):
    names = entry_module.queries()
    assert set(entry_module.oracle_sql()) <= set(names) and len(names) >= 60
    assert entry_module.entry(spark).count() > 0
