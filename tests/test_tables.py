from txnlake.sources.tables import LazyTables, read_tables, values_table


def test_inline_rows_keep_quotes_and_backslashes(spark):
    rows = [("it's", 1), ("a\\b", None), (None, 3)]
    got = values_table(spark, rows, "name string, n bigint").collect()
    assert [tuple(r) for r in got] == rows


def test_lazy_tables_build_once_and_only_when_asked():
    built = []
    tables = LazyTables({n: (lambda n=n: built.append(n) or n.upper()) for n in "abc"})
    assert list(tables) == ["a", "b", "c"] and not built
    assert tables["b"] == tables["b"] == "B" and built == ["b"]


def test_tables_read_with_their_schemas(spark, tables, folder):
    tables["transaction_statuses"].write.parquet(f"{folder}/transaction_statuses")
    read = read_tables(spark, folder)
    assert len(read) == 13
    assert read["transaction_statuses"].count() == 7
