"""Served folders switch from one whole version to the next."""

import pytest

from txnlake import session


def rows(df):
    return sorted(r[0] for r in df.collect())


def test_readers_always_see_a_whole_table(spark, folder, monkeypatch):
    path, put = f"{folder}/mart", lambda n: session.publish_folder(spark.range(n), f"{folder}/mart")
    put(3)
    assert rows(session.published(spark, path)) == [0, 1, 2]
    opened = session.published(spark, path)  # a reader that starts before the switch
    seen, name = [], session._name_version

    def between(*args):
        seen.append(rows(session.published(spark, path)))
        name(*args)

    monkeypatch.setattr(session, "_name_version", between)
    put(5)
    assert seen == [[0, 1, 2]]  # written, not yet switched
    assert rows(session.published(spark, path)) == [0, 1, 2, 3, 4]
    assert rows(opened) == [0, 1, 2]
    put(2)
    assert rows(session.published(spark, path)) == [0, 1]
    assert sorted(session.subfolders(spark, path)) == [2, 3]


def test_a_write_that_breaks_off_changes_nothing(spark, folder, monkeypatch):
    path = f"{folder}/mart"
    session.publish_folder(spark.range(3), path)

    def fail(*args):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(session, "_name_version", fail)
        with pytest.raises(OSError):
            session.publish_folder(spark.range(9), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        session.publish_folder(spark.range(9).selectExpr("1 / (id - 4) as id"), path)
    assert rows(session.published(spark, path)) == [0, 1, 2]
    session.publish_folder(spark.range(1), path)
    assert rows(session.published(spark, path)) == [0]


def test_plain_folders_are_read_as_they_are(spark, folder):
    spark.range(4).write.parquet(f"{folder}/plain")
    assert rows(session.published(spark, f"{folder}/plain")) == [0, 1, 2, 3]
