from datetime import date

import pytest
from pyspark.sql import functions as F

from txnlake.session import path_exists
from txnlake.sources import compaction, lake


def days(spark, first, last):
    """Ids spread over three days of January 2024."""
    return spark.range(first, last).selectExpr(
        "id", "concat('t', id % 2) as name",
        "timestamp'2024-01-09 00:00:00' + make_dt_interval(cast(id % 3 as int)) as _ingested_at",
    )


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def files_by_day(spark, path):
    found = compaction.live_files(spark, path).groupBy("folder").count().collect()
    return {r["folder"][-3:-1]: r["count"] for r in found}


@pytest.fixture
def path(spark, folder):
    root = f"{folder}/raw"
    for i in range(5):
        lake.write_day_partitions(days(spark, i * 30, i * 30 + 30), root)
    return root


def test_closed_days_become_one_file_and_lose_no_row(spark, path):
    assert files_by_day(spark, path) == {"09": 5, "10": 5, "11": 5}
    assert compaction.compact(spark, path, date(2024, 1, 11)) == 10
    assert files_by_day(spark, path) == {"09": 1, "10": 1, "11": 5}
    assert ids(compaction.read_compacted(spark, path)) == list(range(150))
    some = compaction.read_compacted(spark, path, date(2024, 1, 10), date(2024, 1, 10))
    assert ids(some) == [i for i in range(150) if i % 3 == 1]
    assert compaction.compact(spark, path, date(2024, 1, 11)) == 0


def test_late_rows_are_read_at_once_and_compacted_next(spark, path):
    compaction.compact(spark, path, date(2024, 1, 11))
    lake.write_day_partitions(days(spark, 150, 180), path)
    assert ids(compaction.read_compacted(spark, path)) == list(range(180))
    assert compaction.compact(spark, path, date(2024, 1, 11)) == 4
    assert files_by_day(spark, path) == {"09": 1, "10": 1, "11": 6}
    assert ids(compaction.read_compacted(spark, path)) == list(range(180))


def test_a_reader_between_two_steps_sees_each_row_once(spark, path, monkeypatch):
    early = compaction.read_compacted(spark, path)
    seen = []
    announce = compaction._announce

    def watched(*args):
        seen.append(ids(compaction.read_compacted(spark, path)))  # files written, not announced
        announce(*args)

    monkeypatch.setattr(compaction, "_announce", watched)
    compaction.compact(spark, path, date(2024, 1, 12))
    assert seen == [list(range(150))]
    assert ids(early) == list(range(150))
    lake.write_day_partitions(days(spark, 150, 160), path)
    middle = compaction.read_compacted(spark, path)
    compaction.compact(spark, path, date(2024, 1, 12))
    # Files of the first compaction's input go; a reader of the version before needs none of them.
    assert compaction.drop_replaced(spark, path) == 15
    assert ids(middle) == list(range(160)) == ids(compaction.read_compacted(spark, path))


def test_a_failed_run_changes_nothing(spark, path, monkeypatch):
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(compaction, "_announce", lost)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, path, date(2024, 1, 12))
    assert ids(compaction.read_compacted(spark, path)) == list(range(150))
    assert compaction.compact(spark, path, date(2024, 1, 12)) == 15
    assert ids(compaction.read_compacted(spark, path)) == list(range(150))


def test_size_decides_how_many_files(spark, folder):
    root = f"{folder}/raw"
    wide = days(spark, 0, 3000).withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    for i in range(4):
        lake.write_day_partitions(wide.where(F.col("id") % 4 == i), root)
    sizes = [r["bytes"] for r in compaction.live_files(spark, root).collect()]
    compaction.compact(spark, root, date(2024, 1, 12), target_bytes=int(max(sizes) * 2.1))
    after = compaction.live_files(spark, root).groupBy("folder").count().collect()
    assert [r["count"] for r in after] == [2, 2, 2]
    # A file at least half as large as wanted is left as it is.
    assert compaction.compact(spark, root, date(2024, 1, 12), target_bytes=min(sizes)) == 0
    assert ids(compaction.read_compacted(spark, root)) == list(range(3000))


def test_tables_side_by_side_and_a_streamed_lake(spark, folder):
    root = f"{folder}/raw"
    rows = days(spark, 0, 60).withColumn("table_name", F.col("name"))
    for _ in range(2):
        lake.write_day_partitions(rows, root)
    assert compaction.compact(spark, root, date(2024, 1, 12)) == 12
    assert compaction.live_files(spark, root).count() == 6
    assert ids(compaction.read_compacted(spark, root)) == sorted([*range(60), *range(60)])

    streamed, source = f"{folder}/streamed", f"{folder}/source"
    for i in range(3):
        lake.with_day(days(spark, i * 9, i * 9 + 9)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        stream.writeStream.partitionBy(*lake.DAY).format("parquet").option("path", streamed).option(
            "checkpointLocation", f"{folder}/cp"
        ).trigger(availableNow=True).start().awaitTermination()
    assert path_exists(spark, f"{streamed}/_spark_metadata")
    assert compaction.compact(spark, streamed, date(2024, 1, 12)) == 9
    assert files_by_day(spark, streamed) == {"09": 1, "10": 1, "11": 1}
    assert ids(compaction.read_compacted(spark, streamed)) == list(range(27))
