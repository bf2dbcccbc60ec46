"""Compaction of closed lake days, with a manifest that readers follow.

A stream leaves a file per task and micro-batch. ``compact`` rewrites the small files of days
before a date into files near a wanted size, in a folder beside the lake, and then names in one step
(``publish_folder``) a manifest of the files it replaced and those it added. A reader takes one
version of the manifest and reads the lake's files without the replaced ones, and the added ones:
it sees each row once before, during and after a compaction, and rows that arrive late for a closed
day at once. The next run rewrites those too. One compactor per lake folder at a time.
"""

from __future__ import annotations

import re
import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import path_exists, published, publish_folder, remove_file
from txnlake.sources.lake import DAY, in_days

TARGET_BYTES = 128 << 20
MANIFEST_DDL = "file string, added boolean, version int"
#: The partition folders in a file's path, such as ``year=2024/month=01/day=09/``.
FOLDERS = r"((?:\w+=[^/]*/)+)[^/]+$"


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_compacted"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    at = f"{_beside(path)}/manifest"
    return published(spark, at) if path_exists(spark, at) else spark.createDataFrame([], MANIFEST_DDL)


def _names(rows: DataFrame) -> list[str]:
    """Files of a scan, as Hadoop prints paths."""
    return [re.sub(r"^(\w+):///", r"\1:/", f) for f in rows.inputFiles()]


def _live(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], list[str]]:
    """The lake as it is on disk, its files that no manifest replaced, and the added files.

    Names only, as Spark's own file listing holds them.
    """
    entries = _manifest(spark, path).collect()
    replaced = {r["file"] for r in entries if not r["added"]}
    raw = spark.read.parquet(path)
    return raw, [f for f in _names(raw) if f not in replaced], [r["file"] for r in entries if r["added"]]


def _read(raw: DataFrame, path: str, lake_files: list[str], added: list[str]) -> DataFrame:
    """Rows of the given files with the columns of the lake, and ``_file``."""
    spark, parts = raw.sparkSession, []
    for base, files in ((path, lake_files), (f"{_beside(path)}/files", added)):
        if files:
            rows = spark.read.schema(raw.schema).option("basePath", base).parquet(*files)
            parts.append(rows.select(*raw.columns, F.col("_metadata").alias("_file")))
    if not parts:
        return raw.select("*", F.col("_metadata").alias("_file")).where(F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def read_compacted(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The lake below ``path`` by one version of its manifest, each row once."""
    raw, lake_files, added = _live(spark, path)
    lake = _read(raw, path, lake_files, added).drop("_file")
    return lake.where(in_days(first or date.min, last or date.max)) if first or last else lake


def _folder(file: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(file, FOLDERS, 1), "^(compacted_(run|bin)=[^/]*/)+", "")


def file_sizes(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file, folder, bytes``; tasks ask the store, nothing is opened."""
    if not files:
        return spark.createDataFrame([], "file string, folder string, bytes bigint")
    listed = spark.read.format("binaryFile").load(files)
    return listed.select(
        F.col("path").alias("file"), _folder(F.col("path")).alias("folder"), F.col("length").alias("bytes")
    )


def _day_of(folder: str) -> Column:
    part = lambda name: F.regexp_extract(folder, rf"{name}=(\d+)", 1)
    return F.make_date(*[part(name).cast("int") for name in DAY])


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, folder, bytes`` of what a reader would read now."""
    _, lake_files, added = _live(spark, path)
    return file_sizes(spark, [*lake_files, *added])


def compact(spark: SparkSession, path: str, before: date, target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite the small files of days before ``before``; returns how many files were replaced.

    Small is under half the target. A folder (day, or table and day) with one small file or
    none is left alone, so a run with nothing to do writes nothing. A run that fails leaves files that
    no manifest names, which no reader sees.
    """
    raw, lake_files, added = _live(spark, path)
    small = (
        file_sizes(spark, [*lake_files, *added])
        .where((F.col("bytes") < target_bytes // 2) & (_day_of("folder") < F.lit(before)))
    )
    by_folder = small.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.ceil(F.sum("bytes") / target_bytes).cast("int").alias("bins")
    ).where("n > 1")
    chosen = small.join(by_folder, "folder").select("file", "folder", "bins").collect()
    if not chosen:
        return 0
    names = {r["file"] for r in chosen}
    bins = spark.createDataFrame(
        sorted({(r["folder"], r["bins"]) for r in chosen}), "_folder string, _bins int"
    )
    rows = _read(raw, path, [f for f in lake_files if f in names], [f for f in added if f in names])
    # Bins by place in the files, so that a task run again deals the same rows.
    place = F.xxhash64("_file.file_path", "_file.file_block_start", "_file.row_index")
    dealt = (
        rows.withColumn("_folder", _folder(F.col("_file.file_path")))
        .join(bins, "_folder")
        .withColumn("compacted_bin", F.pmod(place, F.col("_bins")))
        .repartition("_folder", "compacted_bin")
    )
    partition_columns = re.findall(r"(\w+)=", chosen[0]["folder"])
    partition_columns = [c for c in partition_columns if c in raw.columns]
    run = f"{_beside(path)}/files/compacted_run=r{uuid.uuid4().hex}"
    padded = [F.lpad(F.col(c).cast("string"), 4 if c == "year" else 2, "0").alias(c) if c in DAY else F.col(c)
              for c in raw.columns]
    # A folder for each bin: bins that share a task stay files of their own.
    binned = dealt.select("compacted_bin", *padded)
    binned.write.partitionBy("compacted_bin", *partition_columns).parquet(run)
    _announce(spark, path, names, _names(spark.read.schema(raw.schema).parquet(run)))
    return len(names)


def _announce(spark: SparkSession, path: str, replaced: set[str], added: list[str]) -> None:
    old = _manifest(spark, path)
    version = (old.agg(F.max("version")).first()[0] or 0) + 1
    fresh = [(f, False, version) for f in replaced] + [(f, True, version) for f in added]
    news = spark.createDataFrame(fresh, MANIFEST_DDL)
    kept = old.join(news.where("NOT added"), "file", "left_anti").select(*old.columns)
    publish_folder(kept.unionByName(news), f"{_beside(path)}/manifest")


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete files replaced before the last compaction; returns how many are listed as such.

    Readers of the current manifest and of the one before it need none of them. From then on the
    lake must be read by ``read_compacted``: a stream's own log still names deleted files.
    """
    manifest = _manifest(spark, path)
    newest = manifest.agg(F.max("version")).first()[0] or 0
    old = manifest.where(~F.col("added") & (F.col("version") < newest)).select("file").collect()
    for row in old:
        remove_file(spark, row["file"])
    return len(old)
