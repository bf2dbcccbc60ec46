"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. Shuffle partition counts are left to
# the cluster: AQE coalesces small partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "txnlake", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster,
    executors could not see it and it would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = os.environ.get("TXNLAKE_LOCAL_SCRATCH") or tempfile.mkdtemp(prefix="txnlake-")
    os.environ["TXNLAKE_LOCAL_SCRATCH"] = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark).rstrip('/')}/txnlake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the scratch folder and read back: computed once, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def subfolders(spark: SparkSession, path: str) -> dict[int, str]:
    """Folders named ``<name>=<number>`` below a path, by number; nothing where it is missing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(at):
        return {}
    names = [status.getPath().getName() for status in store.listStatus(at) if status.isDirectory()]
    return {int(n.rsplit("=", 1)[1]): f"{path}/{n}" for n in names if n.rsplit("=", 1)[-1].isdigit()}


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_file(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)


_CURRENT = "CURRENT"


def publish_folder(df: DataFrame, path: str) -> None:
    """Put ``df`` at ``path`` as a new version, which readers see from one moment to the next.

    The version is written whole first; then the file that names the current one is replaced in one
    step. A write that fails changes nothing. The version before it stays for readers that have
    found it; older ones go.
    """
    spark = df.sparkSession
    versions = subfolders(spark, path)
    before = _current_version(spark, path)
    number = max(versions, default=0) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    _name_version(spark, path, number)
    for old, folder in versions.items():
        if old != before:
            remove_folder(spark, folder)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published folder; a plain folder as it is."""
    number = _current_version(spark, path)
    return spark.read.parquet(path if number is None else f"{path}/version={number}")


def _current_version(spark: SparkSession, path: str) -> int | None:
    if not path_exists(spark, f"{path}/{_CURRENT}"):
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_CURRENT}")
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _name_version(spark: SparkSession, path: str, number: int) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    fresh, named = hadoop.Path(f"{path}/.{_CURRENT}.{uuid.uuid4().hex}"), hadoop.Path(f"{path}/{_CURRENT}")
    conf = spark._jsc.hadoopConfiguration()
    out = fresh.getFileSystem(conf).create(fresh)
    out.writeBytes(str(number))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    qualified = fresh.getFileSystem(conf).makeQualified(fresh)
    hadoop.FileContext.getFileContext(qualified.toUri(), conf).rename(fresh, named, overwrite)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply settings for the block; streaming queries capture them at start."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
