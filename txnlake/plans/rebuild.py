"""Rebuilding the marts, checking them, and loading them into the serving store."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from txnlake.operators import quality
from txnlake.plans import staging
from txnlake.plans.marts import MARTS
from txnlake.sources import serving
from txnlake.sources.tables import Tables


def at_once(job: Callable[[str], object], names: Iterable[str], spark: SparkSession) -> dict:
    """Run one Spark job per mart side by side; the first failure is raised."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        futures = {n: pool.submit(inheritable_thread_target(spark)(job), n) for n in names}
        return {n: f.result() for n, f in futures.items()}


def write_marts(tables: Tables, root: str, names: Iterable[str] = MARTS) -> None:
    spark = next(iter(tables.values())).sparkSession
    at_once(lambda name: serving.write_mart(MARTS[name](tables), root, name), names, spark)


def check_marts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Not-null and uniqueness reports over the stored marts."""
    stored = {name: serving.read_mart(spark, root, name) for name in MARTS}
    return (
        quality.row_checks(stored, quality.MART_NOT_NULL),
        quality.unique_keys(stored, quality.MART_UNIQUE),
    )


def load_marts(
    spark: SparkSession,
    root: str,
    target: serving.ParquetTarget | serving.JdbcTarget,
    names: Iterable[str] = MARTS,
) -> dict[str, bool]:
    """Reload every mart; tells which were loaded and which were empty and skipped."""
    return at_once(
        lambda name: serving.reload_mart(spark, root, name, target), names, spark
    )


def rebuild(tables: Tables, root: str) -> tuple[DataFrame, DataFrame]:
    """Staging views, then all marts, then their checks."""
    staging.create_views(tables)
    write_marts(tables, root)
    return check_marts(next(iter(tables.values())).sparkSession, root)
