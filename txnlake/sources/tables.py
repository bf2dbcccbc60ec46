"""Reading the source tables from Parquet or over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake import fixed_values as fixed
from txnlake.schemas import TABLE_SCHEMAS
from txnlake.session import is_file

Tables = Mapping[str, DataFrame]


class LazyTables(Mapping):
    """Tables by name, each defined when first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def read_tables(spark: SparkSession, root: str) -> LazyTables:
    """All 13 tables from ``<root>/<table>``, with their declared schemas."""

    def reader(name: str, schema: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")

    return LazyTables({name: reader(name, schema) for name, schema in TABLE_SCHEMAS.items()})


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel slices of its key range."""
    return (
        spark.read.format("jdbc")
        .options(**dict(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .option("fetchsize", 10_000)
        .load()
    )


def values_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Literal rows as an inline table: a local relation whose size the planner knows."""
    schema = T.StructType.fromDDL(ddl)

    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, int):
            return str(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) {f.name}" for f in schema)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(schema.names)})")


def lookup_tables(spark: SparkSession) -> LazyTables:
    """The literal lookups; surrogate ids count from 1."""

    def table(rows: list[tuple], name: str, numbered: bool = True) -> Callable[[], DataFrame]:
        keyed = [(i, *r) for i, r in enumerate(rows, 1)] if numbered else rows
        return lambda: values_table(spark, keyed, TABLE_SCHEMAS[name])

    return LazyTables(
        {
            "transaction_types": table(fixed.TRANSACTION_TYPES, "transaction_types"),
            "transaction_statuses": table(fixed.TRANSACTION_STATUSES, "transaction_statuses"),
            "card_networks": table(fixed.CARD_NETWORKS, "card_networks"),
            "merchant_categories": table(fixed.MERCHANT_CATEGORIES, "merchant_categories", False),
        }
    )


def row_counts(tables: Tables) -> DataFrame:
    """One row per table: ``table_name, n_rows``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A file stream over a Parquet table, a folder or a single file.

    File streams take folders and patterns only, so a file goes in as a pattern that fits
    nothing but itself.
    """
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]" if is_file(spark, path) else path
    return spark.readStream.schema(schema).options(**options).parquet(pattern)
