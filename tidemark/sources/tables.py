"""Lake and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Contract


def read_lake(spark: SparkSession, path: str, contract: Contract | None = None) -> DataFrame:
    """A Parquet table below ``path``.

    With a contract its schema is the table's: a column added after a file was
    written reads as NULL there, no file is rewritten, and no footers have to
    be merged to learn the schema.
    """
    if contract is None:
        return spark.read.parquet(path)
    return spark.read.schema(contract.schema).parquet(path).select(*contract.names)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a relational read, split over a numeric or date column if given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if not bounds:
            raise ValueError("a split read needs the bounds of its column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A relational table. Filters, columns and limits are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load()
