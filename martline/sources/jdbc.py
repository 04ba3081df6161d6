"""Full table copies from a database, and the report export back into one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def import_jdbc_full(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    columns: Sequence[str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Copy of a table or of a query result, read by ``partitions`` connections when a numeric key is named."""
    options = jdbc_read_options(url, table, query, columns, partition_column, bounds, partitions)
    return spark.read.format("jdbc").options(**options, **(properties or {})).load()


def jdbc_read_options(
    url: str,
    table: str | None,
    query: str | None,
    columns: Sequence[str] | None,
    partition_column: str | None,
    bounds: tuple[int, int] | None,
    partitions: int,
) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    source = query or f"SELECT {', '.join(columns) if columns else '*'} FROM {table}"
    options = {"url": url, "dbtable": f"({source}) src", "fetchsize": "10000"}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its key")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(
    spark: SparkSession, url: str, table: str, column: str, properties: dict[str, str] | None = None
) -> tuple[int, int]:
    """Smallest and largest value of a numeric key, asked of the database as one row."""
    query = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"
    low, high = import_jdbc_full(spark, url, query=query, properties=properties).first()
    return int(low or 0), int(high or 0)


def export_statements(
    table: str, staging: str, columns: Sequence[str], day: str, upsert: bool = False
) -> list[str]:
    """Statements that move a staged day into the report table.

    The default replaces the whole day, which also removes rows a corrected run no longer produces. ``upsert`` keeps
    them and replaces by primary key (MySQL ``REPLACE``).
    """
    names = ", ".join(columns)
    if upsert:
        return [f"REPLACE INTO {table} ({names}) SELECT {names} FROM {staging}"]
    return [
        f"DELETE FROM {table} WHERE dt = '{day}'",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def export_upsert(
    df: DataFrame,
    url: str,
    table: str,
    day: str,
    upsert: bool = False,
    properties: dict[str, str] | None = None,
    run: Callable[[SparkSession, str, Sequence[str], dict[str, str]], None] | None = None,
    stage: Callable[[DataFrame, str, str, dict[str, str]], None] | None = None,
    connections: int = 8,
) -> None:
    """One day of a report into a database through a staging table, so that a failed write leaves the day as it was.

    Reports are small after aggregation; at most ``connections`` write at once.
    """
    properties = properties or {}
    staging = f"{table}_staging"
    rows = df.where(F.col("dt") == F.lit(day)).coalesce(connections)
    (stage or _stage)(rows, url, staging, properties)
    (run or run_in_transaction)(
        df.sparkSession, url, export_statements(table, staging, df.columns, day, upsert), properties
    )


def _stage(rows: DataFrame, url: str, staging: str, properties: dict[str, str]) -> None:
    rows.write.jdbc(url, staging, mode="overwrite", properties=properties)


def run_in_transaction(
    spark: SparkSession, url: str, statements: Sequence[str], properties: dict[str, str]
) -> None:
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    finally:
        connection.close()
