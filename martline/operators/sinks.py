"""Writers. Each replaces exactly the days it is given, so every job can be run again."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.dates import OPEN_END, shift
from martline.sources.files import day_path, read_table, read_tsv, write_tsv

# Fixed value: how a text table writes NULL.
TSV_NULL = "\\N"


class EmptyPartition(RuntimeError):
    """A day partition that should hold rows holds none."""


def overwrite_partition(df: DataFrame, path: str, day: str) -> None:
    """Replace one day, also by nothing. The rows must not come from the partition being replaced."""
    df.drop("dt").write.mode("overwrite").orc(day_path(path, day), compression="snappy")


def overwrite_dynamic(df: DataFrame, path: str) -> None:
    """Replace every day that occurs in the rows and leave the others.

    The rebalance sizes files per day; a day that holds most of the rows is split over several tasks.
    """
    (
        df.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .orc(path, compression="snappy")
    )


def write_version(df: DataFrame, path: str, day: str, spread: bool = False) -> None:
    """Result of one run of a self-updating table: its open rows and the rows it closed, by ``dt``.

    Each run day has its own folder, so a run reads the folder of the day before and never the one it replaces. An
    open set that became empty leaves no stale partition behind. :func:`prune_versions` deletes open rows that no
    later run needs. ``spread`` is for a first load, whose tasks hold rows of every day: it brings each day together
    first. A daily run closes rows of few days and spares its open rows that shuffle.
    """
    (
        (df.hint("rebalance", "dt") if spread else df).write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("dt")
        .orc(_version_path(path, day), compression="snappy")
    )


def read_version(spark: SparkSession, path: str, day: str, schema: T.StructType) -> DataFrame:
    """Open rows after the run of ``day``, and the rows that run closed."""
    return spark.read.schema(schema).orc(_version_path(path, day))


def read_history(spark: SparkSession, path: str, day: str, schema: T.StructType) -> DataFrame:
    """The whole table as of the run of ``day``: all rows closed so far and the rows open after that run."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).orc(path)
    closed = (F.col("run") <= F.lit(day)) & (F.col("dt") != F.lit(OPEN_END))
    return rows.where(closed | ((F.col("run") == F.lit(day)) & (F.col("dt") == F.lit(OPEN_END)))).drop("run")


def prune_versions(spark: SparkSession, path: str, day: str, keep_days: int = 7) -> list[str]:
    """Delete the open rows of runs more than ``keep_days`` before ``day``, and return these runs' days.

    What the runs closed stays, so the history is whole. The last ``keep_days`` days can still be run again.
    """
    fs, root = _hadoop(spark, path)
    oldest, gone = shift(day, -keep_days), []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if name.startswith("run=") and name[4:] < oldest:
            rows = fs.makeQualified(status.getPath()).suffix(f"/dt={OPEN_END}")
            if fs.exists(rows) and fs.delete(rows, True):
                gone.append(name[4:])
    return sorted(gone)


def _hadoop(spark: SparkSession, path: str):
    """File system and path object of a folder, whatever store it is in."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _version_path(path: str, day: str) -> str:
    return f"{path.rstrip('/')}/run={day}"


def accumulate_report(df: DataFrame, path: str, day: str) -> None:
    """Report that keeps all days: the run day is replaced, earlier days stay."""
    overwrite_partition(df.where(F.col("dt") == F.lit(day)), path, day)


def accumulate_distinct(old: DataFrame, new: DataFrame) -> DataFrame:
    """The literal form of accumulation: all old and new rows, equal rows once."""
    return old.unionByName(new).distinct()


def columnar_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").orc(path, compression="snappy")


def tsv_table(df: DataFrame, path: str) -> None:
    r"""Text table with NULL as ``\N``: :func:`read_tsv_table` gives back every value as it was, the empty text too."""
    write_tsv(df, path, null=TSV_NULL)


def read_tsv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_tsv(spark, path, schema, null=TSV_NULL)


def load_partition(src: DataFrame, path: str, day: str) -> None:
    """Landed day into its table. The landed files stay, so the load can be repeated."""
    overwrite_partition(src, path, day)


def partition_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


def check_partition(spark: SparkSession, path: str, day: str) -> None:
    """Fail when a day is missing or empty; reads one row at most."""
    if read_table(spark, path).where(F.col("dt") == F.lit(day)).limit(1).isEmpty():
        raise EmptyPartition(f"{path} has no rows for {day}")


class FailedCheck(RuntimeError):
    """Stored rows contradict what must hold for them."""


def check_none(df: DataFrame, what: str) -> None:
    """Fail if there is a row; reads one at most."""
    found = df.limit(1).collect()
    if found:
        raise FailedCheck(f"{what}: {found[0].asDict()}")


def watched(df: DataFrame, what: str, must_not: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` that counts the rows for which something holds that must not, as an action runs over it, and the check to call then.

    The counts ride on the write; nothing is read a second time.
    """
    if not must_not:
        return df, lambda: None
    names = list(must_not)
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(must_not[n]).alias(f"n{k}") for k, n in enumerate(names)])

    def verify() -> None:
        try:
            found = seen.get
        except Py4JJavaError:  # the plan was proved empty and counted nothing
            found = {}
        wrong = {n: found.get(f"n{k}", 0) for k, n in enumerate(names) if found.get(f"n{k}", 0)}
        if wrong:
            raise FailedCheck(f"{what}: " + ", ".join(f"{n} ({c})" for n, c in wrong.items()))

    return counted, verify


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def overlapping_versions(history: DataFrame, key: str) -> DataFrame:
    """Versions of a key that begin before the one before them has ended."""
    by = Window.partitionBy(key).orderBy("start_date", "end_date")
    before = history.where(F.col(key).isNotNull()).withColumn("_before", F.lag("end_date").over(by))
    return before.where(F.col("_before") >= F.col("start_date")).drop("_before")


def unreadable_rows(landed: DataFrame) -> DataFrame:
    """Landed rows whose own time could not be read, and so have no day."""
    return landed.where(F.col("dt").isNull())
