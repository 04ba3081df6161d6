"""Helpers shared by the operators: settings of a session, tables written between steps, rows carried as one value."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import martline
from martline.plans.scratch import new_folder

#: Bytes of one Arrow batch, which bounds what a Python worker holds however long the texts are.
BATCH_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, and give executors this package, as ``--py-files`` would."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(martline.__file__).parent
        if root.is_dir():  # else it came from such an archive itself
            stem = tempfile.mkdtemp(prefix="martline-code-") + "/martline"
            context.addPyFile(shutil.make_archive(stem, "zip", root.parent, root.name))
        _SHIPPED.add(context.applicationId)


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the setting that follows the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    folder = folder or new_folder(spark)
    df.write.parquet(folder, compression="zstd")
    return spark.read.schema(df.schema).parquet(folder)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, **named) -> DataFrame:
    """All columns of ``df`` as one struct ``row`` beside ``named`` ones: names cannot clash, however the input is called."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    """The columns of a ``row`` struct and the ``more`` ones, which win where the names clash."""
    kept = [F.col("row")[c].alias(c) for c in columns if c not in more]
    return df.select(*kept, *more)


def trim() -> None:
    """In a worker: give freed memory back, which Python workers otherwise hold from one group to the next."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(AttributeError, OSError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)


def per_task(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``each`` for ``mapInArrow``, giving memory back after every batch that it has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b
                trim()

        yield from each(fresh())

    return run
