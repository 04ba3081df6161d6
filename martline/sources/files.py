"""Landed files and day-partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.columns import on_day
from martline.sources import schemas


def day_path(path: str, day: str) -> str:
    return f"{path.rstrip('/')}/dt={day}"


def read_log_json(spark: SparkSession, path: str, day: str | None) -> DataFrame:
    """Click log of one landed day, or of all days. Gzip files are read whole, so many files are what gives parallel reads.

    The folder is read from its root and pruned to the day: the root knows which files a landing stream committed.
    """
    return on_day(_landed_json(spark, path, schemas.LOG), day)


def read_change_feed(
    spark: SparkSession, path: str, data: T.StructType, day: str | None, table: str | None = None, position: bool = False
) -> DataFrame:
    """Changes of one landed day, or of all days; ``table`` names the feed where one root holds all tables.

    ``position`` adds the place of each change in the database's log, NULL where the feed has none.
    """
    schema = schemas.envelope(data, position)
    if table is None:
        return on_day(_landed_json(spark, path, schema), day)
    feeds = _landed_json(spark, path, T.StructType([*schema.fields, T.StructField("table", T.StringType())]))
    return on_day(feeds.where(F.col("table") == F.lit(f"{table}_inc")).drop("table"), day)


def _landed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON with declared types. Whole numbers may also come as quoted text, which the plain reader would drop."""
    folders = [T.StructField("dt", T.StringType())]
    rows = spark.read.schema(T.StructType([*_as_text(schema).fields, *folders])).json(path)
    return rows.select(*[_as_declared(F.col(f.name), f.dataType).alias(f.name) for f in schema], "dt")


def _as_text(dtype: T.DataType) -> T.DataType:
    """The type with every whole number replaced by text."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_as_text(dtype.elementType))
    return T.StringType() if isinstance(dtype, T.LongType) else dtype


def _as_declared(column: Column, dtype: T.DataType) -> Column:
    """The reverse of :func:`_as_text`, field by field, so that one bad value costs only itself."""
    if _as_text(dtype) == dtype:
        return column
    if isinstance(dtype, T.StructType):
        fields = [_as_declared(column[f.name], f.dataType).alias(f.name) for f in dtype]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda element: _as_declared(element, dtype.elementType))
    return column.try_cast(dtype)


def read_snapshot_tsv(spark: SparkSession, path: str, schema: T.StructType, day: str) -> DataFrame:
    """Full copy of a table: tab separated, no header, no quoting, empty text is NULL."""
    return read_tsv(spark, day_path(path, day), schema).withColumn("dt", F.lit(day))


def write_snapshot_tsv(df: DataFrame, path: str, day: str, compression: str = "none") -> None:
    """The landed form that :func:`read_snapshot_tsv` reads. Files that are not compressed can be split when read."""
    write_tsv(df.drop("dt"), day_path(path, day), compression=compression)


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.CALENDAR)


def write_tsv(df: DataFrame, path: str, null: str = "", compression: str = "none") -> None:
    """Tab separated lines, every row one line: backslash, tab and line ends inside a text are escaped, blanks stay."""
    fields = [F.coalesce(_escaped(F.col(f"`{c}`").cast("string")), F.lit(null)) for c in df.columns]
    lines = df.select(F.concat_ws("\t", *fields).alias("value"))
    lines.write.mode("overwrite").options(lineSep="\n", compression=compression).text(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, null: str = "") -> DataFrame:
    """What :func:`write_tsv` wrote. Missing fields and values that are not of the declared type are NULL."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.split("value", "\t", -1).alias("fields"))
    columns = []
    for k, field in enumerate(schema):
        raw = F.get("fields", F.lit(k))
        text = F.when(raw != F.lit(null), F.when(raw.contains("\\"), _unescaped(raw)).otherwise(raw))
        columns.append((text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)).alias(field.name))
    return lines.select(*columns)


# The escapes of the text form.
_ESCAPES = {"\t": "\\t", "\n": "\\n", "\r": "\\r"}


def _escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, written in _ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescaped(text: Column) -> Column:
    """Between pairs of backslashes, a single one can only begin an escape."""

    def part(piece: Column) -> Column:
        for plain, written in _ESCAPES.items():
            piece = F.replace(piece, F.lit(written), F.lit(plain))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Columnar table partitioned by ``dt``; the partition value stays a string whatever the session infers."""
    if schema is not None:
        return spark.read.schema(schema).orc(path)
    df = spark.read.orc(path)
    return df.withColumn("dt", F.col("dt").cast("string")) if "dt" in df.columns else df
