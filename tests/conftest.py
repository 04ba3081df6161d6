from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples of the named columns."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


@pytest.fixture
def feed(spark):
    """Change feed from ``(type, ts, data, old, dt)`` entries."""
    from pyspark.sql import types as T

    from martline.sources import schemas

    def build(name, entries):
        data = schemas.FEED_DATA[name]
        schema = T.StructType([*schemas.envelope(data).fields, T.StructField("dt", T.StringType())])
        full = [
            (kind, ts, tuple(values.get(f) for f in data.fieldNames()), old, dt)
            for kind, ts, values, old, dt in entries
        ]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def log(spark):
    """Click log from dictionaries with the nested parts of an event."""
    import json

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from martline.sources import schemas

    def build(events):
        lines = [(json.dumps({k: v for k, v in e.items() if k != "dt"}), e["dt"]) for e in events]
        schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("dt", T.StringType())])
        parsed = F.from_json("value", schemas.LOG).alias("e")
        return spark.createDataFrame(lines, schema).select(parsed, "dt").select("e.*", "dt")

    return build
