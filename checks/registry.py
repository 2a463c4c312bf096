"""The query registry and the helpers shared by all query modules."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itinera.session import scratch_path, short_methods

Run = Callable[["Data"], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its inventory name."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


# Lazy table readers, so that a table's schema is read from its files once per session.
_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


class Data:
    """The driver tables of one scale and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _FRAMES:
            _FRAMES[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return _FRAMES[key]

    def view(self, name: str) -> DataFrame:
        """A derived input. The large ones are stored once per session, as the booking tables they stand for are."""
        from checks.inputs import BASE, STORED, VIEWS, needs

        for v in needs(name):
            key = (self.spark.sparkContext.applicationId, self.folder, v)
            if key not in _FRAMES:
                for base in BASE:
                    if re.search(rf"\b{base}\b", VIEWS[v]):
                        self.table(base).createOrReplaceTempView(base)
                for other in needs(v)[:-1]:
                    _FRAMES[(*key[:2], other)].createOrReplaceTempView(other)
                df = self.spark.sql(VIEWS[v])
                if v in STORED:
                    path = scratch_path(self.spark, v)
                    with short_methods(self.spark):
                        df.write.parquet(path)
                    df = self.spark.read.parquet(path)
                _FRAMES[key] = df
            _FRAMES[key].createOrReplaceTempView(v)
        return _FRAMES[(self.spark.sparkContext.applicationId, self.folder, name)]


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: whole numbers as bigint, times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)
