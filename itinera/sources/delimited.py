"""Delimited text."""

from __future__ import annotations

import csv
import posixpath
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itinera.operators.layout import cast_columns, sanitize_name

CORRUPT = "_corrupt_record"
SEPARATORS = ("\t", ",", ";")
# Inferred number types from the narrowest to the widest.
_NUMBERS = ("int", "bigint", "double")


def file_headers(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Column names to the files that have them, by one pass over the lines; files without a line have none.

    Names follow the reader's own rules: empty cells are numbered, repeated names get their position.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value"
    )
    first = lines.filter((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():  # one row a file, as many as the file listing has
        cells = next(csv.reader([row["header"].lstrip("\ufeff")], delimiter=sep))
        lower = [c.lower() for c in cells]
        names = tuple((f"{c}{i}" if lower.count(c.lower()) > 1 else c) if c else f"_c{i}" for i, c in enumerate(cells))
        # the metadata column quotes the path as a URI; a reader takes it plain, with pattern characters escaped
        found.setdefault(names, []).append(re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(row["file"])))
    return found


def _by_header(spark: SparkSession, path: str | Sequence[str], sep: str, read: Callable[[tuple[str, ...], list[str]], DataFrame]) -> DataFrame:
    """One reader for each distinct header, joined by column name."""
    headers = file_headers(spark, path, sep)
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    return merge_frames([read(names, files) for names, files in headers.items()])


def read_csv_all_string(spark: SparkSession, path: str | Sequence[str], sep: str = ",", source: str | None = None) -> DataFrame:
    """Every column as text; many files become one table, by column name, whatever the order and number of their columns.

    Only lines whose number of cells does not fit their own file's header are skipped (:func:`load_report` counts
    them). ``source`` adds a column with the file's name, which ``_metadata`` no longer gives after a union.
    """

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        rows = (
            spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names]))
            .option("header", True)
            .option("sep", sep)
            .option("mode", "DROPMALFORMED")
            .option("columnPruning", False)
            .csv(files)
        )
        return with_provenance(rows, source) if source else rows

    return _by_header(spark, path, sep, read)


def read_csv_infer(spark: SparkSession, path: str, sep: str = ",") -> tuple[str, DataFrame]:
    """Inferred types, registered as a temporary view named after the file."""
    df = spark.read.option("header", True).option("inferSchema", True).option("sep", sep).csv(path)
    name = sanitize_name(posixpath.splitext(posixpath.basename(path.rstrip("/")))[0])
    df.createOrReplaceTempView(name)
    return name, df


def read_csv_typed(
    spark: SparkSession, path: str | Sequence[str], text_columns: Sequence[str], sep: str = ",", sampling: float = 1.0
) -> DataFrame:
    """Inferred types except for the named columns, which stay text exactly as written; many files join by column name.

    Where files disagree on a column's type, numbers widen and anything else stays text.
    """
    options = {"header": True, "sep": sep}
    headers = file_headers(spark, path, sep)
    kinds: dict[str, set[str]] = {}
    for files in headers.values():
        for f in spark.read.options(**options, inferSchema=True, samplingRatio=sampling).csv(files).schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())

    def kind(name: str) -> str:
        found = kinds[name]
        if name in text_columns or not (len(found) == 1 or found <= set(_NUMBERS)):
            return "string"
        return max(found, key=lambda k: _NUMBERS.index(k) if k in _NUMBERS else -1)

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(c, T._parse_datatype_string(kind(c))) for c in names])
        return spark.read.schema(schema).options(**options).csv(files)

    return merge_frames([read(names, files) for names, files in headers.items()]) if headers else spark.createDataFrame([], T.StructType([]))


def detect_separator(spark: SparkSession, path: str) -> str:
    """The first of tab, comma, semicolon that splits the header into more than one column."""
    first = spark.read.text(path).limit(1).first()
    header = first[0] if first else ""
    return next((s for s in SEPARATORS if len(header.split(s)) > 1), ",")


def with_provenance(df: DataFrame, file: str = "source_file", sheet: str | None = None) -> DataFrame:
    """The name of the file each row was read from; call it right on the reader's result."""
    out = df.withColumn(file, F.col("_metadata.file_name"))
    return out.withColumn("source_sheet", F.lit(sheet)) if sheet is not None else out


def load_report(spark: SparkSession, path: str | Sequence[str], sep: str = ",", name: str = "file_name") -> DataFrame:
    """Per file: lines, loaded, skipped, percentage loaded; each file is held against its own header.

    ``name`` is the metadata field that names the file: ``file_name`` or ``file_path``.
    """

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False)
            .csv(files)
        )
        return rows.select(F.col(f"_metadata.{name}").alias("file_name"), F.col(CORRUPT).alias("bad"), F.col(f"`{names[0]}`").alias("cell"))

    rows = _by_header(spark, path, sep, read)
    if not rows.columns:
        return spark.createDataFrame([], "file_name string, total_rows long, loaded_rows long, skipped_rows long, loaded_pct double")
    # Spark refuses a query over the corrupt-record column alone, so the count of good lines reads a cell as well
    good = F.col("bad").isNull() & (F.coalesce(F.length("cell"), F.lit(0)) >= 0)
    per = rows.groupBy("file_name").agg(
        F.count_if(good).alias("loaded_rows"), F.count("bad").alias("skipped_rows")
    )
    total = F.col("loaded_rows") + F.col("skipped_rows")
    return per.select(
        "file_name",
        total.alias("total_rows"),
        "loaded_rows",
        "skipped_rows",
        F.round(100.0 * F.col("loaded_rows") / total, 4).alias("loaded_pct"),
    )


def load_dimension(spark: SparkSession, path: str, table: str | None = None, sep: str = ",") -> DataFrame:
    """A reference table, all text; with ``table`` it replaces the catalog table of that name."""
    df = read_csv_all_string(spark, path, sep)
    if table:
        df.write.mode("overwrite").saveAsTable(table)
        return spark.table(table)
    return df


def read_layout(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, str], sep: str = ",") -> DataFrame:
    """All text first, then the named columns cast; values that do not fit become null."""
    return cast_columns(read_csv_all_string(spark, path, sep), types)


def merge_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows under the union of the columns; missing cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_files(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """Several files with different headers as one table."""
    return merge_frames([read_csv_all_string(spark, p, sep) for p in paths])
