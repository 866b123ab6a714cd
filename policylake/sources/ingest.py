"""Appending CSV files to raw tables, with unreadable rows set aside."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parsed_timestamp
from ..functions.numbers import NOT_IN_NUMBERS, finite, flag
from ..functions.steps import Steps, apply_steps
from ..functions.text import strip, without
from ..session import stage
from .tables import existing_table, write_table

CORRUPT = "_corrupt_record"
HEADER_BYTES = 1 << 20
LISTERS = 16
TYPED = "__typed_"

# CSV fields that mean "missing".
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def csv_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text, plus one for lines that do not fit the header."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


def csv_header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of a CSV file, or of all files of a folder, each name once; None where there is no such file."""
    groups = csv_headers(spark, path)
    return None if groups is None else [*{c.lower(): c for header in reversed(groups) for c in header}.values()]


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]] | None:
    """The files below ``paths`` by their own header; files without any byte are left out. None where nothing is there.

    Of each file only the start is read, by the driver, several at a time, as when Spark lists them.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files: list[str] = []
    found = False
    for path in [paths] if isinstance(paths, str) else paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        listed = target.getFileSystem(conf).globStatus(target)
        for status in listed or ():
            found = True
            files += _files_below(spark, status)
    if not found:
        return None
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, ...] | None:
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream, codec = at.getFileSystem(conf).open(at), codecs.getCodec(at)
        try:
            stream = stream if codec is None else codec.createInputStream(stream)
            start = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)))
        finally:
            stream.close()
        lines = start.decode("utf-8-sig", "replace").splitlines()
        return tuple(next(csv.reader([lines[0]]))) if lines and lines[0] else None

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(LISTERS) as pool:
        for file, names in zip(files, pool.map(header, files)):
            if names is not None:
                groups.setdefault(names, []).append(file)
    return groups


def _files_below(spark: SparkSession, status) -> list[str]:
    """Data files of a folder and its subfolders, or the file itself; hidden ones are skipped, as Spark does."""
    if not status.isDirectory():
        return [status.getPath().toString()]
    fs = status.getPath().getFileSystem(spark._jsc.hadoopConfiguration())
    visible = [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
    return sorted(f for s in visible for f in _files_below(spark, s))


def read_csv(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame | None:
    """The files as text columns; the values are typed later, by the target table.

    Files are grouped by their own header. Each group is read under it, and the groups are united by name, ignoring case: a column that a file
    does not have is null in its rows, and the order of columns does not matter. A doubled quote in a quoted field is one quote. ``multi_line``
    allows line breaks in quoted fields; such a file cannot be split, so it is off unless a source needs it. None where there is no such file.
    """
    groups = csv_headers(spark, path)
    if groups is None:
        return None
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    parts = [reader.schema(csv_schema(header)).csv(files) for header, files in groups.items()]
    if not parts:
        return spark.createDataFrame([], csv_schema([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def casting(target: T.DataType) -> Steps:
    """A text value as the target type, null where it does not fit."""
    if isinstance(target, T.StringType):
        return (without(*CSV_MISSING),)
    if isinstance(target, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return (*parsed_timestamp(), lambda c: c.cast(target))
    if isinstance(target, T.BooleanType):
        return flag()
    plain = (strip, lambda c: F.when(~c.rlike(NOT_IN_NUMBERS), c))
    if isinstance(target, T.IntegralType):
        return (*plain, lambda c: F.coalesce(c.try_cast(target), _whole(c.try_cast("double")).try_cast(target)))
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return (*plain, lambda c: c.try_cast(target), finite)
    return (*plain, lambda c: c.try_cast(target))


def _whole(c: Column) -> Column:
    return F.when(c == F.floor(c), c)


def _typed(new: DataFrame, target: T.StructType, prefix: str, *keep: str) -> DataFrame:
    """``new`` with one cast column per target field; absent ones are null."""
    columns = [
        (F.col(f"`{f.name}`").cast("string") if f.name in new.columns else F.lit(None).cast("string")).alias(prefix + f.name)
        for f in target.fields
    ]
    df = new.select(*[F.col(f"`{c}`") for c in keep], *columns)
    return apply_steps(df, {prefix + f.name: casting(f.dataType) for f in target.fields})


def conform(new: DataFrame, target: T.StructType) -> DataFrame:
    """``new`` in the shape of ``target``: absent columns null, others dropped, values cast.

    Only the target's schema is used, its rows are not read. Values that do not fit are null.
    """
    return _typed(new, target, "")


def checked(new: DataFrame, target: T.StructType, key: str | None = None, strict: bool = True) -> DataFrame:
    """The text columns, their cast twins, and ``reason``: what keeps a row out, or blank.

    A corrupt line or a missing key always does; with ``strict`` so does every filled value
    that does not fit its type, otherwise such a value is null.
    """
    df = _typed(new, target, TYPED, *new.columns)
    checks = []
    if strict:
        for f in target.fields:
            if f.name in new.columns and not isinstance(f.dataType, T.StringType):
                filled = ~strip(F.col(f"`{f.name}`")).isin(*CSV_MISSING)
                checks.append(F.when(filled & F.col(TYPED + f.name).isNull(), F.lit(f.name)))
    if CORRUPT in new.columns:
        checks.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt line")))
    if key:
        checks.append(F.when(F.col(TYPED + key).isNull(), F.lit("null key")))
    return df.withColumn("reason", F.concat_ws(",", *checks) if checks else F.lit(""))


def accepted(rows: DataFrame, target: T.StructType) -> DataFrame:
    return rows.filter("reason = ''").select(*[F.col(TYPED + f.name).alias(f.name) for f in target.fields])


def set_aside(rows: DataFrame) -> DataFrame:
    return rows.filter("reason <> ''").select(*[c for c in rows.columns if not c.startswith(TYPED)])


def append_csv(
    spark: SparkSession,
    path: str,
    root: str,
    table: str,
    key: str | None = None,
    quarantine: str | None = None,
    dry_run: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Append a CSV file to an existing raw table; returns one row of counts.

    A missing file counts as nothing to do. Values that do not fit the table become null;
    with a ``quarantine`` table their rows go there whole instead. Corrupt lines and rows
    without the ``key`` are never appended. A dry run only counts.

    The file is parsed once: its checked rows are staged whole, and counts and both writes come from there, so what is
    counted is what is written, also when more files arrive meanwhile.
    """
    target = existing_table(spark, root, table)
    if target is None:
        raise ValueError(f"{table} does not exist below {root}")
    new = read_csv(spark, path, multi_line)
    if new is None:
        return _counts(spark, table, 0, 0, 0)
    rows = stage(checked(new, target.schema, key, strict=quarantine is not None), "arrivals")
    summary = rows.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason") != "").alias("set_aside")).first()
    appended = summary["read"] - summary["set_aside"]
    if not dry_run:
        if quarantine and summary["set_aside"]:
            write_table(set_aside(rows), root, quarantine, "append")
        if appended:
            write_table(accepted(rows, target.schema), root, table, "append")
    return _counts(spark, table, summary["read"], appended, summary["set_aside"])


def _counts(spark: SparkSession, table: str, read: int, appended: int, set_aside: int) -> DataFrame:
    counts = [F.lit(n).cast("bigint").alias(c) for c, n in (("read", read), ("appended", appended), ("set_aside", set_aside))]
    return spark.range(0, 1, 1, 1).select(F.lit(table).alias("table_name"), *counts)


def ingest_summary(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-table counts of a run and their total."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    total = every.agg(F.lit("total").alias("table_name"), *[F.sum(c).alias(c) for c in ("read", "appended", "set_aside")])
    return every.unionByName(total)


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows of a batch, as a dry run shows them."""
    return df.orderBy(*order_by).limit(rows)
