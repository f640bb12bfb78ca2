"""File sources and sinks (inventory S1-S11).

All readers return lazy DataFrames.  Explicit schemas are preferred: schema
inference costs an extra pass over the input, which is noticeable at scale,
so ``infer=True`` is opt-in.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    strict: bool = True,
    **options: str,
) -> DataFrame:
    """Header CSV with quoted fields; all-string unless a schema is given or
    ``infer`` is set.  Globs and lists of paths read many files as one table.
    ``strict`` fails on malformed rows instead of nulling them."""
    reader = spark.read.option("header", header).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; integers infer as long, decimals as double."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet (schema in the file, vector columns included)."""
    return spark.read.parquet(*paths)


def parse_delimited(
    df: DataFrame,
    fields: Sequence[tuple[str, str]],
    sep: str,
    col: str = "value",
    strict: bool = False,
) -> DataFrame:
    """Split a text column on a (multi-character, literal) separator into typed
    columns.  Lenient mode turns short lines and bad numbers into nulls
    (``get`` + ``try_cast``); strict mode raises on either."""
    parts = F.split(F.col(col), re.escape(sep))
    cols = []
    for i, (name, dtype) in enumerate(fields):
        piece = parts[i] if strict else F.get(parts, i)
        cols.append((piece.cast(dtype) if strict else piece.try_cast(dtype)).alias(name))
    return df.select(*cols)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[tuple[str, str]],
    sep: str = "::",
    strict: bool = False,
) -> DataFrame:
    """Text lines such as ``user::item::rating::time`` as typed columns."""
    return parse_delimited(spark.read.text(path if isinstance(path, str) else list(path)), fields, sep, strict=strict)


def rows(spark: SparkSession, data: Sequence[Sequence], names: Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """Literal rows as a DataFrame with the given column names."""
    df = spark.createDataFrame(list(data), schema=schema) if schema is not None else spark.createDataFrame(list(data))
    return df.toDF(*names)


def sequence(spark: SparkSession, n: int, name: str = "id", dtype: str = "bigint") -> DataFrame:
    """Ids ``0..n-1`` generated in parallel (``spark.range``)."""
    return spark.range(n).select(F.col("id").cast(dtype).alias(name))


def read_yearly(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    pattern: str = r"(\d{4})[^/]*$",
    year_col: str = "year",
    **options: str,
) -> DataFrame:
    """Union of per-year files of one schema; the year is read from each
    file's path with ``pattern`` (first group).  Directory partition
    inference is switched off so only the pattern decides."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path if isinstance(path, str) else list(path))
    year = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int")
    return df.withColumn(year_col, year)


def read_yearly_mixed(spark: SparkSession, sources: Sequence[tuple[str, str]], schema: StructType | str, **kw) -> DataFrame:
    """Same as ``read_yearly`` over several (format, path) pairs, joined by
    column name (CSV and JSON order fields differently)."""
    out = None
    for fmt, path in sources:
        df = read_yearly(spark, path, fmt=fmt, schema=schema, **kw)
        out = df if out is None else out.unionByName(df)
    return out


def read_headerless_routes(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str] = ("dest", "origin", "count"),
    types: Sequence[str] = ("string", "string", "bigint"),
) -> DataFrame:
    """Header-less, extension-less part files whose names hold unquoted commas.

    Fields are separated by a comma *not* followed by a space, so
    ``Arden, Little Brook, and Vale,Northland,17`` has three fields.
    Files starting with ``_`` or ``.`` (commit markers) are hidden by Spark."""
    parts = F.split(F.col("value"), ",(?! )")
    return spark.read.text(path if isinstance(path, str) else list(path)).select(
        *[F.get(parts, i).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    )


def read_images(spark: SparkSession, path: str, label_pattern: str = r"/([^/]+)/[^/]+$", drop_invalid: bool = True) -> DataFrame:
    """Decode an image directory (Spark's ``image`` source; pixel bytes are
    BGR).  ``label`` is the parent folder name of each file."""
    df = (
        spark.read.format("image")
        .option("dropInvalid", drop_invalid)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return df.withColumn("label", F.regexp_extract(F.col("image.origin"), label_pattern, 1))


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Raw file bytes (``binaryFile``) when decoding is not needed."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    **options: str,
) -> str:
    """Write a DataFrame as files; returns the path."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def save_model(model, path: str) -> str:
    """Persist a fitted MLlib model or pipeline (overwriting)."""
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    """Load a model saved by ``save_model`` with its MLlib class (``PCAModel`` ...)."""
    return cls.load(path)
