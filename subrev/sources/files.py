"""Readers and writers. CSV is what the outside world has; Parquet is what stages exchange."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subrev.functions.dates import parse_day_first, parse_day_first_time
from subrev.functions.reasons import CORRECTIONS, reasons_json
from subrev.specs import FILE_NULL_WORDS, REASON_CODES, TABLES, TableSpec


def _null_words(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(c).isin(*FILE_NULL_WORDS), F.col(c)).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Raw CSV scan: every column is text, null words become null, columns follow the spec.

    The header decides the order; a column the file lacks is a typed null; a
    path that does not exist gives an empty table.  Only the header line is
    read while planning.
    """
    try:
        header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], spec.raw_schema)
    df = _null_words(header)
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast("string").alias(c)
                       for c in spec.columns])


def read_raw_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: read_raw(spark, paths[name], spec) for name, spec in TABLES.items()}


def first_of_each(names: Sequence[str]) -> list[int]:
    """Positions of the first column of every name (names compared without case)."""
    seen: set[str] = set()
    keep = []
    for i, name in enumerate(names):
        if name.lower() not in seen:
            seen.add(name.lower())
            keep.append(i)
    return keep


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of every name."""
    names = df.columns
    keep = first_of_each(names)
    if len(keep) == len(names):
        return df
    return df.toDF(*[f"c{i}" for i in range(len(names))]).select(
        *[F.col(f"c{i}").alias(names[i]) for i in keep])


def read_clean(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Clean-table scan: Parquet directory, or CSV when the path ends in .csv.

    A CSV read without a schema gives text columns (types are never inferred);
    date columns of a given schema are parsed day-first or ISO, as the report
    stage expects.
    """
    if not path.rstrip("/").endswith(".csv"):
        df = spark.read.parquet(path)
        return drop_repeated_columns(df)
    header = spark.read.option("header", False).option("escape", '"').option("inferSchema", False).csv(path).limit(1)
    names = [str(x) for x in header.first()]
    raw = (spark.read.schema(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]))
           .option("header", True).option("enforceSchema", True).option("escape", '"').csv(path))
    df = raw.select(*[F.when(~F.col(f"c{i}").isin(*FILE_NULL_WORDS), F.col(f"c{i}")).alias(names[i])
                      for i in first_of_each(names)])
    if schema is None:
        return df
    return df.select(*[_typed(F.col(f.name) if f.name in df.columns else F.lit(None).cast("string"), f)
                       for f in schema])


def _typed(c: Column, f: T.StructField) -> Column:
    if isinstance(f.dataType, T.DateType):
        out = F.coalesce(parse_day_first(c), F.to_date(parse_day_first_time(c)))
    elif isinstance(f.dataType, T.TimestampType):
        out = parse_day_first_time(c)
    elif isinstance(f.dataType, T.ArrayType):
        out = F.from_json(c, f.dataType)
    elif isinstance(f.dataType, T.LongType):
        out = c.try_cast("double").try_cast("bigint")
    else:
        out = c.try_cast(f.dataType)
    return out.alias(f.name)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet sink of a stage."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def flat_text(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, so that the frame fits a delimited file."""
    return df.select(*[(reasons_json(F.col(f.name)) if isinstance(f.dataType, T.ArrayType) else F.col(f.name))
                       .alias(f.name) for f in df.schema])


def write_report(df: DataFrame, path: str) -> None:
    """CSV sink with a header, for report-size frames (one file per report)."""
    flat_text(df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def clean_columns(df: DataFrame) -> DataFrame:
    """What of an annotated table goes out: the ``*_norm`` helpers and the correction cells stay behind."""
    return df.drop(*[c for c in df.columns if c.endswith("_norm") or c == CORRECTIONS])


def write_clean(df: DataFrame, path: str) -> None:
    """Clean-table sink."""
    write_table(clean_columns(df), path)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Clean tables for readers outside: CSV parts with a header, lists as JSON text."""
    flat_text(clean_columns(df)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Diagnostic dump, only when there is a row."""
    if df.isEmpty():
        return False
    write_table(df, path)
    return True


def reason_lookup(spark: SparkSession) -> DataFrame:
    """The reason codes with their descriptions."""
    return spark.createDataFrame(list(REASON_CODES.items()), "code string, description string")
