"""File sources and sinks: the raw CSV (S1) and layer tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CSV_COLUMNS, MALFORMED, RAW_CSV

DEFAULT_AS_OF = datetime(2024, 2, 1, 0, 0, 0)


def as_of_lit(as_of: datetime | None = None):
    """The explicit load timestamp that replaces NOW() defaults."""
    ts = (as_of or DEFAULT_AS_OF).strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(ts).cast("timestamp_ntz")


def csv_load(spark: SparkSession, path: str, as_of: datetime | None = None,
             mark_malformed: bool = True, number_from: int | None = None,
             id_col: str = "transaction_id", header: bool = True) -> DataFrame:
    """Read raw transaction CSV files (header row, eleven columns) with
    a fixed schema (no inference pass) and stamp ``loaded_at``. Lines with a bad field,
    too few or too many fields keep their text in the column ``MALFORMED``, for C10 to
    quarantine; without ``mark_malformed`` such fields are NULL, as Spark reads them.
    With ``number_from``, lines get BIGSERIAL ids in the order of files and lines,
    malformed ones included, so a row's id tells its place."""
    schema = StructType([*RAW_CSV.fields, StructField(MALFORMED, StringType())]) if mark_malformed else RAW_CSV
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    if number_from is not None:
        df = number_lines(df, id_col, number_from)
    return df.withColumn("loaded_at", as_of_lit(as_of))


def number_lines(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """Ids in file and line order for rows read straight from files.

    Spark reads a file in splits and deals large splits first, so the order of partitions
    isn't that of the lines; but within a split rows keep their order. A first pass
    counts the rows of each (file, split start), one row each; a row's id is what earlier
    splits hold plus its place in its own. Nothing is sorted or stored."""
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"))
    splits = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), ["_file", "_block"]).withColumn(
        id_col, F.lit(start) + F.col("_off") + F.col("_mid") - F.col("_first"))
    return out.drop("_file", "_block", "_mid", "_first", "_off")


def write_csv(df: DataFrame, path: str) -> None:
    """Write raw rows in the CSV layout (used to feed csv_load)."""
    (df.select(*CSV_COLUMNS).write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """INSERT ... SELECT / refresh as a Parquet write. ``append`` adds
    rows, ``overwrite`` replaces the table (materialized-view refresh). Tables that are
    read while they change are published instead (:mod:`.versions`)."""
    df.write.mode(mode).parquet(path)


def read_layer(spark: SparkSession, path_or_table: str) -> DataFrame:
    """S3: read a written layer (Parquet path) or a catalog table."""
    if "/" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """S3 over JDBC (the reference reads its views from a database)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()
