"""The list of notebook paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadline.schemas import PATH_LIST_SCHEMA
from threadline.session import list_names, materialize, stack

CORRUPT = "_corrupt_record"


def read_notebook_paths(spark: SparkSession, folder: str, schema: T.StructType | None = PATH_LIST_SCHEMA) -> DataFrame:
    """All CSV files of a folder as one table; without a schema, types are inferred."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(folder)


def stream_notebook_paths(
    spark: SparkSession, folder: str, schema: T.StructType | None = PATH_LIST_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """CSV files of a folder as a stream, those already there first.

    The file source reads a file once; ``ingest_paths`` also reads files that were
    overwritten, and merges headers. Without a schema the session must allow streaming inference.
    """
    reader = spark.readStream.option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, modified) of a folder's files; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))


def read_with_merged_headers(spark: SparkSession, files: list[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """CSV files as one table whose columns are those of all headers, absent ones null, and ``file``.

    Files of the same header are read together, by name rather than by place. Columns
    are text unless ``types`` names another type.
    """
    first = F.regexp_replace(F.split("value", "\r?\n", 2)[0], "^\ufeff", "")
    headers = spark.read.text(files, wholetext=True).select(F.col("_metadata.file_path").alias("file"), first.alias("header"))
    groups: dict[str, list[str]] = {}
    for row in headers.collect():
        groups.setdefault(row["header"], []).append(row["file"])
    found = []
    for own in groups.values():
        rows = spark.read.option("header", "true").csv(own).select("*", F.col("_metadata.file_path").alias("file"))
        found.append(rows.select(*[F.col(f"`{c}`").try_cast((types or {}).get(c, "string")).alias(c) for c in rows.columns]))
    return stack(*found)


def ingest_paths(spark: SparkSession, folder: str, log: str, types: Mapping[str, str] | None = None) -> int:
    """Add the files of a folder that are new or were written again since the last call; returns how many.

    The ledger of (file, modified) is written after the rows, under the same number, so a
    call that broke off is done again and not counted twice. A file that disappeared stays.
    """
    done = [int(n.removeprefix("n=")) for n in list_names(spark, f"{log}/ledger") if n.startswith("n=")]
    now = list_files(spark, folder)
    if done:
        now = now.join(spark.read.parquet(f"{log}/ledger").drop("n"), ["file", "modified"], "left_anti")
    todo = materialize(now)
    files = [r["file"] for r in todo.collect()]
    if files:
        number = max(done, default=-1) + 1
        read_with_merged_headers(spark, files, types).write.mode("overwrite").parquet(f"{log}/rows/n={number}")
        todo.write.mode("overwrite").parquet(f"{log}/ledger/n={number}")
    return len(files)


def ingested_paths(spark: SparkSession, log: str) -> DataFrame:
    """Rows of every file as it was last read, the columns of all headers merged."""
    latest = spark.read.parquet(f"{log}/ledger").groupBy("file").agg(F.max("n").alias("n"))
    rows = spark.read.option("mergeSchema", "true").parquet(f"{log}/rows")
    return rows.join(latest, ["file", "n"], "left_semi").drop("n")


def read_with_corrupt_rows(spark: SparkSession, folder: str, schema: T.StructType = PATH_LIST_SCHEMA) -> DataFrame:
    """The path list with unreadable rows kept as text in ``_corrupt_record``."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .schema(full).csv(folder)
    )


def stamp_processing_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("processing_time", F.current_timestamp())


def path_column_shares(rows: DataFrame) -> DataFrame:
    """(column, share): how many values of each text column look like paths."""
    names = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    shares = rows.agg(*[F.avg(F.col(f"`{n}`").rlike("^/").cast("double")).alias(n) for n in names])
    return shares.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("share")) for n in names])))


def detect_path_column(rows: DataFrame) -> str | None:
    """Name of the column with the largest share of paths; NULL shares never win."""
    best = path_column_shares(rows).where("share > 0").orderBy(F.desc("share"), "column").first()
    return best["column"] if best else None
