"""Exported notebooks and code files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.session import local_path, stack, store

#: Files below one folder, which one task writes.
FILES_A_FOLDER = 1_000
#: Folders that one task lists.
FOLDERS_A_TASK = 100


def write_notebook_exports(texts: DataFrame, folder: str, files: int) -> None:
    """Every row of one text column as a file of its own below a new folder; about ``files`` of them are expected.

    Each task has a folder, so that many folders are listed side by side. Spark's writer starts two processes a
    file on a local file system without native Hadoop, to set its mode; there the tasks write the files themselves.
    """
    spark = texts.sparkSession
    rows = texts.repartition(max(spark.sparkContext.defaultParallelism, -(-files // FILES_A_FOLDER)))
    place = local_path(spark, folder)
    if place is None:
        spread = rows.withColumn("task", F.spark_partition_id())
        spread.write.option("maxRecordsPerFile", 1).partitionBy("task").text(folder)
        return
    os.makedirs(place, exist_ok=True)

    def write(batches: Iterator) -> Iterator:
        at, n = TaskContext.get(), 0
        inside = f"{place}/task={at.partitionId()}"
        os.makedirs(inside, exist_ok=True)
        for batch in batches:
            for value in batch.column(0):
                # seen whole or not at all, and written over by another attempt of the task
                draft = f"{inside}/.part-{n:05d}.{at.taskAttemptId()}"
                with open(draft, "wb") as out:
                    out.write(f"{value.as_py() or ''}\n".encode())
                os.replace(draft, f"{inside}/part-{n:05d}.txt")
                n += 1
        yield from ()

    rows.mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def _list_files(spark: SparkSession, place: str) -> DataFrame:
    """(path) of every file below a local folder, a level of folders a round; names that Spark's readers pass over are left out."""

    def look(batches: Iterator) -> Iterator:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                paths, kinds = [], []
                with os.scandir(folder) as entries:
                    for entry in entries:
                        name, is_folder = entry.name, entry.is_dir()
                        passed = name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name
                        if passed and not (is_folder and name.startswith(("_metadata", "_common_metadata"))) or not os.path.exists(entry.path):
                            continue
                        paths.append(entry.path)
                        kinds.append(is_folder)
                        if len(paths) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(kinds)], ["path", "is_folder"])
                            paths, kinds = [], []
                if paths:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(kinds)], ["path", "is_folder"])

    folders, n, levels = spark.range(1).select(F.lit(place).alias("path")), 1, []
    while n:
        tasks = min(n, max(spark.sparkContext.defaultParallelism, -(-n // FOLDERS_A_TASK)))
        found = store(folders.repartition(tasks).mapInArrow(look, "path string, is_folder boolean"), "listed")
        levels.append(found.where("NOT is_folder").select("path"))
        folders = found.where("is_folder").select("path")
        n = folders.count()
    return stack(*levels)


def _read_files(files: DataFrame) -> DataFrame:
    """(path, content) of local files, some ``FILES_A_FOLDER`` a task, with the paths as Spark's readers give them."""

    def read(batches: Iterator) -> Iterator:
        paths, contents, size = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    contents.append(file.read())
                paths.append(f"file:{path}")
                size += len(contents[-1])
                if size >= 8_000_000 or len(paths) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])
                    paths, contents, size = [], [], 0
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])

    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // FILES_A_FOLDER))
    return files.repartition(tasks).mapInArrow(read, "path string, content binary")


def read_notebook_exports(spark: SparkSession, folder: str) -> DataFrame:
    """(path, format, content) of every file below a folder.

    The format follows the extension, and for others whether the first sign of the text that is no blank begins a JSON object.
    Spark's reader lists all files in the driver's memory; of a folder that tasks can open they list and read the files themselves.
    """
    place = local_path(spark, folder)
    if place is not None and os.path.isdir(place):
        files = _read_files(_list_files(spark, place))
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    looks_like_json = F.col("content").cast("string").rlike(r"\A[\x{FEFF}\s]*+\{")
    kind = (
        F.when(F.lower("path").endswith(".ipynb"), "JUPYTER")
        .when(F.lower("path").endswith(".py"), "SOURCE")
        .when(looks_like_json, "JUPYTER")
        .otherwise("SOURCE")
    )
    return files.select("path", kind.alias("format"), "content")


def prefer_jupyter_export(exports: DataFrame) -> DataFrame:
    """One export per notebook: JUPYTER where there is one.

    The aggregate carries the format only; the content is joined by (path, format),
    so large values are neither buffered nor compared.
    """
    rank = F.when(F.col("format") == "JUPYTER", 0).otherwise(1)
    best = exports.groupBy("path").agg(F.min_by("format", rank).alias("format"))
    return exports.join(best, ["path", "format"], "left_semi")


def decode_export_payload(content: Column) -> Column:
    """Bytes of a base64 payload; a value that is not base64 is taken as it is.

    Line breaks may stand inside a payload, blanks may not: prose in words of four
    letters would decode otherwise.
    """
    payload = F.when(content.rlike(r"^[A-Za-z0-9+/=\r\n]+$"), F.try_to_binary(content, F.lit("base64")))
    return F.coalesce(payload, F.encode(content, "UTF-8"))
