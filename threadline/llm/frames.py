"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.session import scratch_path


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of every row; a null text is an empty one."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def each_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[str]]]:
    """Batches of ``texts`` that have rows, with their texts decoded one at a time."""
    for batch in batches:
        if batch.num_rows:
            yield batch, (value.as_py() for value in batch.column("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder in the shared store and read it back, so nothing behind it runs again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
