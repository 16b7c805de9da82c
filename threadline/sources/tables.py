"""Stored graph tables and the path cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadline.schemas import EDGES_SCHEMA, NODES_SCHEMA


def empty_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], NODES_SCHEMA)


def empty_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EDGES_SCHEMA)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order and types; absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "errorifexists") -> None:
    """Write partitioned by one column of few values.

    Rows keep the partitioning they have: a shuffle by the column would send a
    value that holds a third of all rows to one task. Small inputs are merged by
    the rebalance hint, which splits large values again.
    """
    df.hint("rebalance", F.col(column)).write.mode(mode).partitionBy(column).parquet(path)


def write_graph_tables(nodes: DataFrame, edges: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    write_partitioned(nodes, f"{folder}/nodes", "entity_type", mode)
    write_partitioned(edges, f"{folder}/edges", "relationship", mode)


def read_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/nodes")


def read_edges(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/edges")


def write_path_cache(cache: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_partitioned(cache, path, "min_hops", mode)


def read_path_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("min_hops", F.col("min_hops").cast("int"))
