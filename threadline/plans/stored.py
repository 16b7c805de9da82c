"""Graph tables of the derived inputs, written once per session and read by many queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.operators import traverse
from threadline.plans import inputs
from threadline.session import scratch_path
from threadline.sources import tables

_written: dict[tuple[str, str, str], str] = {}

def fixed_stamp() -> Column:
    """One fixed moment, so that checked tables do not depend on the clock."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = scratch_path(spark, kind)
        write(path)
        _written[key] = path
    return _written[key]


def graph_folder(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "graph",
        lambda path: tables.write_graph_tables(inputs.nodes(spark, sf_dir), inputs.edges(spark, sf_dir), path),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_nodes(spark, graph_folder(spark, sf_dir))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_edges(spark, graph_folder(spark, sf_dir))


def flow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that move data: containment is structure."""
    return edges(spark, sf_dir).where(F.col("relationship") != "contains")


def notebook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, cell_no, content) as notebooks hold it, magics included, in several files."""

    def write(path: str) -> None:
        inputs.spread(inputs.cells(spark, sf_dir), "path").write.parquet(path)

    return spark.read.parquet(_once(spark, sf_dir, "cells", write))


def cache_folder(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "path-cache",
        lambda path: tables.write_path_cache(traverse.path_cache(flow_edges(spark, sf_dir), fixed_stamp()), path),
    )


def path_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_path_cache(spark, cache_folder(spark, sf_dir))
