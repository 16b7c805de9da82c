"""Joins and filters the documented questions need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_nodes(nodes: DataFrame, entity_type: str) -> DataFrame:
    """Active nodes of a type that have an embedding; prunes partitions by type."""
    return nodes.where((F.col("entity_type") == entity_type) & F.col("is_active") & F.col("embedding").isNotNull())


def filter_edges(edges: DataFrame, relationship: str, since: Column) -> DataFrame:
    return edges.where((F.col("relationship") == relationship) & (F.col("created_at") >= since))


def upstream_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Direct incoming edges of the given entities."""
    return edges.join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")


def downstream_edges(edges: DataFrame, ids: DataFrame, relationship: str) -> DataFrame:
    """Direct outgoing edges of one relationship."""
    return edges.where(F.col("relationship") == relationship).join(ids.select(F.col("id").alias("src")), "src", "left_semi")


def direct_dependents(edges: DataFrame, nodes: DataFrame, names: DataFrame, relationship: str) -> DataFrame:
    """(entity_name, dependent): distinct names one edge away from entities of a name."""
    wanted = nodes.join(names, "entity_name", "left_semi").select(F.col("id").alias("src"), "entity_name")
    targets = nodes.select(F.col("id").alias("dst"), F.col("entity_name").alias("dependent"))
    one_hop = edges.where(F.col("relationship") == relationship).select("src", "dst")
    return one_hop.join(wanted, "src").join(targets, "dst").select("entity_name", "dependent").distinct()


def validate_paths(paths: DataFrame, inventory: DataFrame) -> DataFrame:
    """(path, is_valid): which listed paths the workspace holds."""
    known = inventory.select("path", F.lit(True).alias("found")).distinct()
    return paths.select("path").distinct().join(known, "path", "left").select("path", F.coalesce("found", F.lit(False)).alias("is_valid"))


def resolve_node_names(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the names and types of both ends; unknown ends stay NULL."""
    names = nodes.select("id", "entity_name", "entity_type")
    sources = names.select(F.col("id").alias("src"), F.col("entity_name").alias("src_name"), F.col("entity_type").alias("src_type"))
    targets = names.select(F.col("id").alias("dst"), F.col("entity_name").alias("dst_name"), F.col("entity_type").alias("dst_type"))
    return edges.join(sources, "src", "left").join(targets, "dst", "left")
