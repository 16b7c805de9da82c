"""Building node and edge tables: merging, deduplication, vocabulary, containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions.text import edge_id
from threadline.schemas import ALLOWED_RELATIONSHIPS, RELATIONSHIP_MAP
from threadline.session import stack

ENTITY_ORDER = ("path", "cell_no", "ord")


def statement_order(statement: str, place: str) -> Column:
    """One number that sorts by statement, then by place within it: the place has 32 bits of its own."""
    return F.shiftleft(F.col(statement).cast("bigint"), 32) + F.col(place)


def union_lineage(*parts: DataFrame) -> DataFrame:
    """Rows of several extractions under one set of columns."""
    return stack(*parts)


def dedupe_entities(entities: DataFrame, order: Sequence[str] = ENTITY_ORDER) -> DataFrame:
    """One row per id: the first occurrence in notebook, cell and statement order.

    A hash or sort aggregate with a map-side part, so an id on a third of all rows
    is reduced before the shuffle.
    """
    named = entities.where(F.coalesce(F.col("id"), F.lit("")) != "")
    rest = [c for c in entities.columns if c != "id"]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return named.groupBy("id").agg(first).select("id", "first.*")


def dedupe_relationships(relationships: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Distinct by (src, dst, type), a missing part counting as the empty string."""
    keys = ["src", "dst", "type"]
    filled = relationships.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in keys],
        *[c for c in relationships.columns if c not in keys],
    )
    rest = [c for c in relationships.columns if c not in keys]
    if not rest:
        return filled.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("first")
    return filled.groupBy(*keys).agg(first).select(*keys, "first.*")


def collect_sorted_tables(sources: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Distinct source names per statement in order, as one array."""
    return sources.groupBy(*keys).agg(F.sort_array(F.collect_set(name)).alias("tables"))


def functions_per_file(ast_nodes: DataFrame) -> DataFrame:
    """Function definitions in each file."""
    kinds = ("FunctionDef", "AsyncFunctionDef")
    return ast_nodes.where(F.col("type").isin(*kinds)).groupBy("file").agg(F.count("*").alias("n_functions"))


def build_nodes(entities: DataFrame, stamp: Column) -> DataFrame:
    """Extracted entities to node rows; entities must be unique by id."""
    return entities.select(
        "id",
        F.col("type").alias("entity_type"),
        F.col("name").alias("entity_name"),
        F.col("properties") if "properties" in entities.columns else F.lit(None).cast("map<string,string>").alias("properties"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit(True).alias("is_active"),
        F.lit(1).alias("version"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def map_relationship(relationship: Column) -> Column:
    """Extracted relationship to the stored vocabulary; unknown ones stay for the quality rules."""
    lookup = F.create_map(*[F.lit(x) for pair in RELATIONSHIP_MAP.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, relationship), relationship)


def build_edges(relationships: DataFrame, stamp: Column) -> DataFrame:
    """Extracted relationships to edge rows with stable ids."""
    properties = (
        F.col("properties") if "properties" in relationships.columns else F.lit(None).cast("map<string,string>")
    )
    score = F.col("confidence_score") if "confidence_score" in relationships.columns else F.lit(1.0)
    mapped = map_relationship(F.col("type"))
    return relationships.select(
        edge_id(F.col("src"), F.col("dst"), mapped, F.try_element_at(properties, F.lit("expression"))).alias("edge_id"),
        "src",
        "dst",
        mapped.alias("relationship"),
        F.lit(None).cast("float").alias("weight"),
        score.cast("float").alias("confidence_score"),
        properties.alias("properties"),
        F.lit(True).alias("is_active"),
        F.lit(1).alias("version"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def containment_edges(catalog: DataFrame) -> DataFrame:
    """``contains`` edges catalog, schema, table, column from a table of columns.

    ``explode`` before ``distinct``: the few parents with many children vanish in
    the map-side part of the aggregate.
    """
    levels = F.array("catalog", "schema", "table_name", "column")
    ids = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.array_join(F.slice(levels, 1, n), "."))
    pairs = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda n: F.struct(F.element_at(ids, n).alias("src"), F.element_at(ids, n + 1).alias("dst")),
    )
    return (
        catalog.select(F.inline(pairs)).distinct().withColumn("relationship", F.lit("contains"))
    )


def cell_containment_edges(cells: DataFrame) -> DataFrame:
    """Notebook to cell; rows are unique already, so no shuffle."""
    return cells.select(
        F.col("path").alias("src"),
        F.concat("path", F.lit("#"), F.col("cell_no").cast("string")).alias("dst"),
        F.lit("contains").alias("relationship"),
    )


def path_tree_edges(files: DataFrame) -> DataFrame:
    """Folder tree of file paths: (parent, child, name, is_file), parent NULL at the top."""
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    lead = F.when(F.col("path").startswith("/"), F.lit("/")).otherwise(F.lit(""))
    depth = F.size(parts)

    def prefix(n: Column) -> Column:
        return F.concat(lead, F.array_join(F.slice(parts, 1, n), "/"))

    rows = F.transform(
        F.sequence(F.lit(1), depth),
        lambda n: F.struct(
            F.when(n > 1, prefix(n - 1)).alias("parent"),
            prefix(n).alias("child"),
            F.element_at(parts, n).alias("name"),
            (n == depth).alias("is_file"),
        ),
    )
    return files.where(depth > 0).select(F.inline(rows)).distinct()


def invalid_relationships(edges: DataFrame) -> DataFrame:
    return edges.where(~F.coalesce(F.col("relationship").isin(*ALLOWED_RELATIONSHIPS), F.lit(False)))
