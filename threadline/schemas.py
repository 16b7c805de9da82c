"""Table schemas of the lineage graph."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _field(name: str, kind: T.DataType, comment: str | None = None, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment} if comment else None)


# The two stored graph tables.
NODES_SCHEMA = T.StructType(
    [
        _field("id", T.StringType(), nullable=False),
        _field("entity_type", T.StringType(), "table|column|transformation|function"),
        _field("entity_name", T.StringType()),
        _field("properties", _TEXT_MAP),
        _field("embedding", T.ArrayType(T.FloatType()), "vector for similarity search"),
        _field("created_at", T.TimestampType()),
    ]
)

EDGES_SCHEMA = T.StructType(
    [
        _field("src", T.StringType(), "id of the source node", nullable=False),
        _field("dst", T.StringType(), "id of the target node", nullable=False),
        _field("relationship", T.StringType(), "reads_from|writes_to|transforms|contains"),
        _field("weight", T.FloatType(), "weight for ranking"),
        _field("properties", _TEXT_MAP, "further attributes of the edge"),
        _field("created_at", T.TimestampType(), "first seen"),
        _field("updated_at", T.TimestampType(), "last changed"),
    ]
)

# The stored tables plus activity, version and confidence.
NODES_FULL_SCHEMA = T.StructType(
    NODES_SCHEMA.fields
    + [
        _field("is_active", T.BooleanType()),
        _field("version", T.IntegerType()),
        _field("updated_at", T.TimestampType()),
    ]
)

EDGES_FULL_SCHEMA = T.StructType(
    [_field("edge_id", T.StringType(), nullable=False)]
    + EDGES_SCHEMA.fields
    + [
        _field("confidence_score", T.FloatType()),
        _field("is_active", T.BooleanType()),
        _field("version", T.IntegerType()),
    ]
)

PATH_LIST_SCHEMA = T.StructType(
    [
        _field("entity_id", T.StringType()),
        _field("path", T.StringType()),
        _field("fechora_ultima_ejecucion_job", T.TimestampType()),
    ]
)

CELLS_SCHEMA = T.StructType(
    [
        _field("path", T.StringType()),
        _field("cell_no", T.IntegerType()),
        _field("cell_type", T.StringType()),
        _field("content", T.StringType()),
        _field("metadata", _TEXT_MAP),
    ]
)

# Relationships the edges table accepts, and how extracted ones map to them.
ALLOWED_RELATIONSHIPS = ("reads_from", "writes_to", "transforms", "contains")
RELATIONSHIP_MAP = {
    "reads_from": "reads_from",
    "writes_to": "writes_to",
    "derives_from": "transforms",
    "transforms_into": "transforms",
    "contains": "contains",
}
