"""Lineage documents and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DOCUMENT = (
    "entities array<struct<id: string, type: string, name: string, properties: map<string, string>>>, "
    "relationships array<struct<src: string, dst: string, type: string>>"
)


def read_lineage_json(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(entities, relationships) of lineage documents; one document per file, or per line."""
    documents = spark.read.schema(_DOCUMENT).option("multiLine", str(multi_line).lower()).json(path)
    return documents.select(F.inline("entities")), documents.select(F.inline("relationships"))


def lineage_documents(entities: DataFrame, relationships: DataFrame) -> DataFrame:
    """(path, document): one JSON document per notebook, its lists in id order.

    A group is what one notebook's text yields.
    """
    listed = entities.groupBy("path").agg(F.sort_array(F.collect_set(F.struct("id", "type", "name"))).alias("entities"))
    linked = relationships.groupBy("path").agg(F.sort_array(F.collect_set(F.struct("src", "dst", "type"))).alias("relationships"))
    empty = F.expr("CAST(array() AS array<struct<src: string, dst: string, type: string>>)")
    document = F.to_json(F.struct("entities", F.coalesce("relationships", empty).alias("relationships")))
    return listed.join(linked, "path", "left").select("path", document.alias("document"))


def write_lineage_json(documents: DataFrame, path: str, file_per_document: bool = False) -> None:
    """One document per line; a file for each only on request, since small files cost a listing and a task each."""
    writer = documents.select("document").write
    if file_per_document:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.text(path)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", "true").csv(path)
