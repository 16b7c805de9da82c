"""A lineage graph kept current by a stream of notebook exports.

Each micro-batch parses only notebooks whose text is new and writes their lineage as a
part of its own, numbered by a clock that rises with every batch. A keyed log of one
row per notebook (path, hash, number of the part) says which part counts; it is all a
batch reads of what came before, and it folds while the stream runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.operators.versions import latest_by_key
from threadline.plans.facade import LINEAGE_DDL, extract_lineage, graph_tables
from threadline.session import materialize
from threadline.streaming import keyed

_KEYS, _ORDER = ["path"], ["clock"]


def known_notebooks(spark: SparkSession, log: str, without: str | None = None) -> DataFrame | None:
    """(path, hash, clock, part) of every notebook as last parsed; ``without`` leaves out what one part of the log says."""
    parts = [p for p in keyed.log_parts(spark, f"{log}/notebooks")[1] if p != without]
    return latest_by_key(spark.read.parquet(*[f"{log}/notebooks/parts/{p}" for p in parts]), _KEYS, _ORDER) if parts else None


def start_lineage_updates(
    stream: DataFrame, log: str, checkpoint: str, order: str = "seq", readers: Mapping[str, Mapping] | None = None, trigger: dict | None = None
):
    """Start the stream of (path, format, content, ``order``) exports; returns the running query."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{keyed.query_id(spark, checkpoint)}-{batch_id}"
        exports = latest_by_key(batch, ["path"], [order]).withColumn("hash", F.sha2("content", 256))
        known, clock = known_notebooks(spark, log, part), 0
        if known is not None:
            known = materialize(known)
            clock = known.agg(F.max("clock")).first()[0] + 1
            exports = exports.join(known, ["path", "hash"], "left_anti")
        exports = materialize(exports)
        extract_lineage(exports, readers).write.mode("overwrite").parquet(f"{log}/lineage/part={part}")
        marks = exports.select("path", "hash", F.lit(clock).cast("long").alias("clock"), F.lit(part).alias("part"))
        keyed.append_part(marks, _KEYS, _ORDER, f"{log}/notebooks", part)

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def current_lineage(spark: SparkSession, log: str) -> DataFrame:
    """The lineage rows the latest part of each notebook holds."""
    rows = spark.read.schema(LINEAGE_DDL + ", part string").parquet(f"{log}/lineage")
    known = known_notebooks(spark, log)
    return rows.limit(0).drop("part") if known is None else rows.join(known.select("path", "part"), ["path", "part"], "left_semi").drop("part")


def current_graph(spark: SparkSession, log: str, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) the log stands for."""
    return graph_tables(materialize(current_lineage(spark, log)), stamp)
