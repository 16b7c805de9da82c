"""Keyed tables kept current by streams.

Every micro-batch is reduced to the newest row per key and written as a part of a log.
A manifest names the parts that count; a new one is put in place, whole, after each
batch. Whenever several parts of one level have come together they are folded into one
of the next level, so a table has a few parts a level and a batch costs what it holds,
however long the log. The current table is the newest row per key of the named parts.
A part carries the id of the query that wrote it: a batch run again overwrites its own
part and nothing else, and a stream started over with a new checkpoint adds parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.operators.versions import latest_by_key
from threadline.session import list_names, read_text, remove, write_text

#: Parts of a level that are folded into one of the next.
FOLD = 8
#: Manifests that stay for readers that still use them.
KEPT_MANIFESTS = 16


def scd1_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key as a streaming aggregate; all keys stay in the state store."""
    return latest_by_key(stream, keys, order)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query a checkpoint belongs to."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def log_parts(spark: SparkSession, log: str) -> tuple[int, dict[str, int]]:
    """Number of the latest manifest and the parts it names, with their levels."""
    names = [n for n in list_names(spark, f"{log}/manifest") if n.isdigit()]
    return (int(max(names)), json.loads(read_text(spark, f"{log}/manifest/{max(names)}"))) if names else (0, {})


def append_part(batch: DataFrame, keys: Sequence[str], order: Sequence[str], log: str, part: str) -> None:
    """Write the batch's newest rows as ``part``, fold levels that are full, and name what counts now. One writer a log."""
    spark = batch.sparkSession
    latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{log}/parts/{part}")
    number, parts = log_parts(spark, log)
    parts[part] = 0
    for level in range(max(parts.values()) + 1):
        full = [p for p, at in parts.items() if at == level]
        if len(full) >= FOLD:
            folded = f"level{level + 1}-{uuid.uuid4().hex}"
            read = spark.read.parquet(*[f"{log}/parts/{p}" for p in full])
            latest_by_key(read, keys, order).write.parquet(f"{log}/parts/{folded}")
            parts = {p: at for p, at in parts.items() if at != level} | {folded: level + 1}
    write_text(spark, f"{log}/manifest/{number + 1:012d}", json.dumps(parts))
    _forget(spark, log, number + 1 - KEPT_MANIFESTS)


def _forget(spark: SparkSession, log: str, last: int) -> None:
    """Remove manifests up to a number and the parts that only they named."""
    names = sorted(n for n in list_names(spark, f"{log}/manifest") if n.isdigit())
    old = [n for n in names if int(n) <= last]
    named = {n: set(json.loads(read_text(spark, f"{log}/manifest/{n}"))) for n in (names if old else [])}
    still = set().union(*(named[n] for n in names if n not in old)) if old else set()
    for name in old:
        for part in named[name] - still:
            remove(spark, f"{log}/parts/{part}")
        remove(spark, f"{log}/manifest/{name}")


def start_scd1(stream: DataFrame, keys: Sequence[str], order: Sequence[str], log: str, checkpoint: str, trigger: dict | None = None):
    """Start the stream that keeps the log; returns the running query."""

    def append(batch: DataFrame, batch_id: int) -> None:
        append_part(batch, keys, order, log, f"{query_id(batch.sparkSession, checkpoint)}-{batch_id}")

    return (
        stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def current(spark: SparkSession, log: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table a log stands for: a lower sequence that came later loses."""
    return latest_by_key(spark.read.parquet(*[f"{log}/parts/{p}" for p in log_parts(spark, log)[1]]), keys, order)


def dedupe_events(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop events repeated within ``delay`` of event time."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over all that is there and append its rows to files."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
