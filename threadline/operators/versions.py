"""Keyed tables over time: latest rows, merges, change feeds, versions, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.session import materialize, stack


def latest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by the order columns, the later ones breaking ties.

    An aggregate with a map-side part rather than a window, so a key that holds a
    third of all rows costs one row per input partition in the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def number_sorted_rows(rows: DataFrame, name: str) -> DataFrame:
    """Positions 1..n of rows that ``orderBy`` sorted, without a one-task window.

    Range partitions follow the order; each adds the row counts of those before it.
    The sorted rows are written first, so a lost executor cannot renumber them.
    """
    spot = F.monotonically_increasing_id()
    placed = materialize(rows).withColumn("_spot", spot)
    placed = placed.select("*", F.shiftright("_spot", 33).alias("_part"), F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_spot", "_part", "_row", "_before")
    )


def assign_batches(rows: DataFrame, order: str, size: int = 20) -> DataFrame:
    """Batch number 0.. of ``size`` consecutive rows in the given order."""
    numbered = number_sorted_rows(rows.orderBy(order), "_position")
    return numbered.withColumn("batch", F.expr(f"(_position - 1) div {int(size)}")).drop("_position")


def number_versions(history: DataFrame, key: str, content: str, order: Sequence[str]) -> DataFrame:
    """Version per key that rises with each content change.

    Rows are range-partitioned by key and order, so a key with many rows spans many
    tasks. Each range counts its own changes; the few ranges of a key are then added
    up, comparing the last row of one with the first of the next.
    """
    ranged = materialize(history.withColumn("_digest", F.xxhash64(content)).orderBy(key, *order))
    placed = ranged.withColumn("_part", F.spark_partition_id())
    local = Window.partitionBy("_part", key).orderBy(*order)
    before = F.lag("_digest").over(local)
    counted = placed.withColumn("_changed", F.when(before.isNull() | (before == F.col("_digest")), 0).otherwise(1))
    ranges = counted.groupBy("_part", key).agg(
        F.min_by("_digest", F.struct(*order)).alias("_first"),
        F.max_by("_digest", F.struct(*order)).alias("_last"),
        F.sum("_changed").alias("_inner"),
    )
    along = Window.partitionBy(key).orderBy("_part")
    opens = F.when(F.lag("_last").over(along).eqNullSafe(F.col("_first")), 0).otherwise(1)
    opened = ranges.withColumn("_opens", opens)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = opened.select(
        "_part", key, (F.coalesce(F.sum(F.col("_inner") + F.col("_opens")).over(earlier), F.lit(0)) + F.col("_opens")).alias("_offset")
    )
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counted.withColumn("_running", F.sum("_changed").over(running))
    return (
        numbered.join(offsets, ["_part", key])
        .withColumn("version", (F.col("_offset") + F.col("_running")).cast("int"))
        .select(*history.columns, "version")
    )


def changed_notebooks(old: DataFrame, new: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(path, change): what is new, changed, or gone, by content hash."""
    before = old.select(key, F.sha2(F.col(content), 256).alias("old_hash"), F.lit(True).alias("in_old"))
    after = new.select(key, F.sha2(F.col(content), 256).alias("new_hash"), F.lit(True).alias("in_new"))
    change = (
        F.when(F.col("in_old").isNull(), "new")
        .when(F.col("in_new").isNull(), "removed")
        .when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), "changed")
    )
    return before.join(after, key, "full_outer").select(key, change.alias("change")).where("change IS NOT NULL")


def restrict_to(rows: DataFrame, changes: DataFrame, key: str = "path") -> DataFrame:
    """Only the rows of notebooks that are new or changed."""
    return rows.join(changes.where(F.col("change").isin("new", "changed")), key, "left_semi")


def apply_overrides(edges: DataFrame, overrides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Manual values win over extracted ones; manual rows without a match are added."""
    values = [c for c in edges.columns if c not in keys]
    given = overrides.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in values if c in overrides.columns])
    merged = edges.join(given, list(keys), "full_outer")
    return merged.select(
        *keys, *[(F.coalesce(f"_o_{c}", c) if c in overrides.columns else F.col(c)).alias(c) for c in values]
    )


def upsert_batch(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The stored table after merging a batch: the newest row per key wins, old or new.

    Running it twice with the same batch changes nothing.
    """
    columns = stored.columns
    fresh = latest_by_key(batch.select(*columns), keys, order)
    return latest_by_key(stack(stored, fresh), keys, order)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two versions of a keyed table, with ``change_type``."""
    values = [c for c in old.columns if c not in keys]
    before = old.select(*keys, F.struct(*values).alias("_old"))
    after = new.select(*keys, F.struct(*values).alias("_new"))

    def same(field: str) -> Column:
        left, right = F.col(f"_old.{field}"), F.col(f"_new.{field}")
        if old.schema[field].dataType.typeName() == "map":
            left, right = F.array_sort(F.map_entries(left)), F.array_sort(F.map_entries(right))
        return left.eqNullSafe(right)

    equal = F.lit(True)
    for field in values:
        equal = equal & same(field)

    def event(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(row).alias("row"))

    events = (
        F.when(F.col("_old").isNull(), F.array(event("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(event("delete", "_old")))
        .when(~equal, F.array(event("update_preimage", "_old"), event("update_postimage", "_new")))
    )
    joined = before.join(after, list(keys), "full_outer")
    return joined.select(*keys, F.inline(events)).select(*keys, "change_type", "row.*")


def graph_as_of(history: DataFrame, keys: Sequence[str], at: str, moment: Column, order: Sequence[str]) -> DataFrame:
    """The rows as they stood at a moment: the newest per key not after it, if active.

    Only the newest row matters, so an aggregate replaces the validity window.
    """
    newest = latest_by_key(history.where(F.col(at) <= moment), keys, order)
    return newest.where("is_active") if "is_active" in history.columns else newest


def soft_delete(stored: DataFrame, extracted: DataFrame, keys: Sequence[str], stamp: Column) -> DataFrame:
    """Mark rows the new extraction lacks as inactive and raise their version."""
    present = extracted.select(*keys, F.lit(True).alias("_present")).distinct()
    gone = F.col("_present").isNull() & F.col("is_active")
    joined = stored.join(present, list(keys), "left")
    changed = {
        "is_active": F.when(gone, F.lit(False)).otherwise(F.col("is_active")),
        "version": F.when(gone, F.col("version") + 1).otherwise(F.col("version")),
        "updated_at": F.when(gone, stamp).otherwise(F.col("updated_at")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in stored.columns])
