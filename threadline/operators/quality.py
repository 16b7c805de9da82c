"""Rules, keys, references, metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadline.schemas import ALLOWED_RELATIONSHIPS
from threadline.session import stack

# The warn-only rules of the edges table.
EDGE_RULES = {
    "valid_src": "src IS NOT NULL",
    "valid_dst": "dst IS NOT NULL",
    "valid_relationship": f"relationship IN {ALLOWED_RELATIONSHIPS}",
}


def _passes(rule: str) -> Column:
    """A rule that is NULL counts as failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_all(rows: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, passed, failed) of each rule, in one pass; the rows themselves are kept."""
    counts = rows.agg(F.count("*").alias("n"), *[F.count_if(_passes(r)).alias(n) for n, r in rules.items()])
    each = [
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("passed"), (F.col("n") - F.col(n)).alias("failed")) for n in rules
    ]
    return counts.select(F.inline(F.array(*each)))


def expect_or_drop(rows: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); rejected rows carry the names of the rules they broke."""
    broken = F.filter(
        F.array(*[F.when(~_passes(r), F.lit(n)) for n, r in rules.items()]), lambda n: n.isNotNull()
    )
    judged = rows.withColumn("broken_rules", broken)
    return judged.where(F.size("broken_rules") == 0).drop("broken_rules"), judged.where(F.size("broken_rules") > 0)


def check_referential_integrity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, dst, relationship, missing): edge ends that are no node."""
    ids = nodes.select("id")
    rows = edges.select("src", "dst", "relationship")
    no_src = rows.join(ids, rows["src"] == ids["id"], "left_anti").withColumn("missing", F.lit("src"))
    no_dst = rows.join(ids, rows["dst"] == ids["id"], "left_anti").withColumn("missing", F.lit("dst"))
    return stack(no_src, no_dst)


def check_unique_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def graph_metrics(
    nodes: DataFrame, edges: DataFrame, previous_nodes: DataFrame | None = None, previous_edges: DataFrame | None = None
) -> DataFrame:
    """(metric, label, n): counts by type, and rows added since the previous tables."""

    def by(rows: DataFrame, metric: str, column: str) -> DataFrame:
        return rows.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n")).select(F.lit(metric).alias("metric"), "label", "n")

    def added(rows: DataFrame, old: DataFrame, metric: str, keys: list[str]) -> DataFrame:
        return rows.select(*keys).join(old.select(*keys), keys, "left_anti").agg(F.count("*").alias("n")).select(
            F.lit(metric).alias("metric"), F.lit("rows").alias("label"), "n"
        )

    parts = [by(nodes, "nodes_by_type", "entity_type"), by(edges, "edges_by_type", "relationship")]
    if previous_nodes is not None:
        parts.append(added(nodes, previous_nodes, "nodes_added", ["id"]))
    if previous_edges is not None:
        parts.append(added(edges, previous_edges, "edges_added", ["src", "dst", "relationship"]))
    return stack(*parts)


def embedding_coverage(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count_if(F.col("embedding").isNotNull()).alias("with_embedding"), F.count("*").alias("n"))


def mark_low_confidence(edges: DataFrame, minimum: float = 0.7) -> DataFrame:
    """Add ``low_confidence``; a missing score is low."""
    score = F.col("confidence_score")
    return edges.withColumn("low_confidence", F.coalesce(F.round(score.cast("double"), 6) < minimum, F.lit(True)))


def filter_confidence(edges: DataFrame, minimum: float = 0.7) -> DataFrame:
    return mark_low_confidence(edges, minimum).where(~F.col("low_confidence")).drop("low_confidence")


def parse_accuracy(cells: DataFrame, errors: DataFrame) -> DataFrame:
    """(cell_type, n_cells, n_parsed, accuracy)."""
    failed = errors.select("path", "cell_no", F.lit(1).alias("failed")).distinct()
    return (
        cells.select("path", "cell_no", "cell_type").join(failed, ["path", "cell_no"], "left")
        .groupBy("cell_type")
        .agg(F.count("*").alias("n_cells"), F.count_if(F.col("failed").isNull()).alias("n_parsed"))
        .withColumn("accuracy", F.col("n_parsed") / F.col("n_cells"))
    )


def unparsable_cells(cells: DataFrame, errors: DataFrame) -> DataFrame:
    """Quarantine: the cells that failed, with their text and the error."""
    return cells.join(errors, ["path", "cell_no"])


def validate_types(rows: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """(column, declared, non_null, invalid): text values that do not cast to the declared type."""
    checks = []
    for name, kind in declared.items():
        value = F.col(name)
        checks += [
            F.count(value).alias(f"{name}__n"),
            F.count_if(value.isNotNull() & value.try_cast(kind).isNull()).alias(f"{name}__bad"),
        ]
    counted = rows.agg(*checks)
    each = [
        F.struct(F.lit(n).alias("column"), F.lit(k).alias("declared"), F.col(f"{n}__n").alias("non_null"), F.col(f"{n}__bad").alias("invalid"))
        for n, k in declared.items()
    ]
    return counted.select(F.inline(F.array(*each)))


def schema_differences(stored: T.StructType, declared: T.StructType) -> list[tuple[str, str, str]]:
    """(column, stored type, declared type) wherever the two differ; an absent one is empty."""
    have = {f.name: f.dataType.simpleString() for f in stored.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    return [
        (name, have.get(name, ""), want.get(name, ""))
        for name in sorted(have | want)
        if have.get(name) != want.get(name)
    ]
