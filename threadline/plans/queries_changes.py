"""Checked queries: versions, merges, change capture, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.operators import versions
from threadline.plans import inputs, stored
from threadline.plans.catalog import query
from threadline.plans.inputs import sql_over
from threadline.plans.queries_tables import EVENT_SCHEMA, path_csv
from threadline.session import scratch_path
from threadline.sources import paths
from threadline.streaming import keyed


@query(
    "w1_latest_by_key",
    sql_over("path_events", "SELECT entity_id, arg_max(path, (seq, event_id)) AS path, max((seq, event_id))[2] AS event_id FROM path_events GROUP BY entity_id"),
)
def w1(spark, sf):
    rows = inputs.derived(spark, sf, "path_events")
    return versions.latest_by_key(rows, ["entity_id"], ["seq", "event_id"]).select("entity_id", "path", "event_id")


@query(
    "w2_assign_batches",
    sql_over("notebook_cells", """SELECT path, (row_number() OVER (ORDER BY path) - 1) // 20 AS batch
                                  FROM (SELECT DISTINCT path FROM notebook_cells)"""),
)
def w2(spark, sf):
    return versions.assign_batches(inputs.cells(spark, sf).select("path").distinct(), "path", 20)


_VERSIONS = """versions AS (
    SELECT id, content, changed_at, tie,
           CAST(sum(changed) OVER (PARTITION BY id ORDER BY changed_at, tie ROWS UNBOUNDED PRECEDING) AS INT) AS version
    FROM (SELECT *, CASE WHEN lag(content) OVER (PARTITION BY id ORDER BY changed_at, tie) = content THEN 0 ELSE 1 END AS changed FROM history))"""


@query("w3_number_versions", sql_over("history", "SELECT id, tie, content, version FROM versions", _VERSIONS))
def w3(spark, sf):
    found = versions.number_versions(inputs.derived(spark, sf, "history"), "id", "content", ["changed_at", "tie"])
    return found.select("id", "tie", "content", "version")


@query(
    "j3_changed_notebooks",
    """SELECT CAST(o_orderkey AS VARCHAR) AS path, CASE WHEN o_orderstatus = 'F' THEN 'removed' WHEN o_orderstatus = 'P' THEN 'new'
              ELSE 'changed' END AS change FROM orders WHERE o_orderstatus IN ('F', 'P') OR o_orderpriority = '1-URGENT'""",
)
def j3(spark, sf):
    orders = inputs.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("path"), "o_orderstatus", "o_orderpriority")
    old = orders.where("o_orderstatus <> 'P'").select("path", F.col("o_orderpriority").alias("content"))
    edited = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority"))
    new = orders.where("o_orderstatus <> 'F'").select("path", edited.alias("content"))
    return versions.changed_notebooks(old, new)


@query(
    "j4_apply_overrides",
    sql_over("graph_edges", """
        SELECT src, dst, relationship, CASE WHEN relationship = 'writes_to' THEN 1.0::FLOAT ELSE confidence_score END AS confidence_score FROM graph_edges
        UNION ALL SELECT 'manual:' || s_suppkey, 's:' || s_suppkey, 'contains', 1.0::FLOAT FROM supplier"""),
)
def j4(spark, sf):
    edges = stored.edges(spark, sf).select("src", "dst", "relationship", "confidence_score")
    raised = edges.where("relationship = 'writes_to'").withColumn("confidence_score", F.lit(1.0).cast("float"))
    added = inputs.table(spark, sf, "supplier").select(
        F.concat(F.lit("manual:"), F.col("s_suppkey").cast("string")).alias("src"), F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("dst"),
        F.lit("contains").alias("relationship"), F.lit(1.0).cast("float").alias("confidence_score"),
    )
    return versions.apply_overrides(edges, raised.unionByName(added), ["src", "dst", "relationship"])


@query(
    "t1_scd1_paths",
    sql_over("path_events", "SELECT entity_id, arg_max(path, (seq, event_id)) AS path, epoch_us(max(seq)) AS seq_us FROM path_events GROUP BY entity_id"),
)
def t1(spark, sf):
    log, checkpoint = scratch_path(spark, "paths-log"), scratch_path(spark, "stream")
    stream = paths.stream_notebook_paths(spark, path_csv(spark, sf), EVENT_SCHEMA, files_per_trigger=2)
    keys, order = ["entity_id"], ["fechora_ultima_ejecucion_job", "event_id"]
    keyed.start_scd1(stream, keys, order, log, checkpoint).awaitTermination()
    rows = keyed.current(spark, log, keys, order)
    return rows.select("entity_id", "path", F.unix_micros("fechora_ultima_ejecucion_job").alias("seq_us"))


def _line_files(spark, sf, columns) -> str:
    """Line items as files to stream, scattered so that late rows occur; a file, and the task that writes it, is of bounded size."""
    folder = scratch_path(spark, "lines")
    rows = inputs.table(spark, sf, "lineitem").select(*columns)
    files = max(6, 3 * -(-rows.count() // (3 * LINES_A_FILE)))
    rows.repartition(files, F.col("tie") % files).write.parquet(folder)
    return folder


#: Line items a file of the stream holds, about.
LINES_A_FILE = 1_000_000

_TIE = "l_orderkey * 10 + l_linenumber"


def _stream_files(spark, folder):
    """The files in three batches, two files a batch at least."""
    rows = spark.read.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(2, -(-len(rows.inputFiles()) // 3))).parquet(folder)


@query(
    "t2_scd1_nodes",
    f"""SELECT 'n:' || l_partkey AS id, arg_max(l_returnflag || l_linestatus, (l_shipdate, {_TIE}, l_quantity)) AS entity_name,
               CAST(max(l_shipdate) AS DATE) AS created_on FROM lineitem GROUP BY l_partkey""",
)
def t2(spark, sf):
    columns = [
        F.concat(F.lit("n:"), F.col("l_partkey").cast("string")).alias("id"), F.concat("l_returnflag", "l_linestatus").alias("entity_name"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"), F.expr(_TIE).alias("tie"), "l_quantity",
    ]
    stream = _stream_files(spark, _line_files(spark, sf, columns))
    log, order = scratch_path(spark, "nodes-log"), ["created_at", "tie", "l_quantity"]
    keyed.start_scd1(stream, ["id"], order, log, scratch_path(spark, "stream")).awaitTermination()
    return keyed.current(spark, log, ["id"], order).select("id", "entity_name", F.to_date("created_at").alias("created_on"))


@query(
    "t3_scd1_edges",
    f"""SELECT 'n:' || l_partkey AS src, 's:' || l_suppkey AS dst, l_returnflag AS relationship,
               arg_max(l_quantity, (l_shipdate, {_TIE}, l_quantity)) AS weight, CAST(max(l_shipdate) AS DATE) AS created_on FROM lineitem GROUP BY ALL""",
)
def t3(spark, sf):
    columns = [
        F.concat(F.lit("n:"), F.col("l_partkey").cast("string")).alias("src"), F.concat(F.lit("s:"), F.col("l_suppkey").cast("string")).alias("dst"),
        F.col("l_returnflag").alias("relationship"), F.col("l_quantity").alias("weight"), F.col("l_shipdate").cast("timestamp").alias("created_at"),
        F.expr(_TIE).alias("tie"),
    ]
    stream = _stream_files(spark, _line_files(spark, sf, columns))
    keys, order, log = ["src", "dst", "relationship"], ["created_at", "tie", "weight"], scratch_path(spark, "edges-log")
    keyed.start_scd1(stream, keys, order, log, scratch_path(spark, "stream")).awaitTermination()
    return keyed.current(spark, log, keys, order).select(*keys, "weight", F.to_date("created_at").alias("created_on"))


def _two_versions(spark, sf):
    """A keyed table before and after: some rows leave, some come, some change."""
    orders = inputs.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    old = orders.where("o_orderstatus <> 'P'").select("id", F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("price"))
    name = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("done")).otherwise(F.col("o_orderpriority"))
    new = orders.where("o_orderstatus <> 'F'").select("id", name.alias("name"), F.col("o_totalprice").alias("price"))
    return old, new


@query(
    "t4_change_feed",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'delete' AS change_type, o_orderpriority AS name, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'insert', CASE WHEN o_orderpriority = '1-URGENT' THEN 'done' ELSE o_orderpriority END, o_totalprice
                 FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), v.kind, CASE v.kind WHEN 'update_preimage' THEN o_orderpriority ELSE 'done' END, o_totalprice
                 FROM orders, (VALUES ('update_preimage'), ('update_postimage')) AS v(kind)
                 WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority = '1-URGENT'""",
)
def t4(spark, sf):
    return versions.change_feed(*_two_versions(spark, sf), ["id"])


@query(
    "t5_upsert_batch",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' THEN 'done' ELSE o_orderpriority END AS name,
              o_totalprice AS price, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS seq FROM orders""",
)
def t5(spark, sf):
    """Merged twice with the same batch, which must not matter."""
    old, new = _two_versions(spark, sf)
    table = old.withColumn("seq", F.lit(1))
    batch = new.withColumn("seq", F.lit(2))
    once = versions.upsert_batch(table, batch, ["id"], ["seq"])
    return versions.upsert_batch(once, batch, ["id"], ["seq"])


@query("t7_dedupe_events", "SELECT event_id, epoch_us(ts) AS ts_us, user_id FROM events")
def t7(spark, sf):
    """Every event arrives twice, a quarter of the time span after the other; a day's delay lets older state go."""
    events = inputs.table(spark, sf, "events").select("event_id", "ts", "user_id")
    folder, out = scratch_path(spark, "events"), scratch_path(spark, "events-once")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    quarters, latest = events.select(at.alias("at")).agg(F.percentile_approx("at", [0.25, 0.5, 0.75]), F.max("at")).first()
    before = None
    for end in (*quarters, latest):
        span = events.where((at <= end) & (at > before if before is not None else F.lit(True)))
        span.unionByName(span).repartition(1).write.mode("append").parquet(folder)
        before = end
    keyed.run_to_table(keyed.dedupe_events(_stream_files(spark, folder), "event_id", "ts", "1 day"), out, scratch_path(spark, "stream"))
    return spark.read.parquet(out).select("event_id", F.unix_micros("ts").alias("ts_us"), "user_id")


_MOMENT = "TIMESTAMP '1998-01-01 00:00:00'"


@query(
    "t8_graph_as_of",
    sql_over("history", f"""SELECT id, arg_max(content, (changed_at, tie)) AS content, max((changed_at, tie))[2] AS tie
                            FROM history WHERE changed_at <= {_MOMENT} GROUP BY id"""),
)
def t8(spark, sf):
    rows = inputs.derived(spark, sf, "history")
    moment = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return versions.graph_as_of(rows, ["id"], "changed_at", moment, ["changed_at", "tie"]).select("id", "content", "tie")


@query(
    "t9_soft_delete",
    sql_over("graph_nodes", """SELECT id, is_active AND entity_type <> 'function' AS is_active,
             CAST(CASE WHEN is_active AND entity_type = 'function' THEN 2 ELSE 1 END AS INT) AS version,
             CASE WHEN is_active AND entity_type = 'function' THEN DATE '2024-06-01' ELSE created_on END AS updated_on FROM graph_nodes"""),
)
def t9(spark, sf):
    nodes = stored.nodes(spark, sf)
    found = nodes.where("entity_type <> 'function' OR NOT is_active")
    changed = versions.soft_delete(nodes, found, ["id"], stored.fixed_stamp())
    return changed.select("id", "is_active", "version", F.to_date("updated_at").alias("updated_on"))
