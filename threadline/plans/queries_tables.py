"""Checked queries: sources and sinks, scalar functions, quality, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadline import schemas
from threadline.functions import text as fx
from threadline.operators import graph, lookups, quality
from threadline.plans import inputs, queries_lineage, stored
from threadline.plans.catalog import query
from threadline.plans.inputs import sql_over
from threadline.session import scratch_path
from threadline.sources import exports as export_files
from threadline.sources import lineage_files, paths, tables

_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def path_csv(spark, sf, files: int = 7) -> str:
    """The path events as CSV files, in an order unlike their sequence."""
    folder = scratch_path(spark, "paths")
    rows = inputs.derived(spark, sf, "path_events").select(
        "entity_id", "path", F.date_format("seq", _TIME).alias("fechora_ultima_ejecucion_job"), "event_id"
    )
    rows.repartition(files, F.col("event_id") % files).write.option("header", "true").csv(folder)
    return folder


EVENT_SCHEMA = T.StructType(schemas.PATH_LIST_SCHEMA.fields + [T.StructField("event_id", T.LongType())])


@query(
    "s1_read_notebook_paths",
    sql_over("path_events", "SELECT entity_id, path, epoch_us(seq) AS seq_us, event_id FROM path_events"),
)
def s1(spark, sf):
    """The stream and its batch twin read the same files; the stream's rows are shown."""
    from threadline.streaming import keyed

    folder, out = path_csv(spark, sf), scratch_path(spark, "paths-read")
    stream = paths.stream_notebook_paths(spark, folder, EVENT_SCHEMA, files_per_trigger=3)
    keyed.run_to_table(stream, out, scratch_path(spark, "stream"))
    rows = spark.read.parquet(out)
    return rows.select("entity_id", "path", F.unix_micros("fechora_ultima_ejecucion_job").alias("seq_us"), "event_id")


@query(
    "s1_ingest_changed_paths",
    sql_over("path_events", "SELECT entity_id, path, event_id, CASE WHEN event_id % 2 = 1 THEN 'owner ' || event_id % 3 END AS owner FROM path_events"),
)
def s1_ingest(spark, sf):
    """Two deliveries, the second with a further column, read in as many calls; a third call finds nothing new."""
    folder, log = scratch_path(spark, "lists"), scratch_path(spark, "lists-log")
    events = inputs.derived(spark, sf, "path_events").select("entity_id", "path", "event_id")
    owner = F.concat(F.lit("owner "), (F.col("event_id") % 3).cast("string"))
    for delivery in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1").select(owner.alias("owner"), "event_id", "path", "entity_id")):
        delivery.write.mode("append").option("header", "true").csv(folder)
        paths.ingest_paths(spark, folder, log, {"event_id": "long"})
    paths.ingest_paths(spark, folder, log)
    return paths.ingested_paths(spark, log).select("entity_id", "path", "event_id", "owner")


@query("s2_stamp_processing_time", sql_over("path_events", "SELECT path, event_id, true AS stamped FROM path_events"))
def s2(spark, sf):
    rows = paths.stamp_processing_time(inputs.derived(spark, sf, "path_events"))
    return rows.select("path", "event_id", (F.col("processing_time") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"))


@query(
    "s5_decode_export_payload",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 1 AND length(text) % 4 = 0 AND regexp_full_match(text, '[A-Za-z0-9+/]+={0,2}')
                            THEN md5(from_base64(text)) ELSE md5(text) END AS digest FROM documents""",
)
def s5(spark, sf):
    """Every second payload is base64, the others plain."""
    docs = inputs.table(spark, sf, "documents")
    payload = F.when(F.col("doc_id") % 2 == 0, F.base64(F.encode("text", "UTF-8"))).otherwise(F.col("text"))
    decoded = docs.select("doc_id", payload.alias("payload")).select("doc_id", export_files.decode_export_payload(F.col("payload")).alias("content"))
    return decoded.select("doc_id", F.md5("content").alias("digest"))


@query(
    "s6_empty_nodes",
    sql_over("graph_nodes", """SELECT id, entity_type, entity_name, created_on, (embedding IS NOT NULL) AS embedded FROM graph_nodes"""),
)
def s6(spark, sf):
    """Rows appended to the empty table take its types."""
    rows = tables.empty_nodes(spark).unionByName(tables.conform(inputs.nodes(spark, sf), schemas.NODES_SCHEMA))
    return rows.select("id", "entity_type", "entity_name", F.to_date("created_at").alias("created_on"), F.col("embedding").isNotNull().alias("embedded"))


@query("s7_empty_edges", sql_over("graph_edges", "SELECT src, dst, relationship, weight, expression FROM graph_edges"))
def s7(spark, sf):
    rows = tables.empty_edges(spark).unionByName(tables.conform(inputs.edges(spark, sf), schemas.EDGES_SCHEMA))
    return rows.select("src", "dst", "relationship", "weight", F.col("properties")["expression"].alias("expression"))


@query(
    "s8_write_graph_tables",
    sql_over("graph_edges graph_nodes", """SELECT 'node' AS kind, entity_type AS part, count(*) AS n FROM graph_nodes GROUP BY ALL
                                          UNION ALL SELECT 'edge', relationship, count(*) FROM graph_edges GROUP BY ALL"""),
)
def s8(spark, sf):
    folder = scratch_path(spark, "graph")
    tables.write_graph_tables(inputs.nodes(spark, sf), inputs.edges(spark, sf), folder)
    nodes = tables.read_nodes(spark, folder).groupBy(F.col("entity_type").alias("part")).agg(F.count("*").alias("n"))
    edges = tables.read_edges(spark, folder).groupBy(F.col("relationship").alias("part")).agg(F.count("*").alias("n"))
    return nodes.select(F.lit("node").alias("kind"), "part", "n").unionByName(edges.select(F.lit("edge").alias("kind"), "part", "n"))


@query(
    "s9_write_path_cache",
    sql_over("graph_edges", "SELECT DISTINCT src AS src_node_id, dst AS tgt_node_id, 1 AS min_hops FROM graph_edges WHERE relationship <> 'contains' AND src <> dst"),
)
def s9(spark, sf):
    """Direct neighbours read back from the one partition that holds them."""
    folder = scratch_path(spark, "cache")
    tables.write_path_cache(stored.path_cache(spark, sf), folder)
    return tables.read_path_cache(spark, folder).where("min_hops = 1").select("src_node_id", "tgt_node_id", "min_hops")


@query(
    "s10_read_lineage_json",
    queries_lineage._over_cells(
        """SELECT 'entity' AS kind, id AS a, name AS b, type FROM lineage_entities
           UNION ALL SELECT 'relationship', src, dst, type FROM lineage_links""",
        *queries_lineage.LINEAGE_CTES,
    ),
)
def s10(spark, sf):
    folder = scratch_path(spark, "lineage-json")
    lineage_files.write_lineage_json(lineage_files.lineage_documents(*queries_lineage.whole_lineage(spark, sf)), folder)
    found, linked = lineage_files.read_lineage_json(spark, folder, multi_line=False)
    return found.select(F.lit("entity").alias("kind"), F.col("id").alias("a"), F.col("name").alias("b"), "type").unionByName(
        linked.select(F.lit("relationship").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "type")
    )


@query(
    "s11_write_lineage_json",
    queries_lineage._over_cells(
        """SELECT e.path, to_json({'entities': e.entities, 'relationships': coalesce(r.relationships, [])})::VARCHAR AS document
           FROM (SELECT path, list({'id': id, 'type': type, 'name': name} ORDER BY id) AS entities FROM lineage_entities GROUP BY path) e
           LEFT JOIN (SELECT path, list({'src': src, 'dst': dst, 'type': type} ORDER BY src, dst, type) AS relationships
                      FROM lineage_links GROUP BY path) r USING (path)""",
        *queries_lineage.LINEAGE_CTES,
    ),
)
def s11(spark, sf):
    return lineage_files.lineage_documents(*queries_lineage.whole_lineage(spark, sf))


@query("s12_export_csv", sql_over("graph_edges", "SELECT src, dst, relationship, expression FROM graph_edges"))
def s12(spark, sf):
    folder = scratch_path(spark, "answer-csv")
    rows = stored.edges(spark, sf).select("src", "dst", "relationship", F.col("properties")["expression"].alias("expression"))
    lineage_files.export_csv(rows, folder)
    return spark.read.schema(rows.schema).option("header", "true").csv(folder)


# scalar functions


@query(
    "p7_entity_id",
    "SELECT CASE p_partkey % 4 WHEN 0 THEN 'var:' WHEN 1 THEN 'table:' WHEN 2 THEN 'path:' ELSE 'function:' END || p_name AS id, p_partkey FROM part",
)
def p7(spark, sf):
    part = inputs.table(spark, sf, "part")
    kinds = F.array(*[F.lit(k) for k in ("variable", "table", "path", "function")])
    kind = F.get(kinds, (F.col("p_partkey") % 4).cast("int"))
    return part.select(fx.entity_id(kind, F.col("p_name")).alias("id"), "p_partkey")


@query(
    "p8_normalize_table_name",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || '.' || p_type || '.' || p_name WHEN 1 THEN p_type || '.' || p_name
              WHEN 2 THEN p_name END AS name FROM part""",
)
def p8(spark, sf):
    part = inputs.table(spark, sf, "part")
    kind = F.col("p_partkey") % 4
    written = (
        F.when(kind == 0, F.concat_ws(".", F.concat(F.lit("`"), "p_brand", F.lit("`")), "p_type", F.concat(F.lit("`"), "p_name", F.lit("`"))))
        .when(kind == 1, F.concat("p_type", F.lit(" . "), "p_name"))
        .when(kind == 2, F.concat(F.lit("`"), "p_name", F.lit("`")))
        .otherwise(F.concat("p_type", F.lit(".")))
    )
    return part.select("p_partkey", fx.normalize_table_name(written).alias("name"))


@query(
    "p9_ordered_distinct",
    """SELECT conv_id, string_agg(role, ',' ORDER BY first_turn) AS roles
       FROM (SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY ALL) GROUP BY conv_id""",
)
def p9(spark, sf):
    talks = inputs.table(spark, sf, "conversations")
    listed = talks.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda t: t["role"]).alias("roles"))
    return listed.select("conv_id", F.array_join(fx.ordered_distinct(F.col("roles")), ",").alias("roles"))


@query(
    "p10_edge_id",
    sql_over("graph_edges graph_nodes", """
        SELECT 'edge' AS kind, sha256(concat_ws(chr(1), src, dst, relationship, sha256(coalesce(expression, '')))) AS id FROM graph_edges
        UNION ALL SELECT 'node', sha256(concat_ws(chr(1), entity_type, entity_name)) FROM graph_nodes"""),
)
def p10(spark, sf):
    edges = inputs.derived(spark, sf, "graph_edges").select(
        F.lit("edge").alias("kind"), fx.edge_id(F.col("src"), F.col("dst"), F.col("relationship"), F.col("expression")).alias("id")
    )
    nodes = inputs.derived(spark, sf, "graph_nodes").select(F.lit("node").alias("kind"), fx.node_id(F.col("entity_type"), F.col("entity_name")).alias("id"))
    return edges.unionByName(nodes)


@query(
    "p11_embedding_text",
    sql_over("graph_nodes", """
        SELECT id, concat_ws(chr(10), 'Entity Type: ' || entity_type, 'Entity Name: ' || entity_name,
                             'Properties: brand=' || brand || ', size=' || size || ', type=' || kind) AS text FROM graph_nodes"""),
)
def p11(spark, sf):
    nodes = inputs.nodes(spark, sf)
    return nodes.select("id", fx.embedding_text(F.col("entity_type"), F.col("entity_name"), F.col("properties")).alias("text"))


@query(
    "p12_filter_nodes",
    sql_over("graph_nodes", "SELECT id, entity_name FROM graph_nodes WHERE entity_type = 'table' AND is_active AND embedding IS NOT NULL"),
)
def p12(spark, sf):
    return lookups.filter_nodes(stored.nodes(spark, sf), "table").select("id", "entity_name")


@query(
    "p13_filter_edges",
    sql_over("graph_edges", "SELECT src, dst, created_on FROM graph_edges WHERE relationship = 'reads_from' AND created_on >= DATE '2024-06-01'"),
)
def p13(spark, sf):
    rows = lookups.filter_edges(stored.edges(spark, sf), "reads_from", F.lit("2024-06-01").cast("timestamp"))
    return rows.select("src", "dst", F.to_date("created_at").alias("created_on"))


@query(
    "p14_upstream_edges",
    sql_over("graph_edges graph_nodes", "SELECT src, dst, relationship FROM graph_edges WHERE dst IN (SELECT id FROM graph_nodes WHERE entity_type = 'table')"),
)
def p14(spark, sf):
    wanted = stored.nodes(spark, sf).where("entity_type = 'table'").select("id")
    return lookups.upstream_edges(stored.edges(spark, sf), wanted).select("src", "dst", "relationship")


@query(
    "p15_downstream_edges",
    sql_over("graph_edges graph_nodes", """SELECT src, dst, relationship FROM graph_edges
             WHERE relationship = 'transforms' AND src IN (SELECT id FROM graph_nodes WHERE entity_type = 'column')"""),
)
def p15(spark, sf):
    wanted = stored.nodes(spark, sf).where("entity_type = 'column'").select("id")
    return lookups.downstream_edges(stored.edges(spark, sf), wanted, "transforms").select("src", "dst", "relationship")


@query(
    "p16_redact_pii",
    r"""SELECT doc_id, md5(text) AS digest, length(text) AS n FROM (SELECT doc_id,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
            '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g'),
            '\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b', '[IP]', 'g'),
            '\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b', '[CARD]', 'g'),
            '\+?[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}\b', '[PHONE]', 'g') AS text FROM documents)""",
)
def p16(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", fx.redact_pii(F.col("text")).alias("text"))
    return docs.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


@query(
    "p17_parse_canonical_name",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'column' END AS kind,
              CASE WHEN p_partkey % 3 < 2 THEN 'cat' END AS "catalog", CASE WHEN p_partkey % 3 < 2 THEN p_type END AS "schema",
              CASE WHEN p_partkey % 3 < 2 THEN p_name END AS table_name, CASE WHEN p_partkey % 3 = 1 THEN 'c' || p_size END AS column_name FROM part""",
)
def p17(spark, sf):
    part = inputs.table(spark, sf, "part")
    kind = F.col("p_partkey") % 3
    name = (
        F.when(kind == 0, F.concat_ws(".", F.lit("cat"), "p_type", "p_name"))
        .when(kind == 1, F.concat_ws(".", F.lit("cat"), "p_type", "p_name", F.concat(F.lit("c"), "p_size")))
        .otherwise(F.col("p_name"))
    )
    return part.select("p_partkey", fx.parse_canonical_name(name).alias("n")).select("p_partkey", "n.*")


@query(
    "p18_detect_path_column",
    sql_over("path_events", """SELECT c AS "column", share FROM (SELECT avg(CASE WHEN path LIKE '/%' THEN 1.0 ELSE 0.0 END) AS p,
             avg(CASE WHEN entity_id LIKE '/%' THEN 1.0 ELSE 0.0 END) AS e FROM path_events), LATERAL (VALUES ('path', p), ('entity_id', e)) AS v(c, share)"""),
)
def p18(spark, sf):
    return paths.path_column_shares(inputs.derived(spark, sf, "path_events").select("entity_id", "path", "event_id"))


# quality


@query(
    "q1_expect_all",
    sql_over("graph_edges", """SELECT rule, CAST(passed AS BIGINT) AS passed, CAST(n - passed AS BIGINT) AS failed FROM (
        SELECT count(*) AS n, count(src) AS s, count(dst) AS d,
               count(*) FILTER (relationship IN ('reads_from', 'writes_to', 'transforms', 'contains')) AS r FROM graph_edges),
        LATERAL (VALUES ('valid_src', s), ('valid_dst', d), ('valid_relationship', r)) AS v(rule, passed)"""),
)
def q1(spark, sf):
    return quality.expect_all(stored.edges(spark, sf), quality.EDGE_RULES)


_PATH_RULES = {"path_not_null": "path IS NOT NULL", "workspace_prefix": "path LIKE '/Workspace/click/%' OR path LIKE '/Workspace/view/%'"}


@query(
    "q2_expect_or_drop",
    sql_over("path_events", """SELECT event_id, path LIKE '/Workspace/click/%' OR path LIKE '/Workspace/view/%' AS kept,
             CASE WHEN path LIKE '/Workspace/click/%' OR path LIKE '/Workspace/view/%' THEN '' ELSE 'workspace_prefix' END AS broken FROM path_events"""),
)
def q2(spark, sf):
    kept, rejected = quality.expect_or_drop(inputs.derived(spark, sf, "path_events"), _PATH_RULES)
    return kept.select("event_id", F.lit(True).alias("kept"), F.lit("").alias("broken")).unionByName(
        rejected.select("event_id", F.lit(False).alias("kept"), F.array_join("broken_rules", ",").alias("broken"))
    )


@query(
    "q3_check_referential_integrity",
    sql_over("graph_edges graph_nodes", """SELECT src, dst, relationship, 'dst' AS missing FROM graph_edges WHERE dst NOT IN (SELECT id FROM graph_nodes)
             UNION ALL SELECT src, dst, relationship, 'src' FROM graph_edges WHERE src NOT IN (SELECT id FROM graph_nodes)"""),
)
def q3(spark, sf):
    return quality.check_referential_integrity(stored.edges(spark, sf), stored.nodes(spark, sf))


@query(
    "q4_check_unique_keys",
    sql_over("graph_edges", "SELECT src, dst, count(*) AS n FROM graph_edges GROUP BY ALL HAVING count(*) > 1 UNION ALL "
             "SELECT CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
)
def q4(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("src"), F.col("l_suppkey").cast("string").alias("dst"))
    return quality.check_unique_keys(stored.edges(spark, sf), ["src", "dst"]).unionByName(quality.check_unique_keys(lines, ["src", "dst"]))


@query(
    "q5_graph_metrics",
    sql_over("graph_edges graph_nodes", """
        SELECT 'nodes_by_type' AS metric, entity_type AS label, count(*) AS n FROM graph_nodes GROUP BY ALL
        UNION ALL SELECT 'edges_by_type', relationship, count(*) FROM graph_edges GROUP BY ALL
        UNION ALL SELECT 'nodes_added', 'rows', count(*) FROM graph_nodes WHERE NOT is_active
        UNION ALL SELECT 'edges_added', 'rows', count(*) FROM graph_edges WHERE relationship = 'writes_to'"""),
)
def q5(spark, sf):
    nodes, edges = stored.nodes(spark, sf), stored.edges(spark, sf)
    return quality.graph_metrics(nodes, edges, nodes.where("is_active"), edges.where("relationship <> 'writes_to'"))


@query("q6_embedding_coverage", sql_over("graph_nodes", "SELECT count(embedding) AS with_embedding, count(*) AS n FROM graph_nodes"))
def q6(spark, sf):
    return quality.embedding_coverage(stored.nodes(spark, sf))


@query(
    "q7_filter_confidence",
    sql_over("graph_edges", """SELECT src, dst, relationship, low FROM (
        SELECT *, coalesce(round(CAST(confidence_score AS DOUBLE), 6) < 0.7, true) AS low FROM graph_edges)"""),
)
def q7(spark, sf):
    edges = stored.edges(spark, sf)
    kept = quality.filter_confidence(edges).select("src", "dst", "relationship", F.lit(False).alias("low"))
    low = quality.mark_low_confidence(edges).where("low_confidence").select("src", "dst", "relationship", F.lit(True).alias("low"))
    return kept.unionByName(low)


@query(
    "q10_validate_types",
    """SELECT c AS "column", k AS declared, CAST(present AS BIGINT) AS non_null, CAST(bad AS BIGINT) AS invalid FROM (
        SELECT count(*) AS n, count(*) FILTER (try_cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) IS NULL) AS bad_k,
               count(*) FILTER (try_cast(event_type AS INT) IS NULL) AS bad_e FROM events),
        LATERAL (VALUES ('k', 'int', n, bad_k), ('event_type', 'int', n, bad_e)) AS v(c, k, present, bad)""",
)
def q10(spark, sf):
    rows = inputs.table(spark, sf, "events").select(F.regexp_extract("props", '"k": ([0-9]+)', 1).alias("k"), "event_type")
    return quality.validate_types(rows, {"k": "int", "event_type": "int"})


# joins


@query(
    "j1_direct_dependents",
    sql_over("graph_edges graph_nodes", """SELECT DISTINCT s.entity_name, t.entity_name AS dependent FROM graph_edges e
        JOIN graph_nodes s ON s.id = e.src JOIN graph_nodes t ON t.id = e.dst WHERE e.relationship = 'transforms' AND s.entity_type = 'column'"""),
)
def j1(spark, sf):
    nodes = stored.nodes(spark, sf)
    names = nodes.where("entity_type = 'column'").select("entity_name")
    return lookups.direct_dependents(stored.edges(spark, sf), nodes, names, "transforms")


@query(
    "j2_validate_paths",
    sql_over("path_events inventory", "SELECT DISTINCT path, path IN (SELECT path FROM inventory) AS is_valid FROM path_events"),
)
def j2(spark, sf):
    return lookups.validate_paths(inputs.derived(spark, sf, "path_events"), inputs.derived(spark, sf, "inventory"))


@query(
    "j5_resolve_node_names",
    sql_over("graph_edges graph_nodes", """SELECT e.src, e.dst, e.relationship, s.entity_name AS src_name, s.entity_type AS src_type,
        t.entity_name AS dst_name, t.entity_type AS dst_type FROM graph_edges e
        LEFT JOIN graph_nodes s ON s.id = e.src LEFT JOIN graph_nodes t ON t.id = e.dst"""),
)
def j5(spark, sf):
    found = lookups.resolve_node_names(stored.edges(spark, sf), stored.nodes(spark, sf))
    return found.select("src", "dst", "relationship", "src_name", "src_type", "dst_name", "dst_type")
