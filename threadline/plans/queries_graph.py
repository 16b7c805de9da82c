"""Checked queries: graph tables and traversal."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.operators import graph, traverse
from threadline.plans import inputs, queries_lineage, stored
from threadline.plans.catalog import query
from threadline.plans.inputs import sql_over

_FLOW = "flow AS MATERIALIZED (SELECT DISTINCT src, dst FROM graph_edges WHERE relationship <> 'contains')"


def _walks(name: str, hops: int, flow: str = "flow", starts: str = "SELECT DISTINCT src FROM flow", near: str = "src", far: str = "dst") -> str:
    """CTEs w0..wn: distinct ends of walks of exactly that many edges, keyed by the start."""
    parts = [f"{name}0 AS (SELECT src AS root, src AS node FROM ({starts}))"]
    for hop in range(1, hops + 1):
        parts.append(
            f"{name}{hop} AS (SELECT DISTINCT w.root, e.{far} AS node FROM {name}{hop - 1} w JOIN {flow} e ON e.{near} = w.node)"
        )
    union = " UNION ALL ".join(f"SELECT root, node, {hop} AS depth FROM {name}{hop}" for hop in range(1, hops + 1))
    return ", ".join(parts + [f"{name} AS ({union})"])


# Shortest pairs: first level of each pair, smallest path on that level.
def _pairs(name: str, hops: int, flow: str = "flow", cycles: bool = False) -> str:
    keep = "true" if cycles else "e.dst <> p.src"
    parts = [f"{name}0 AS MATERIALIZED (SELECT DISTINCT src, src AS tgt, [src] AS path FROM {flow})"]
    seen = []
    for hop in range(1, hops + 1):
        old = " AND ".join(
            [f"NOT EXISTS (SELECT 1 FROM {name}{h} q WHERE q.src = p.src AND q.tgt = e.dst)" for h in seen] or ["true"]
        )
        parts.append(
            f"{name}{hop} AS MATERIALIZED (SELECT p.src, e.dst AS tgt, min(list_append(p.path, e.dst)) AS path "
            f"FROM {name}{hop - 1} p JOIN {flow} e ON e.src = p.tgt WHERE {keep} AND {old} GROUP BY p.src, e.dst)"
        )
        seen.append(hop)
    union = " UNION ALL ".join(f"SELECT src, tgt, {hop} AS min_hops, path FROM {name}{hop}" for hop in range(1, hops + 1))
    return ", ".join(parts + [f"{name} AS MATERIALIZED ({union})"])


_CACHE = _pairs("pc", 5)


@query(
    "g1_build_nodes",
    queries_lineage._over_cells("""
        SELECT DISTINCT id, type AS entity_type, name AS entity_name, true AS is_active, CAST(1 AS INT) AS version, DATE '2024-06-01' AS created_on
        FROM lineage_entities""", *queries_lineage.LINEAGE_CTES),
)
def g1(spark, sf):
    entities, _ = queries_lineage.whole_lineage(spark, sf)
    entities = entities.select("*", F.lit(0).alias("cell_no"), F.lit(0).alias("ord"))
    built = graph.build_nodes(graph.dedupe_entities(entities), stored.fixed_stamp())
    return built.select("id", "entity_type", "entity_name", "is_active", "version", F.to_date("created_at").alias("created_on"))


@query(
    "g2_build_edges",
    sql_over("graph_edges", """
        SELECT src, dst, CASE relationship WHEN 'derives_from' THEN 'transforms' ELSE relationship END AS relationship,
               confidence_score, expression, is_active, version,
               sha256(concat_ws(chr(1), src, dst, CASE relationship WHEN 'derives_from' THEN 'transforms' ELSE relationship END,
                                sha256(expression))) AS edge_id
        FROM (SELECT *, true AS is_active, CAST(1 AS INT) AS version FROM graph_edges)"""),
)
def g2(spark, sf):
    found = inputs.edges(spark, sf).withColumnRenamed("relationship", "type")
    built = graph.build_edges(found.select("src", "dst", "type", "properties", "confidence_score"), stored.fixed_stamp())
    return built.select(
        "edge_id", "src", "dst", "relationship", "confidence_score",
        F.col("properties")["expression"].alias("expression"), "is_active", "version",
    )


_CATALOG_COLUMNS = """catalog_columns AS (
    SELECT 'cat' AS "catalog", 'sch' AS "schema", replace(p_name, ' ', '_') || '_' || p_partkey AS table_name, c.col AS "column"
    FROM part, (VALUES ('brand'), ('kind'), ('size')) AS c(col))"""


@query(
    "g3_containment_edges",
    sql_over("notebook_cells", """
        SELECT DISTINCT src, dst, 'contains' AS relationship FROM (
            SELECT "catalog" AS src, "catalog" || '.' || "schema" AS dst FROM catalog_columns
            UNION ALL SELECT "catalog" || '.' || "schema", "catalog" || '.' || "schema" || '.' || table_name FROM catalog_columns
            UNION ALL SELECT "catalog" || '.' || "schema" || '.' || table_name,
                             "catalog" || '.' || "schema" || '.' || table_name || '.' || "column" FROM catalog_columns
            UNION ALL SELECT path, path || '#' || k FROM notebook_cells)""", _CATALOG_COLUMNS),
)
def g3(spark, sf):
    columns = inputs.table(spark, sf, "part").select(
        F.lit("cat").alias("catalog"), F.lit("sch").alias("schema"),
        F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), "p_partkey").alias("table_name"),
        F.explode(F.array(F.lit("brand"), F.lit("kind"), F.lit("size"))).alias("column"),
    )
    return graph.union_lineage(graph.containment_edges(columns), graph.cell_containment_edges(inputs.cells(spark, sf)))


@query(
    "g4_path_tree",
    sql_over("code_files", """
        SELECT DISTINCT parent, child, name, is_file FROM (
            SELECT NULL AS parent, 'src' AS child, 'src' AS name, false AS is_file FROM code_files
            UNION ALL SELECT 'src', 'src/' || split_part(path, '/', 2), split_part(path, '/', 2), false FROM code_files
            UNION ALL SELECT 'src/' || split_part(path, '/', 2), path, split_part(path, '/', 3), true FROM code_files)"""),
)
def g4(spark, sf):
    return graph.path_tree_edges(inputs.derived(spark, sf, "code_files"))


_DOWN = _walks("w", 5, "hop", "SELECT DISTINCT id AS src FROM graph_nodes WHERE entity_type = 'table'")


@query(
    "g5_downstream",
    sql_over("graph_edges graph_nodes", """
        SELECT w.root, n.id, n.entity_name, n.is_active, w.depth FROM w JOIN graph_nodes n ON n.id = w.node
        WHERE n.entity_type = 'table'""",
        "hop AS (SELECT DISTINCT src, dst FROM graph_edges WHERE relationship = 'transforms')", _DOWN),
)
def g5(spark, sf):
    nodes = stored.nodes(spark, sf)
    tables = nodes.where(F.col("entity_type") == "table")
    found = traverse.downstream(stored.edges(spark, sf), tables.select(F.col("id").alias("root")), "transforms")
    return found.join(tables.select(F.col("id").alias("node"), "entity_name", "is_active"), "node").select(
        "root", F.col("node").alias("id"), "entity_name", "is_active", "depth"
    )


@query(
    "g6_upstream",
    sql_over("graph_edges graph_nodes", """
        SELECT root, src, dst, relationship, depth, CAST(count(*) AS BIGINT) AS n_walks FROM up GROUP BY ALL""",
        """up AS (SELECT n.id AS root, e.src, e.dst, e.relationship, 1 AS depth
                  FROM graph_edges e JOIN graph_nodes n ON e.dst = n.id WHERE n.id LIKE 'n:%'
                  UNION ALL
                  SELECT u.root, e.src, e.dst, e.relationship, u.depth + 1 FROM graph_edges e JOIN up u ON e.dst = u.src WHERE u.depth < 10)"""),
)
def g6(spark, sf):
    roots = stored.nodes(spark, sf).where(F.col("id").startswith("n:")).select(F.col("id").alias("root"))
    return traverse.upstream_walks(stored.edges(spark, sf), roots, 10)


def _lineage_sql(hops: int) -> str:
    """Edges within ``hops`` of every table, both ways, over flow(src, dst, relationship)."""
    starts = "SELECT DISTINCT id AS src FROM graph_nodes WHERE entity_type = 'table'"
    down = _walks("d", hops - 1, "flow", starts)
    up = _walks("u", hops - 1, "flow", starts, near="dst", far="src")
    near = """closest AS (
        SELECT direction, root, node, min(depth) AS depth FROM (
            SELECT 'downstream' AS direction, * FROM (SELECT root, node, 0 AS depth FROM d0 UNION ALL SELECT * FROM d)
            UNION ALL SELECT 'upstream', * FROM (SELECT root, node, 0 AS depth FROM u0 UNION ALL SELECT * FROM u)
        ) GROUP BY ALL)"""
    return ", ".join([down, up, near])


_LINEAGE_SELECT = """
    SELECT c.root, c.direction, e.src, e.dst, e.relationship, c.depth + 1 AS depth FROM closest c JOIN flow e
    ON (c.direction = 'downstream' AND e.src = c.node) OR (c.direction = 'upstream' AND e.dst = c.node)"""


@query(
    "g7_lineage",
    sql_over("graph_edges graph_nodes", _LINEAGE_SELECT,
             "flow AS (SELECT DISTINCT CASE WHEN relationship = 'writes_to' THEN dst ELSE src END AS src, "
             "CASE WHEN relationship = 'writes_to' THEN src ELSE dst END AS dst, relationship "
             "FROM graph_edges WHERE relationship <> 'contains')", _lineage_sql(5)),
)
def g7(spark, sf):
    nodes = stored.nodes(spark, sf)
    roots = nodes.where(F.col("entity_type") == "table").select(F.col("id").alias("root"))
    return traverse.lineage(stored.flow_edges(spark, sf), nodes, roots, "both", orientation={"writes_to": "reverse"})


_CONTRACT = """walk AS (
        SELECT f.src, f.dst FROM {flow} f JOIN kept k ON k.id = f.src
        UNION
        SELECT w.src, f.dst FROM walk w JOIN {flow} f ON f.src = w.dst WHERE w.dst NOT IN (SELECT id FROM kept)),
    joined AS (SELECT DISTINCT src, dst FROM walk WHERE dst IN (SELECT id FROM kept))"""


@query(
    "g7_lineage_without_transformations",
    sql_over("graph_edges graph_nodes", _LINEAGE_SELECT,
             "pairs AS (SELECT DISTINCT src, dst FROM graph_edges WHERE relationship <> 'contains')",
             "kept AS (SELECT id FROM graph_nodes WHERE entity_type <> 'transformation')",
             _CONTRACT.format(flow="pairs"),
             "flow AS (SELECT src, dst, 'flows_to' AS relationship FROM joined)", _lineage_sql(5)),
)
def g7_contracted(spark, sf):
    nodes = stored.nodes(spark, sf)
    roots = nodes.where(F.col("entity_type") == "table").select(F.col("id").alias("root"))
    return traverse.lineage(stored.flow_edges(spark, sf), nodes, roots, "both", include_transformations=False)


@query(
    "g8_bfs",
    sql_over("graph_edges graph_nodes", """
        SELECT src, tgt, min_hops, array_to_string(path, '>') AS path FROM (
            SELECT *, min(min_hops) OVER (PARTITION BY src) AS nearest FROM pc
            WHERE src IN (SELECT id FROM graph_nodes WHERE entity_type = 'column')
              AND tgt IN (SELECT id FROM graph_nodes WHERE entity_type = 'table'))
        WHERE min_hops = nearest""", _FLOW, _CACHE),
)
def g8(spark, sf):
    nodes = stored.nodes(spark, sf)
    found = traverse.bfs(
        traverse.links(stored.flow_edges(spark, sf)),
        nodes.where(F.col("entity_type") == "column").select("id"),
        nodes.where(F.col("entity_type") == "table").select("id"),
    )
    return found.withColumn("path", F.array_join("path", ">"))


@query(
    "g9_shortest_paths",
    sql_over("graph_edges graph_nodes", """
        SELECT root AS landmark, node AS id, min(depth) AS hops FROM (
            SELECT root, node, 0 AS depth FROM w0 UNION ALL SELECT * FROM w) GROUP BY ALL""",
        "hop AS (SELECT DISTINCT src, dst FROM graph_edges)",
        _walks("w", 5, "hop", "SELECT id AS src FROM graph_nodes WHERE entity_type = 'function'", near="dst", far="src")),
)
def g9(spark, sf):
    landmarks = stored.nodes(spark, sf).where(F.col("entity_type") == "function").select("id")
    return traverse.shortest_paths(traverse.links(stored.edges(spark, sf)), landmarks, 5)


@query(
    "g9_shortest_paths_unbounded",
    sql_over("graph_edges graph_nodes", "SELECT landmark, id, min(hops) AS hops FROM walk GROUP BY landmark, id",
             "hop AS MATERIALIZED (SELECT DISTINCT src, dst FROM graph_edges)",
             """walk(landmark, id, hops) USING KEY (landmark, id) AS (
                 SELECT id, id, 0 FROM graph_nodes WHERE entity_type = 'function'
                 UNION
                 SELECT DISTINCT w.landmark, e.src, w.hops + 1 FROM walk w JOIN hop e ON e.dst = w.id
                 LEFT JOIN recurring.walk r ON r.landmark = w.landmark AND r.id = e.src WHERE r.id IS NULL)"""),
)
def g9_unbounded(spark, sf):
    landmarks = stored.nodes(spark, sf).where(F.col("entity_type") == "function").select("id")
    return traverse.shortest_paths(traverse.links(stored.edges(spark, sf)), landmarks)


@query(
    "g10_motif",
    sql_over("graph_edges", """
        SELECT DISTINCT x.src AS a, x.dst AS b, y.dst AS c FROM graph_edges x JOIN graph_edges y ON y.src = x.dst
        WHERE x.relationship = 'transforms' AND y.relationship = 'reads_from'
          AND NOT EXISTS (SELECT 1 FROM graph_edges z WHERE z.src = y.dst AND z.dst = x.dst AND z.relationship = 'writes_to')"""),
)
def g10(spark, sf):
    return traverse.motif(
        stored.edges(spark, sf),
        [("a", "transforms", "b"), ("b", "reads_from", "c")],
        without=[("c", "writes_to", "b")],
    ).select("a", "b", "c")


_CACHE_SELECT = """SELECT src AS src_node_id, tgt AS tgt_node_id, min_hops, array_to_string(path, '>') AS path FROM pc"""


@query("g11_path_cache", sql_over("graph_edges", _CACHE_SELECT, _FLOW, _CACHE))
def g11(spark, sf):
    cache = traverse.path_cache(stored.flow_edges(spark, sf), stored.fixed_stamp())
    return cache.select("src_node_id", "tgt_node_id", "min_hops", F.array_join("path", ">").alias("path"))


# The change: every write edge is turned round into the next hundred, so edges are removed and added.
_NEW_FLOW = """flow AS (
    SELECT DISTINCT src, CASE WHEN relationship = 'writes_to' THEN dst || '0' ELSE dst END AS dst
    FROM graph_edges WHERE relationship <> 'contains')"""


@query("g12_refresh_path_cache", sql_over("graph_edges", _CACHE_SELECT, _NEW_FLOW, _CACHE))
def g12(spark, sf):
    old = stored.flow_edges(spark, sf)
    moved = F.when(F.col("relationship") == "writes_to", F.concat("dst", F.lit("0"))).otherwise(F.col("dst"))
    cache = traverse.refresh_path_cache(stored.path_cache(spark, sf), old, old.withColumn("dst", moved), stored.fixed_stamp())
    return cache.select("src_node_id", "tgt_node_id", "min_hops", F.array_join("path", ">").alias("path"))


@query(
    "g13_find_cycles",
    sql_over("graph_edges", """
        SELECT src AS id, min_hops AS length, array_to_string(path, '>') AS path FROM pc WHERE src = tgt""",
        _FLOW, _pairs("pc", 5, cycles=True)),
)
def g13(spark, sf):
    found = traverse.find_cycles(traverse.links(stored.flow_edges(spark, sf)))
    return found.withColumn("path", F.array_join("path", ">"))


_IMPACT = """
    kinds AS MATERIALIZED (SELECT id, entity_type FROM graph_nodes),
    facts AS MATERIALIZED (
        SELECT p.src AS entity, 'downstream' AS direction, p.tgt AS related, p.min_hops AS hops, p.path
        FROM pc p JOIN kinds k ON k.id = p.src AND k.entity_type = 'column'
        UNION ALL
        SELECT p.tgt, 'upstream', p.src, p.min_hops, p.path FROM pc p JOIN kinds k ON k.id = p.tgt AND k.entity_type = 'column'),
    walked AS MATERIALIZED (
        SELECT entity, direction, related, unnest(path) AS step, generate_subscripts(path, 1) AS place FROM facts),
    steps AS MATERIALIZED (
        SELECT w.entity, w.direction, w.related, string_agg(w.step, ',' ORDER BY w.place) AS transformations
        FROM walked w JOIN kinds k ON k.id = w.step AND k.entity_type = 'transformation' GROUP BY ALL),
    fed AS MATERIALIZED (SELECT DISTINCT dst AS id FROM flow WHERE src <> dst),
    feeding AS MATERIALIZED (SELECT DISTINCT src AS id FROM flow WHERE src <> dst)"""
_IMPACT_SELECT = """
    SELECT f.entity, f.direction, f.related, f.hops, coalesce(s.transformations, '') AS transformations,
           CASE WHEN f.direction = 'upstream' AND i.id IS NULL THEN 'origin'
                WHEN f.direction = 'downstream' AND o.id IS NULL THEN 'destination'
                WHEN n.entity_type = 'transformation' THEN 'transformation' ELSE 'intermediate' END AS role
    FROM facts f LEFT JOIN steps s ON s.entity = f.entity AND s.direction = f.direction AND s.related = f.related
    LEFT JOIN kinds n ON n.id = f.related LEFT JOIN fed i ON i.id = f.related LEFT JOIN feeding o ON o.id = f.related"""


@query("g14_impact_analysis", sql_over("graph_edges graph_nodes", _IMPACT_SELECT, _FLOW, _CACHE, _IMPACT))
def g14(spark, sf):
    nodes = stored.nodes(spark, sf)
    affected = nodes.where(F.col("entity_type") == "column").select("id")
    return traverse.impact_analysis(affected, stored.path_cache(spark, sf), nodes, stored.flow_edges(spark, sf))


@query(
    "g15_impact_score",
    sql_over("graph_edges", """
        SELECT src AS id, round(sum(1.0::DOUBLE / min_hops), 6) AS score, count(*) AS n_dependents FROM pc GROUP BY src""",
        _FLOW, _CACHE),
)
def g15(spark, sf):
    return traverse.impact_score(stored.path_cache(spark, sf)).withColumn("score", F.round("score", 6))


def _pagerank_sql(iterations: int) -> str:
    parts = [
        "ids AS (SELECT id FROM graph_nodes UNION SELECT src FROM graph_edges UNION SELECT dst FROM graph_edges)",
        "weighted AS (SELECT src, dst, sum(coalesce(CAST(weight AS DOUBLE), 1.0)) AS w FROM graph_edges GROUP BY ALL)",
        "shares AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS share FROM weighted)",
        "leaves AS MATERIALIZED (SELECT id FROM ids WHERE id NOT IN (SELECT src FROM weighted))",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM ids)",
    ]
    for i in range(1, iterations + 1):
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT i.id, 0.15 + 0.85 * (SELECT coalesce(sum(rank), 0) FROM r{i - 1} JOIN leaves USING (id)) / (SELECT count(*) FROM ids) "
            f"+ 0.85 * coalesce(f.flow, 0) AS rank FROM ids i LEFT JOIN "
            f"(SELECT s.dst, sum(r.rank * s.share) AS flow FROM r{i - 1} r JOIN shares s ON s.src = r.id GROUP BY s.dst) f ON f.dst = i.id)"
        )
    return ", ".join(parts)


@query(
    "g16_pagerank",
    sql_over("graph_edges graph_nodes",
             "SELECT id, round(rank, 6) AS relative_rank FROM r10", _pagerank_sql(10)),
)
def g16(spark, sf):
    ranks = traverse.pagerank(stored.edges(spark, sf), stored.nodes(spark, sf), 10)
    return ranks.select("id", F.round(F.col("rank") * ranks.agg(F.count("*")).scalar(), 6).alias("relative_rank"))


@query(
    "g17_descendants",
    sql_over("code_files", """
        SELECT DISTINCT root, node FROM (
            SELECT 'src' AS root, 'src/' || split_part(path, '/', 2) AS node FROM code_files
            UNION ALL SELECT 'src', path FROM code_files
            UNION ALL SELECT 'src/' || split_part(path, '/', 2), path FROM code_files)"""),
)
def g17(spark, sf):
    tree = graph.path_tree_edges(inputs.derived(spark, sf, "code_files"))
    roots = tree.where(~F.col("is_file")).select(F.col("child").alias("root"), F.col("child").alias("node"))
    pairs = tree.where(F.col("parent").isNotNull()).select(F.col("parent").alias("src"), F.col("child").alias("dst"))
    return traverse.descendants(pairs, roots)


_TAGS = """tags AS (SELECT id, CASE kind WHEN 'PROMO' THEN 'GDPR' WHEN 'ECONOMY' THEN 'CCPA' ELSE 'SOX' END AS regulation
                    FROM graph_nodes WHERE entity_type = 'column')"""


@query(
    "g19_tagged_flows",
    sql_over("graph_edges graph_nodes", """
        SELECT DISTINCT c.regulation, e.src, e.dst, e.relationship
        FROM (SELECT 'down' AS way, root AS regulation, node FROM d UNION SELECT 'down', regulation, id FROM tags
              UNION SELECT 'up', root, node FROM u UNION SELECT 'up', regulation, id FROM tags) c
        JOIN (SELECT DISTINCT src, dst, relationship FROM graph_edges WHERE relationship <> 'contains') e
          ON (c.way = 'down' AND e.src = c.node) OR (c.way = 'up' AND e.dst = c.node)""",
        _FLOW, _TAGS,
        _walks("d", 4).replace("SELECT src AS root, src AS node FROM (SELECT DISTINCT src FROM flow)", "SELECT regulation AS root, id AS node FROM tags"),
        _walks("u", 4, near="dst", far="src").replace("SELECT src AS root, src AS node FROM (SELECT DISTINCT src FROM flow)", "SELECT regulation AS root, id AS node FROM tags")),
)
def g19(spark, sf):
    kind = F.col("properties")["type"]
    regulation = F.when(kind == "PROMO", "GDPR").when(kind == "ECONOMY", "CCPA").otherwise("SOX")
    tags = stored.nodes(spark, sf).where(F.col("entity_type") == "column").select("id", regulation.alias("regulation"))
    return traverse.tagged_flows(stored.flow_edges(spark, sf), tags, 5)


@query(
    "g20_project_lineage",
    sql_over("graph_edges graph_nodes", "SELECT src, dst FROM joined",
             "pairs AS (SELECT DISTINCT src, dst FROM graph_edges)",
             "kept AS (SELECT id FROM graph_nodes WHERE entity_type IN ('table', 'path'))",
             _CONTRACT.format(flow="pairs")),
)
def g20(spark, sf):
    return traverse.project_lineage(stored.edges(spark, sf), stored.nodes(spark, sf))


@query(
    "u2_lineage_both",
    sql_over("graph_edges graph_nodes", _LINEAGE_SELECT,
             "flow AS (SELECT DISTINCT src, dst, relationship FROM graph_edges WHERE relationship = 'transforms')", _lineage_sql(5)),
)
def u2(spark, sf):
    roots = stored.nodes(spark, sf).where(F.col("entity_type") == "table").select(F.col("id").alias("root"), F.col("id").alias("node"))
    flow = traverse.oriented(stored.edges(spark, sf).where(F.col("relationship") == "transforms"))
    return traverse.lineage_both(
        traverse.lineage_edges(flow, roots, 5, "upstream"), traverse.lineage_edges(flow, roots, 5, "downstream")
    )


@query(
    "o1_order_by_depth",
    sql_over("graph_edges", """
        SELECT root, node, depth, row_number() OVER (ORDER BY depth, root, node) AS position FROM w""",
        "hop AS (SELECT DISTINCT src, dst FROM graph_edges WHERE relationship = 'transforms')",
        _walks("w", 5, "hop", "SELECT DISTINCT src FROM hop")),
)
def o1(spark, sf):
    edges = stored.edges(spark, sf)
    roots = edges.where(F.col("relationship") == "transforms").select(F.col("src").alias("root")).distinct()
    found = traverse.order_by_depth(traverse.downstream(edges, roots, "transforms"), "root", "node")
    return numbered(found)


def numbered(sorted_rows):
    """Positions of sorted rows without a one-task window: count partitions, then add up.

    ``orderBy`` range-partitions, so partition ids follow the order.
    """
    from threadline.operators.versions import number_sorted_rows

    return number_sorted_rows(sorted_rows, "position")
