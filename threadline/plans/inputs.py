"""Inputs derived from the given tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Code files that one task parses.
FILES_A_TASK = 50_000

_PART_COUNT = "(SELECT count(*) FROM part)"
_SUPPLIER_COUNT = "(SELECT count(*) FROM supplier)"


def _edge_rule(src: str, dst: str, relationship: str, where: str = "true") -> str:
    return f"""
        SELECT {src} AS src, {dst} AS dst, '{relationship}' AS relationship,
               CAST(1 + p_partkey % 3 AS FLOAT) AS weight,
               CASE WHEN p_partkey % 10 <> 9 THEN CAST(CAST(p_partkey % 10 AS DOUBLE) / 10 AS FLOAT) END AS confidence_score,
               CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS DATE) AS created_on,
               'f(' || p_name || ')' AS expression
        FROM part WHERE {where}"""


_GRAPH_EDGES = " UNION ".join(
    [
        _edge_rule("'n:' || p_partkey", f"'n:' || ((3 * p_partkey + 1) % {_PART_COUNT})", "transforms"),
        _edge_rule("'n:' || p_partkey", "'n:' || (p_partkey + 1)", "reads_from",
                   f"p_partkey % 4 = 1 AND p_partkey + 1 < {_PART_COUNT}"),
        _edge_rule("'n:' || p_partkey", "'n:' || (p_partkey - 1)", "writes_to", "p_partkey % 8 = 2"),
        _edge_rule("'n:' || p_partkey", "'n:' || p_partkey", "transforms", "p_partkey % 50 = 0"),
        _edge_rule(f"'s:' || (p_partkey % {_SUPPLIER_COUNT})", "'n:' || p_partkey", "contains"),
        _edge_rule("'n:' || p_partkey", "'missing:' || p_partkey", "derives_from", "p_partkey % 101 = 7"),
    ]
)

_GRAPH_NODES = """
    SELECT 'n:' || p_partkey AS id,
           CASE p_partkey % 4 WHEN 0 THEN 'table' WHEN 1 THEN 'column'
                WHEN 2 THEN 'transformation' ELSE 'function' END AS entity_type,
           'cat.sch.' || replace(p_name, ' ', '_') || '_' || p_partkey AS entity_name,
           p_brand AS brand, p_type AS kind, CAST(p_size AS STRING) AS size,
           e.embedding AS embedding,
           p_partkey % 20 <> 0 AS is_active,
           CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS DATE) AS created_on
    FROM part LEFT JOIN embeddings e ON e.vec_id = p_partkey
    UNION ALL
    SELECT 's:' || s_suppkey, 'table', 'cat.sch.' || lower(replace(s_name, '#', '_')),
           NULL, NULL, NULL, NULL, true, DATE '2024-01-01'
    FROM supplier"""

_PATH_EVENTS = """
    SELECT CAST(user_id AS STRING) AS entity_id,
           '/Workspace/' || event_type || '/' || user_id AS path,
           ts AS seq, event_id, value
    FROM events"""

_INVENTORY = """
    SELECT DISTINCT path FROM path_events WHERE CAST(entity_id AS BIGINT) % 3 <> 0"""

# Code templates, chosen per order by its key; cell 0 of every notebook is the setup cell.
_CELL_TEMPLATES = {
    0: "'df_' || k || ' = spark.table(\"db.t_' || k % 50 || '\")'",
    1: "'%sql' || chr(10) || 'INSERT INTO db.s_' || k % 20 || ' SELECT a FROM db.t_' || k % 50 || ' JOIN db.u_' || k % 7 || ' ON 1=1'",
    2: "'df_' || k || ' = read_source(f\"{ENV}/bkt_' || k % 9 || '\")'",
    3: "'a_' || k || ' = spark.table(\"db.a\")' || chr(10) || 'b_' || k || ' = a_' || k || '.select(\"x\")'",
    4: "'w_' || k || ' = spark.read.table(\"db.w\")' || chr(10) || 'w_' || k || '.write.mode(\"overwrite\").saveAsTable(\"db.o_' || k || '\")'",
    5: "'%sql' || chr(10) || 'WITH c_' || k || ' AS (SELECT max(x) AS mx, count(DISTINCT y) AS n FROM db.v, range(5) WHERE x > 3 GROUP BY z), d_' || k"
       " || ' AS (SELECT mx FROM c_' || k || ') SELECT * FROM c_' || k || ' JOIN d_' || k || ' ON 1=1 ORDER BY mx, n DESC'",
    6: "'p_' || k || ' = spark.table(\"db.p\")' || chr(10) || 'q_' || k || ' = spark.table(\"db.q\")' || chr(10) || 'l_' || k || ' = [p_' || k || ', q_' || k || ']'"
       " || chr(10) || 'u_' || k || ' = reduce(DataFrame.union, l_' || k || ')'",
    7: "CASE WHEN o_custkey % 10 = 0 THEN 'x_' || k || ' = (' ELSE 'x_' || k || ' = 1' END",
    8: "'r_' || k || ' = spark.read.format(\"parquet\").load(ROOT + \"/in_' || k % 5 || '\")'",
    9: "'j_' || k || ' = base.join(broadcast(base), \"id\").filter(\"x > 1\")'",
    10: "'def save_' || k || '():' || chr(10) || '    base.write.format(\"delta\").option(\"path\", ROOT + \"/out_' || k || '\").save()'",
    11: "'s_' || k || ' = spark.sql(\"SELECT a FROM db.t_' || k % 50 || ' JOIN db.u_' || k % 7 || ' ON 1=1\")'",
    12: "'base.filter(\"y > 2\").createOrReplaceTempView(\"view_' || k || '\")'",
    13: "'%sql' || chr(10) || 'MERGE INTO db.m_' || k % 4 || ' AS t USING db.s_' || k % 20 || ' AS s ON t.id = s.id WHEN MATCHED THEN UPDATE SET *'",
    14: "'%%sql' || chr(10) || 'CREATE OR REPLACE TABLE db.c_' || k % 6 || ' AS SELECT s.a AS a1, sum(s.b) AS b1 FROM db.t_' || k % 50"
        " || ' AS s WHERE s.a > 1 AND s.c <> ' || chr(39) || 'FROM x; y' || chr(39) || ' GROUP BY s.a ORDER BY a1 DESC -- FROM nowhere'",
    15: "'%sql' || chr(10) || 'SELECT row_number() OVER (PARTITION BY x ORDER BY y) AS rn, avg(v1.z) AS az FROM db.v v1 LEFT JOIN db.w_' || k % 3 || ' w ON v1.id = w.id"
        " WHERE EXTRACT(year FROM v1.d) = 2024 ORDER BY rn'",
    16: "'%sql' || chr(10) || 'INSERT INTO $' || '{cat}.db.p_' || k % 5 || ' SELECT * FROM $' || '{cat}.db.q'",
    17: "'%sql' || chr(10) || 'CREATE TABLE db.ventas_año_' || k % 3 || ' AS SELECT x.país AS p FROM db.región x'",
    18: "'%sql' || chr(10) || 'SELECT ' || chr(39) || 'INSERT INTO foo x' || chr(39) || ' AS s FROM db.lit_' || k % 3",
    19: "'%sql' || chr(10) || 'INSERT OVERWRITE DIRECTORY ' || chr(39) || '/out/' || k % 4 || chr(39) || ' SELECT d.a FROM db.dir d'",
    20: "'%sql' || chr(10) || 'CREATE OR REPLACE VIEW db.pj_' || k % 4 || ' AS SELECT l.a AS a FROM (db.pa l JOIN db.pb r ON l.id = r.id)'",
    21: "'%sql' || chr(10) || 'UPDATE db.up_' || k % 3 || ' SET x = 1 WHERE y = ' || chr(39) || 'FROM z' || chr(39)",
    22: "'%sql' || chr(10) || 'CREATE TABLE db.sub_' || k % 4 || ' AS SELECT u.x AS y, u.n FROM (SELECT a AS x, count(b) AS n FROM db.s1 GROUP BY a) u'",
    23: "'%sql' || chr(10) || 'WITH c AS (SELECT x.a, x.b + 1 AS e FROM db.s2 x), d AS (SELECT * FROM c) INSERT INTO db.cte_' || k % 4"
        " || ' SELECT d.a AS k1, e FROM d'",
    24: "'%sql' || chr(10) || 'CREATE TABLE db.un_' || k % 4 || ' AS SELECT a, b AS m FROM db.s3 UNION ALL SELECT c, d FROM db.s4'",
    25: "'%sql' || chr(10) || 'WITH o AS (WITH i AS (SELECT a FROM db.deep) SELECT a FROM i) SELECT over, t.b FROM db.ov t JOIN o ON 1=1'",
    26: "'z_' || k || ' = spark.sql(f\"SELECT a FROM {CAT}.db.z_' || k % 5 || '\")'",
}

_SETUP_CELL = (
    "'ENV = dbutils.widgets.get(\"env\")' || chr(10) || 'ROOT = \"/mnt/lake\"' || chr(10) || 'base = spark.table(\"db.base\")'"
)

_NOTEBOOK_CELLS = f"""
    SELECT '/Workspace/nb/' || o_custkey AS path, o_custkey, k, t,
           CASE t WHEN -1 THEN {_SETUP_CELL}
           {' '.join(f'WHEN {t} THEN {text}' for t, text in _CELL_TEMPLATES.items())} END AS raw
    FROM (SELECT o_custkey, CAST(k AS INT) AS k,
                 CASE WHEN k = 0 THEN -1 ELSE CAST(o_orderkey % 27 AS INT) END AS t
          FROM (SELECT o_custkey, o_orderkey,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k
                FROM orders) AS ordered_cells) AS typed_cells"""

# One Python file per customer: an import, a helper class for some, then one to three functions.
_CODE_FILES = """
    SELECT 'src/n' || c_nationkey || '/f_' || c_custkey || '.py' AS path, c_custkey,
           CAST(c_custkey % 3 + 1 AS INT) AS n_functions,
           'import os' || chr(10) || chr(10)
           || 'def f_0(x):' || chr(10) || '    local_' || c_custkey % 7 || ' = x + 1' || chr(10)
           || '    return local_' || c_custkey % 7 || chr(10)
           || CASE WHEN c_custkey % 3 >= 1 THEN chr(10) || 'def f_1(x):' || chr(10) || '    return os.path.join(x)' || chr(10) ELSE '' END
           || CASE WHEN c_custkey % 3 >= 2 THEN chr(10) || 'class C_2:' || chr(10) || '    def f_2(self):' || chr(10) || '        return self' || chr(10) ELSE '' END
           AS text
    FROM customer"""

# Versions of a keyed table over time: every order is one version of its customer's row.
_HISTORY = """
    SELECT CAST(o_custkey AS STRING) AS id, o_orderpriority AS content,
           o_orderdate AS changed_at, o_orderkey AS tie
    FROM orders"""

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "graph_edges": ((), _GRAPH_EDGES),
    "graph_nodes": ((), _GRAPH_NODES),
    "path_events": ((), _PATH_EVENTS),
    "inventory": (("path_events",), _INVENTORY),
    "notebook_cells": ((), _NOTEBOOK_CELLS),
    "code_files": ((), _CODE_FILES),
    "history": ((), _HISTORY),
}


def _with_clause(names: tuple[str, ...]) -> list[str]:
    parts: list[str] = []
    for name in names:
        needs, text = DERIVED[name]
        for part in _with_clause(needs) + [f"{name} AS ({text})"]:
            if part not in parts:
                parts.append(part)
    return parts


def sql_over(names: str, select: str, *ctes: str) -> str:
    """DuckDB text: the named derived inputs, further CTEs, then the select."""
    parts = [part.replace(" AS (", " AS MATERIALIZED (", 1) for part in _with_clause(tuple(names.split()))] + list(ctes)
    return f"WITH RECURSIVE {', '.join(parts)} {select}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows over as many tasks as there are cores.

    Each test table is one row group, hence one task; a real one has many, and the
    work on its texts must not be timed or tested in one.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = f"WITH {', '.join(_with_clause((name,)))} SELECT * FROM {name}"
    for base in TABLES:
        if re.search(rf"(FROM|JOIN) {base}\b", text):
            table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(text)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived nodes in the shape of the stored table."""
    raw = derived(spark, sf_dir, "graph_nodes")
    pairs = F.map_from_arrays(
        F.array(F.lit("brand"), F.lit("size"), F.lit("type")), F.array("brand", "size", "kind")
    )
    stamp = F.col("created_on").cast("timestamp")
    return raw.select(
        "id", "entity_type", "entity_name",
        F.when(F.col("brand").isNotNull(), pairs).alias("properties"),
        "embedding", stamp.alias("created_at"), "is_active",
        F.lit(1).alias("version"), stamp.alias("updated_at"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived edges in the shape of the stored table."""
    raw = derived(spark, sf_dir, "graph_edges")
    stamp = F.col("created_on").cast("timestamp")
    return raw.select(
        "src", "dst", "relationship", "weight",
        F.create_map(F.lit("expression"), F.col("expression")).alias("properties"),
        stamp.alias("created_at"), stamp.alias("updated_at"), "confidence_score",
    )


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived code files, a bounded number a task.

    A file of customers is one row group here, and its texts compress so well that a task chosen
    by bytes would parse and count millions; so the number of tasks follows the number of files.
    """
    files = derived(spark, sf_dir, "code_files")
    tasks = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "customer").count() // FILES_A_TASK))
    return files.repartition(tasks, "path")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived cells as notebooks hold them: magics still in the text."""
    return derived(spark, sf_dir, "notebook_cells").select(
        "path", F.col("k").alias("cell_no"), F.col("raw").alias("content")
    )


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived notebooks in both export formats, as (path, format, content)."""
    from threadline.operators.cells import CELL_MARK, SOURCE_HEADER

    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("cell_no", "content"))), lambda c: c["content"]
    )
    books = cells(spark, sf_dir).groupBy("path").agg(ordered.alias("cells"))
    source = F.concat(F.lit(SOURCE_HEADER + "\n"), F.array_join("cells", f"\n\n{CELL_MARK}\n\n"))

    def code(content):
        return F.struct(
            F.lit("code").alias("cell_type"),
            F.split(F.regexp_replace(content, "\n", "\n\u0001"), "\u0001").alias("source"),
        )

    note = F.struct(F.lit("markdown").alias("cell_type"), F.array(F.lit("# notes")).alias("source"))
    jupyter = F.to_json(F.struct(F.concat(F.array(note), F.transform("cells", code)).alias("cells")))
    formats = F.array(
        F.struct(F.lit("SOURCE").alias("format"), F.encode(source, "UTF-8").alias("content")),
        F.struct(F.lit("JUPYTER").alias("format"), F.encode(jupyter, "UTF-8").alias("content")),
    )
    return books.select("path", F.explode(formats).alias("e")).select("path", "e.format", "e.content")
