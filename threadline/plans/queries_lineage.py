"""Checked queries: cells, Python lineage, SQL lineage, code structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.functions import text as fx
from threadline.operators import cells as cell_jobs
from threadline.operators import graph, python_lineage, quality, sql_lineage, traverse
from threadline.plans import inputs, stored
from threadline.plans.catalog import query
from threadline.plans.inputs import sql_over
from threadline.session import scratch_path, stack, store
from threadline.sources import exports as export_files

# Cells as the splitter must return them.
_CELLS = """cells AS (
    SELECT path, k AS cell_no, o_custkey, t, k, raw,
           CASE WHEN raw LIKE '\\%%sql%' ESCAPE '\\' OR raw LIKE '\\%\\%sql%' ESCAPE '\\' THEN 'sql' ELSE 'python' END AS cell_type,
           CASE WHEN starts_with(raw, '%%sql') THEN substr(raw, 7) WHEN starts_with(raw, '%sql') THEN substr(raw, 6) ELSE raw END AS content
    FROM notebook_cells)"""
_BROKEN = "(t = 7 AND o_custkey % 10 = 0)"


def _over_cells(select: str, *ctes: str) -> str:
    return sql_over("notebook_cells", select, _CELLS, *ctes)


def _typed_cells(spark, sf):
    return cell_jobs.classify_cells(stored.notebook_cells(spark, sf))


def _sources(spark, sf):
    return cell_jobs.assemble_python_source(_typed_cells(spark, sf))


def _python_rows(spark, sf):
    return python_lineage.python_lineage(_sources(spark, sf))


def _stored_python_rows(spark, sf):
    """The rows as a table, for what reads them more than once: notebooks are parsed once."""
    return store(_python_rows(spark, sf), "python-lineage")


def _statements(spark, sf):
    return sql_lineage.sql_statements(_typed_cells(spark, sf).where("cell_type = 'sql'"))


def _components(spark, sf):
    return sql_lineage.sql_components(_statements(spark, sf))


@query("p1_split_source_cells", _over_cells("SELECT path, cell_no, cell_type, content FROM cells"))
def p1(spark, sf):
    source = inputs.exports(spark, sf).where("format = 'SOURCE'")
    return cell_jobs.split_source_cells(source).drop("metadata")


@query("p2_split_jupyter_cells", _over_cells("SELECT path, cell_no, cell_type, content FROM cells"))
def p2(spark, sf):
    jupyter = inputs.exports(spark, sf).where("format = 'JUPYTER'")
    return cell_jobs.split_jupyter_cells(jupyter).drop("metadata")


@query(
    "p3_detect_cell_type",
    _over_cells("SELECT cell_type, count(*) AS n, sum(length(content))::BIGINT AS n_chars FROM cells GROUP BY ALL"),
)
def p3(spark, sf):
    return _typed_cells(spark, sf).groupBy("cell_type").agg(F.count("*").alias("n"), F.sum(F.length("content")).cast("long").alias("n_chars"))


@query(
    "p4_strip_magic_prefix",
    _over_cells("""SELECT path, cell_no, CASE WHEN starts_with(raw, '%sql') THEN substr(raw, 6) ELSE raw END AS body
                   FROM cells WHERE cell_type = 'sql' OR t = 7"""),
)
def p4(spark, sf):
    rows = inputs.derived(spark, sf, "notebook_cells").where("t = 7 OR raw LIKE '\\\\%%sql%' OR raw LIKE '\\\\%\\\\%sql%'")
    upper = F.regexp_replace("raw", "^%sql", "  %SQL")
    return rows.select("path", F.col("k").alias("cell_no"), F.when(F.col("raw").startswith("%sql"), fx.strip_magic_prefix(upper, "%sql")).otherwise(F.col("raw")).alias("body"))


@query(
    "p5_extract_cells",
    _over_cells("SELECT path, cell_no, cell_type, content, jupyter FROM cells, (VALUES ('true'), ('false')) AS f(jupyter)"),
)
def p5(spark, sf):
    found = cell_jobs.extract_cells(inputs.exports(spark, sf))
    return found.select("path", "cell_no", "cell_type", "content", F.col("metadata")["jupyter"].alias("jupyter"))


@query(
    "p6_assemble_python_source",
    _over_cells("""SELECT path, string_agg(content, chr(10) || chr(10) ORDER BY cell_no) AS source
                   FROM cells WHERE cell_type = 'python' GROUP BY path"""),
)
def p6(spark, sf):
    return _sources(spark, sf).select("path", "source")


_SOURCE_TEXT = """source_text AS (
    SELECT path, o_custkey, count(*) AS n_cells, md5(string_agg(content, chr(10) ORDER BY cell_no)) AS digest FROM cells GROUP BY path, o_custkey)"""


@query(
    "s3_read_notebook_exports",
    _over_cells("SELECT CASE WHEN o_custkey % 2 = 0 THEN 'SOURCE' ELSE 'JUPYTER' END AS format, n_cells, digest FROM source_text", _SOURCE_TEXT),
)
def s3(spark, sf):
    folder = scratch_path(spark, "exports")
    even = F.element_at(F.split("path", "/"), -1).cast("long") % 2 == 0
    chosen = (F.col("format") == "SOURCE") == even
    text = inputs.exports(spark, sf).where(chosen).select(F.col("content").cast("string"))
    export_files.write_notebook_exports(text, folder, inputs.table(spark, sf, "orders").agg(F.approx_count_distinct("o_custkey")).first()[0])
    files = export_files.read_notebook_exports(spark, folder)
    cells = cell_jobs.cells_of(F.col("format"), F.col("content"))
    digest = F.md5(F.array_join(F.transform(cells, lambda c: c["content"]), "\n"))
    return files.select("format", F.size(cells).cast("long").alias("n_cells"), digest.alias("digest"))


@query(
    "s4_prefer_jupyter_export",
    _over_cells("SELECT DISTINCT path, CASE WHEN o_custkey % 3 = 0 THEN 'SOURCE' ELSE 'JUPYTER' END AS format FROM cells"),
)
def s4(spark, sf):
    has_jupyter = F.element_at(F.split("path", "/"), -1).cast("long") % 3 != 0
    found = inputs.exports(spark, sf).where((F.col("format") == "SOURCE") | has_jupyter)
    return export_files.prefer_jupyter_export(found).select("path", "format")


def _python_expected(*templates: int) -> str:
    """Relationships each template must yield, as rows (path, cell_no, rule, src, dst, rel)."""
    var = "'var:{}_' || k"
    by_template = {
        -1: [("L1a", "'table:db.base'", "'var:base'", "reads_from")],
        0: [("L1a", "'table:db.t_' || k % 50", var.format("df"), "reads_from")],
        2: [("L1c", "'path:${ENV}/bkt_' || k % 9", var.format("df"), "reads_from")],
        3: [("L1a", "'table:db.a'", var.format("a"), "reads_from"), ("L1e", var.format("a"), var.format("b"), "derives_from")],
        4: [("L1a", "'table:db.w'", var.format("w"), "reads_from"), ("L1f", var.format("w"), "'table:db.o_' || k", "writes_to")],
        6: [
            ("L1a", "'table:db.p'", var.format("p"), "reads_from"), ("L1a", "'table:db.q'", var.format("q"), "reads_from"),
            ("L1d", var.format("p"), var.format("u"), "derives_from"), ("L1d", var.format("q"), var.format("u"), "derives_from"),
        ],
        8: [("L1b", "'path:/mnt/lake/in_' || k % 5", var.format("r"), "reads_from")],
        9: [("L1e", "'var:base'", var.format("j"), "derives_from")],
        10: [("L1g", "'var:base'", "'path:${ROOT}/out_' || k", "writes_to")],
        12: [("L5", "'var:base'", "'table:view_' || k", "writes_to")],
    }
    rows = [
        f"SELECT path, cell_no, '{rule}' AS rule, {src} AS src, {dst} AS dst, '{rel}' AS rel FROM cells WHERE t = {t}"
        for t, found in by_template.items() if not templates or t in templates
        for rule, src, dst, rel in found
    ]
    return f"python_expected AS ({' UNION ALL '.join(rows)})"


@query("l1_python_lineage", _over_cells("SELECT path, rule, src, dst, rel FROM python_expected", _python_expected()))
def l1(spark, sf):
    return _python_rows(spark, sf).where("kind = 'relationship' AND rule <> 'L6'").select("path", "rule", "src", "dst", "rel")


def _python_rule(name: str, rule: str) -> None:
    @query(name, _over_cells(f"SELECT path, src, dst, rel FROM python_expected WHERE rule = '{rule}'", _python_expected()))
    def rule_rows(spark, sf):
        return _python_rows(spark, sf).where((F.col("kind") == "relationship") & (F.col("rule") == rule)).select("path", "src", "dst", "rel")


for _name, _rule in (
    ("l1a_table_reads", "L1a"), ("l1b_path_reads", "L1b"), ("l1d_reduced_union", "L1d"), ("l1e_derivations", "L1e"),
    ("l1f_table_writes", "L1f"), ("l1g_path_writes", "L1g"), ("l5_temp_view_lineage", "L5"),
):
    _python_rule(_name, _rule)


@query(
    "l1c_wrapper_reads",
    _over_cells("SELECT path, 'table:${ENV}/bkt_' || k % 9 AS src, 'var:df_' || k AS dst, 'reads_from' AS rel FROM cells WHERE t = 2"),
)
def l1c(spark, sf):
    """The registry is an argument: here the wrapper reads tables."""
    rows = python_lineage.python_lineage(_sources(spark, sf), {"read_source": {"arg_index": 0, "kind": "table"}})
    return rows.where("kind = 'relationship' AND rule = 'L1c'").select("path", "src", "dst", "rel")


@query(
    "l1h_string_symbols",
    _over_cells("""SELECT path, CASE t WHEN 2 THEN '${ENV}/bkt_' || k % 9 WHEN 8 THEN '/mnt/lake/in_' || k % 5 ELSE '${ROOT}/out_' || k END AS name
                   FROM cells WHERE t IN (2, 8, 10)"""),
)
def l1h(spark, sf):
    return _python_rows(spark, sf).where("kind = 'entity' AND type = 'path'").select("path", "name")


@query(
    "l1i_config_variables",
    _over_cells(f"""SELECT path, 'var:' || v AS id FROM (
        SELECT path, unnest(['ENV', 'ROOT']) AS v FROM cells WHERE t = -1
        UNION ALL SELECT path, 'l_' || k FROM cells WHERE t = 6
        UNION ALL SELECT path, 'x_' || k FROM cells WHERE t = 7 AND NOT {_BROKEN})"""),
)
def l1i(spark, sf):
    return _python_rows(spark, sf).where("kind = 'entity' AND rule = 'L1i'").select("path", "id")


@query("l1j_bare_expressions", _over_cells("SELECT path, src, dst FROM python_expected WHERE rel = 'writes_to'", _python_expected()))
def l1j(spark, sf):
    return _python_rows(spark, sf).where("rel = 'writes_to' AND bare").select("path", "src", "dst")


@query(
    "l4_embedded_sql_lineage",
    _over_cells("""SELECT path, 'L4' AS rule, src, 'var:s_' || k AS dst, 'reads_from' AS rel FROM (
        SELECT *, unnest(['table:db.t_' || k % 50, 'table:db.u_' || k % 7]) AS src FROM cells WHERE t = 11)
        UNION ALL SELECT path, 'L4', 'table:${CAT}.db.z_' || k % 5, 'var:z_' || k, 'reads_from' FROM cells WHERE t = 26"""),
)
def l4(spark, sf):
    return sql_lineage.embedded_sql_lineage(store(_python_rows(spark, sf).where("kind = 'sql'"), "sql-texts"))


@query(
    "l6_operation_edges",
    _over_cells("""SELECT path, 'select' AS operation, 'var:a_' || k AS src, 'var:b_' || k AS dst FROM cells WHERE t = 3
                   UNION ALL SELECT path, 'join,filter', 'var:base', 'var:j_' || k FROM cells WHERE t = 9"""),
)
def l6(spark, sf):
    rows = store(_python_rows(spark, sf).where("rule = 'L6'"), "operations")
    operations = rows.where("kind = 'entity'").select("path", F.col("id").alias("via"), "operation")
    into = rows.where("kind = 'relationship' AND src LIKE 'var:%'").select("src", F.col("dst").alias("via"))
    out = rows.where("kind = 'relationship' AND dst LIKE 'var:%'").select(F.col("src").alias("via"), "dst")
    return operations.join(into, "via").join(out, "via").select("path", "operation", "src", "dst")


# SQL cells

_SQL_EXPECTED = """sql_expected AS (
    SELECT path, cell_no, 'L2a' AS rule, unnest(['table:db.t_' || k % 50, 'table:db.u_' || k % 7]) AS src, 'table:db.s_' || k % 20 AS dst
    FROM cells WHERE t = 1
    UNION ALL SELECT path, cell_no, 'L2a', 'table:db.t_' || k % 50, 'table:db.c_' || k % 6 FROM cells WHERE t = 14
    UNION ALL SELECT path, cell_no, 'L2b', 'table:db.v', 'table:c_' || k FROM cells WHERE t = 5
    UNION ALL SELECT path, cell_no, 'L2b', 'table:c_' || k, 'table:d_' || k FROM cells WHERE t = 5
    UNION ALL SELECT path, cell_no, 'L2c', 'function:range', 'table:c_' || k FROM cells WHERE t = 5
    UNION ALL SELECT path, cell_no, 'L3', 'table:db.s_' || k % 20, 'table:db.m_' || k % 4 FROM cells WHERE t = 13
    UNION ALL SELECT path, cell_no, 'L2a', 'table:${cat}.db.q', 'table:${cat}.db.p_' || k % 5 FROM cells WHERE t = 16
    UNION ALL SELECT path, cell_no, 'L2a', 'table:db.región', 'table:db.ventas_año_' || k % 3 FROM cells WHERE t = 17
    UNION ALL SELECT path, cell_no, 'L2a', 'table:db.dir', 'path:/out/' || k % 4 FROM cells WHERE t = 19
    UNION ALL SELECT path, cell_no, 'L2a', unnest(['table:db.pa', 'table:db.pb']), 'table:db.pj_' || k % 4 FROM cells WHERE t = 20
    UNION ALL SELECT path, cell_no, 'L2a', 'table:db.s1', 'table:db.sub_' || k % 4 FROM cells WHERE t = 22
    UNION ALL SELECT path, cell_no, 'L2a', unnest(['table:c', 'table:d', 'table:db.s2']), 'table:db.cte_' || k % 4 FROM cells WHERE t = 23
    UNION ALL SELECT path, cell_no, 'L2b', v.src, v.dst FROM cells, (VALUES ('table:db.s2', 'table:c'), ('table:c', 'table:d')) AS v(src, dst) WHERE t = 23
    UNION ALL SELECT path, cell_no, 'L2a', unnest(['table:db.s3', 'table:db.s4']), 'table:db.un_' || k % 4 FROM cells WHERE t = 24
    UNION ALL SELECT path, cell_no, 'L2b', v.src, v.dst
        FROM cells, (VALUES ('table:db.deep', 'table:i'), ('table:db.deep', 'table:o'), ('table:i', 'table:o')) AS v(src, dst) WHERE t = 25)"""


def _sql_rows(spark, sf):
    return sql_lineage.sql_lineage(_components(spark, sf))


@query("l2_sql_lineage", _over_cells("SELECT path, cell_no, rule, src, dst, 'reads_from' AS rel FROM sql_expected", _SQL_EXPECTED))
def l2(spark, sf):
    return _sql_rows(spark, sf).where("kind = 'relationship'").select("path", "cell_no", "rule", "src", "dst", "rel")


def _sql_rule(name: str, rule: str) -> None:
    @query(name, _over_cells(f"SELECT path, cell_no, src, dst FROM sql_expected WHERE rule = '{rule}'", _SQL_EXPECTED))
    def rule_rows(spark, sf):
        return _sql_rows(spark, sf).where((F.col("kind") == "relationship") & (F.col("rule") == rule)).select("path", "cell_no", "src", "dst")


_sql_rule("l2a_sql_target_sources", "L2a")
_sql_rule("l2c_sql_from_functions", "L2c")
_sql_rule("l3_sql_merge_lineage", "L3")


@query(
    "l2b_sql_ctes",
    _over_cells("""SELECT path, cell_no, 'c_' || k AS name, 'db.v' AS tables, 'range' AS functions FROM cells WHERE t = 5
                   UNION ALL SELECT path, cell_no, 'd_' || k, 'c_' || k, '' FROM cells WHERE t = 5
                   UNION ALL SELECT path, cell_no, v.*, '' FROM cells, (VALUES ('c', 'db.s2'), ('d', 'c')) AS v(name, tables) WHERE t = 23
                   UNION ALL SELECT path, cell_no, v.*, '' FROM cells, (VALUES ('i', 'db.deep'), ('o', 'db.deep,i')) AS v(name, tables) WHERE t = 25"""),
)
def l2b(spark, sf):
    return _components(spark, sf).select("path", "cell_no", F.inline("ctes")).select(
        "path", "cell_no", "name", F.array_join("sources.tables", ",").alias("tables"), F.array_join("sources.table_functions", ",").alias("functions")
    )


@query(
    "l2d_sql_aggregations",
    _over_cells("""SELECT path, cell_no, 'c_' || k AS cte, f.* FROM cells,
                   (VALUES ('MAX', 'x', false), ('COUNT', 'y', true)) AS f("function", argument, "distinct") WHERE t = 5"""),
)
def l2d(spark, sf):
    ctes = _components(spark, sf).select("path", "cell_no", F.inline("ctes"))
    return ctes.select("path", "cell_no", F.col("name").alias("cte"), F.inline("aggregations"))


@query("l2e_sql_filters", _over_cells("SELECT path, cell_no, 'c_' || k AS cte, 'x > 3' AS filter FROM cells WHERE t = 5"))
def l2e(spark, sf):
    ctes = _components(spark, sf).select("path", "cell_no", F.inline("ctes"))
    return ctes.select("path", "cell_no", F.col("name").alias("cte"), F.explode("filters").alias("filter"))


@query("l2f_sql_group_by", _over_cells("SELECT path, cell_no, 'c_' || k AS cte, 'z' AS item FROM cells WHERE t = 5"))
def l2f(spark, sf):
    ctes = _components(spark, sf).select("path", "cell_no", F.inline("ctes"))
    return ctes.select("path", "cell_no", F.col("name").alias("cte"), F.explode("group_by").alias("item"))


@query(
    "l2g_sql_order_by",
    _over_cells("""SELECT path, cell_no, CASE t WHEN 5 THEN 'mx;n DESC' WHEN 14 THEN 'a1 DESC' ELSE 'rn' END AS order_by FROM cells WHERE t IN (5, 14, 15)"""),
)
def l2g(spark, sf):
    items = F.array_join("final_select.order_by", ";")
    return _components(spark, sf).select("path", "cell_no", items.alias("order_by")).where("order_by <> ''")


@query(
    "l2h_sql_plain_select",
    _over_cells("""SELECT path, cell_no, unnest(CASE t WHEN 5 THEN ['db.v'] WHEN 18 THEN ['db.lit_' || k % 3] WHEN 21 THEN ['db.up_' || k % 3]
                          WHEN 25 THEN ['db.deep', 'db.ov'] ELSE ['db.v', 'db.w_' || k % 3] END) AS name
                   FROM cells WHERE t IN (5, 15, 18, 21, 25)"""),
)
def l2h(spark, sf):
    return _sql_rows(spark, sf).where("rule = 'L2h'").select("path", "cell_no", "name")


@query(
    "l2i_sql_final_from",
    _over_cells("""SELECT path, cell_no, CASE t WHEN 5 THEN 'c_' || k WHEN 15 THEN 'db.v' WHEN 16 THEN '${cat}.db.q' WHEN 17 THEN 'db.región'
                          WHEN 18 THEN 'db.lit_' || k % 3 WHEN 19 THEN 'db.dir' WHEN 20 THEN 'db.pa' WHEN 21 THEN '' WHEN 22 THEN 'db.s1' WHEN 23 THEN 'd'
                          WHEN 24 THEN 'db.s3' WHEN 25 THEN 'db.ov' ELSE 'db.t_' || k % 50 END AS tables
                   FROM cells WHERE t IN (1, 5, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25)"""),
)
def l2i(spark, sf):
    return _components(spark, sf).where("merge_target IS NULL").select("path", "cell_no", F.array_join("final_select.from", ",").alias("tables"))


@query(
    "l2j_sql_feature_flags",
    _over_cells("""SELECT path, cell_no, t IN (1, 5, 15, 20, 25) AS has_join, t = 13 AS has_merge, t = 15 AS has_window
                   FROM cells WHERE t IN (1, 5) OR t BETWEEN 13 AND 25"""),
)
def l2j(spark, sf):
    return sql_lineage.feature_flags(_statements(spark, sf)).drop("stmt_no")


COLUMNS_SQL = """SELECT path, cell_no, 'column:db.t_' || k % 50 || '.' || c AS src, 'column:db.c_' || k % 6 || '.' || a AS dst, expression
                   FROM cells, (VALUES ('a', 'a1', 's.a'), ('b', 'b1', 'sum(s.b)')) AS v(c, a, expression) WHERE t = 14
                   UNION ALL SELECT path, cell_no, 'column:db.' || src, 'column:db.' || dst || '_' || k % n || '.' || a, expression
                   FROM cells JOIN (VALUES
                       (17, 3, 'región.país', 'ventas_año', 'p', 'x.país'), (20, 4, 'pa.a', 'pj', 'a', 'l.a'),
                       (22, 4, 's1.a', 'sub', 'y', 'u.x'), (22, 4, 's1.b', 'sub', 'n', 'u.n'), (23, 4, 's2.a', 'cte', 'k1', 'd.a'), (23, 4, 's2.b', 'cte', 'e', 'e'),
                       (24, 4, 's3.a', 'un', 'a', 'a'), (24, 4, 's3.b', 'un', 'm', 'b'), (24, 4, 's4.c', 'un', 'a', 'c'), (24, 4, 's4.d', 'un', 'm', 'd')
                   ) AS v(kind, n, src, dst, a, expression) ON kind = t"""


@query("l7_column_lineage", _over_cells(COLUMNS_SQL))
def l7(spark, sf):
    return sql_lineage.column_lineage(_components(spark, sf)).select("path", "cell_no", "src", "dst", "expression")


@query(
    "a3_collect_sorted_tables",
    _over_cells("""SELECT path, cell_no, CASE t WHEN 1 THEN 'db.t_' || k % 50 || ',db.u_' || k % 7 WHEN 5 THEN 'c_' || k || ',d_' || k || ',db.v'
                          WHEN 14 THEN 'db.t_' || k % 50 WHEN 16 THEN '${cat}.db.q' WHEN 17 THEN 'db.región' WHEN 18 THEN 'db.lit_' || k % 3
                          WHEN 19 THEN 'db.dir' WHEN 20 THEN 'db.pa,db.pb' WHEN 21 THEN 'db.up_' || k % 3 WHEN 22 THEN 'db.s1' WHEN 23 THEN 'c,d,db.s2'
                          WHEN 24 THEN 'db.s3,db.s4' WHEN 25 THEN 'db.deep,db.ov,i,o' ELSE 'db.v,db.w_' || k % 3 END AS tables
                   FROM cells WHERE t IN (1, 5) OR t BETWEEN 14 AND 25"""),
)
def a3(spark, sf):
    found = _components(spark, sf).select("path", "cell_no", F.explode("tables").alias("name"))
    return graph.collect_sorted_tables(found, ["path", "cell_no"]).withColumn("tables", F.array_join("tables", ","))


_ENTITY_ROWS = """entity_rows AS (
    SELECT path, cell_no, id, type, is_cte, place FROM (
        SELECT path, cell_no, 'table:c_' || k AS id, 'table' AS type, true AS is_cte, 0 AS place FROM cells WHERE t = 5
        UNION ALL SELECT path, cell_no, 'table:db.v', 'table', false, 1 FROM cells WHERE t IN (5, 15)
        UNION ALL SELECT path, cell_no, 'function:range', 'function', false, 2 FROM cells WHERE t = 5
        UNION ALL SELECT path, cell_no, 'table:d_' || k, 'table', true, 3 FROM cells WHERE t = 5
        UNION ALL SELECT path, cell_no, 'table:db.w_' || k % 3, 'table', false, 4 FROM cells WHERE t = 15
        UNION ALL SELECT path, cell_no, unnest(['table:db.t_' || k % 50, 'table:db.u_' || k % 7, 'table:db.s_' || k % 20]), 'table', false, 5 FROM cells WHERE t = 1
        UNION ALL SELECT path, cell_no, unnest(['table:db.s_' || k % 20, 'table:db.m_' || k % 4]), 'table', false, 6 FROM cells WHERE t = 13
        UNION ALL SELECT path, cell_no, unnest(['table:db.c_' || k % 6, 'table:db.t_' || k % 50]), 'table', false, 7 FROM cells WHERE t = 14
        UNION ALL SELECT path, cell_no, unnest(['table:${cat}.db.q', 'table:${cat}.db.p_' || k % 5]), 'table', false, 8 FROM cells WHERE t = 16
        UNION ALL SELECT path, cell_no, unnest(['table:db.región', 'table:db.ventas_año_' || k % 3]), 'table', false, 9 FROM cells WHERE t = 17
        UNION ALL SELECT path, cell_no, 'table:db.lit_' || k % 3, 'table', false, 10 FROM cells WHERE t = 18
        UNION ALL SELECT path, cell_no, 'path:/out/' || k % 4, 'path', false, 11 FROM cells WHERE t = 19
        UNION ALL SELECT path, cell_no, 'table:db.dir', 'table', false, 12 FROM cells WHERE t = 19
        UNION ALL SELECT path, cell_no, unnest(['table:db.pa', 'table:db.pb', 'table:db.pj_' || k % 4]), 'table', false, 13 FROM cells WHERE t = 20
        UNION ALL SELECT path, cell_no, 'table:db.up_' || k % 3, 'table', false, 14 FROM cells WHERE t = 21
        UNION ALL SELECT path, cell_no, unnest(['table:db.s1', 'table:db.sub_' || k % 4]), 'table', false, 15 FROM cells WHERE t = 22
        UNION ALL SELECT path, cell_no, unnest(['table:c', 'table:d']), 'table', true, 16 FROM cells WHERE t = 23
        UNION ALL SELECT path, cell_no, unnest(['table:db.s2', 'table:db.cte_' || k % 4]), 'table', false, 17 FROM cells WHERE t = 23
        UNION ALL SELECT path, cell_no, unnest(['table:db.s3', 'table:db.s4', 'table:db.un_' || k % 4]), 'table', false, 18 FROM cells WHERE t = 24
        UNION ALL SELECT path, cell_no, unnest(['table:i', 'table:o']), 'table', true, 19 FROM cells WHERE t = 25
        UNION ALL SELECT path, cell_no, unnest(['table:db.deep', 'table:db.ov']), 'table', false, 20 FROM cells WHERE t = 25))"""


@query(
    "a1_dedupe_entities",
    _over_cells("""SELECT id, type, arg_min(path, (path, cell_no)) AS path, arg_min(cell_no, (path, cell_no)) AS cell_no,
                          arg_min(is_cte, (path, cell_no, place)) AS is_cte FROM entity_rows GROUP BY id, type""", _ENTITY_ROWS),
)
def a1(spark, sf):
    found = graph.dedupe_entities(sql_lineage.entities(_sql_rows(spark, sf)))
    is_cte = F.coalesce(F.try_element_at("properties", F.lit("is_cte")) == "true", F.lit(False))
    return found.select("id", "type", "path", "cell_no", is_cte.alias("is_cte"))


_ALL_RELATIONSHIPS = """all_relationships AS (
    SELECT src, dst, rel AS type FROM python_expected
    UNION SELECT src, dst, 'reads_from' FROM sql_expected
    UNION SELECT 'table:db.t_' || k % 50, 'var:s_' || k, 'reads_from' FROM cells WHERE t = 11
    UNION SELECT 'table:db.u_' || k % 7, 'var:s_' || k, 'reads_from' FROM cells WHERE t = 11
    UNION SELECT 'table:${CAT}.db.z_' || k % 5, 'var:z_' || k, 'reads_from' FROM cells WHERE t = 26)"""


@query("a2_dedupe_relationships", _over_cells("SELECT DISTINCT src, dst, rel AS type FROM python_expected", _python_expected()))
def a2(spark, sf):
    found = python_lineage.relationships(_python_rows(spark, sf).where("rule <> 'L6'"))
    return graph.dedupe_relationships(found, ["path"]).select("src", "dst", "type")


@query("u1_union_lineage", _over_cells("SELECT src, dst, type FROM all_relationships", _python_expected(), _SQL_EXPECTED, _ALL_RELATIONSHIPS))
def u1(spark, sf):
    python = _stored_python_rows(spark, sf)
    embedded = sql_lineage.embedded_sql_lineage(python).withColumnRenamed("rel", "type")
    merged = graph.union_lineage(
        python_lineage.relationships(python.where("rule <> 'L6'")).select("src", "dst", "type"),
        sql_lineage.relationships(_sql_rows(spark, sf)).select("src", "dst", "type"),
        embedded.select("src", "dst", "type"),
    )
    return graph.dedupe_relationships(merged)


# Every entity and relationship of a notebook, from both extractors and the SQL inside Python; operations apart.
_LINEAGE = f"""lineage_links AS (
    SELECT path, src, dst, rel AS type FROM python_expected
    UNION SELECT path, src, dst, 'reads_from' FROM sql_expected
    UNION SELECT path, unnest(['table:db.t_' || k % 50, 'table:db.u_' || k % 7]), 'var:s_' || k, 'reads_from' FROM cells WHERE t = 11
    UNION SELECT path, 'table:${{CAT}}.db.z_' || k % 5, 'var:z_' || k, 'reads_from' FROM cells WHERE t = 26),
    lineage_entities AS (
    SELECT path, id, CASE split_part(id, ':', 1) WHEN 'var' THEN 'variable' ELSE split_part(id, ':', 1) END AS type, substr(id, strpos(id, ':') + 1) AS name FROM (
        SELECT path, src AS id FROM lineage_links UNION SELECT path, dst FROM lineage_links UNION SELECT path, id FROM entity_rows
        UNION SELECT path, unnest(['var:ENV', 'var:ROOT']) FROM cells WHERE t = -1
        UNION SELECT path, 'var:l_' || k FROM cells WHERE t = 6
        UNION SELECT path, 'var:x_' || k FROM cells WHERE t = 7 AND NOT {_BROKEN}))"""
LINEAGE_CTES = (_python_expected(), _SQL_EXPECTED, _ENTITY_ROWS, _LINEAGE)


def whole_lineage(spark, sf):
    """(entities, relationships) that LINEAGE_CTES says, as lineage_entities and lineage_links."""
    python, sql = _stored_python_rows(spark, sf), store(_sql_rows(spark, sf), "sql-lineage")
    plain = python.where("rule <> 'L6'")
    inner = store(sql_lineage.stated_in_texts(python), "sql-lineage")
    columns = ["path", "id", "type", "name"]
    entities = stack(*[part.select(*columns) for part in (python_lineage.entities(plain), sql_lineage.entities(sql), sql_lineage.entities(inner))])
    links = stack(
        python_lineage.relationships(plain).select("path", "src", "dst", "type"),
        sql_lineage.relationships(sql).select("path", "src", "dst", "type"),
        sql_lineage.embedded_sql_lineage(python, inner).select("path", "src", "dst", F.col("rel").alias("type")),
    )
    return entities, links


@query(
    "q8_parse_accuracy",
    _over_cells(f"""SELECT cell_type, count(*) AS n_cells, CAST(count(*) FILTER (NOT {_BROKEN}) AS BIGINT) AS n_parsed,
                    round(count(*) FILTER (NOT {_BROKEN}) / count(*), 6) AS accuracy FROM cells GROUP BY ALL"""),
)
def q8(spark, sf):
    cells = _typed_cells(spark, sf)
    python = python_lineage.parse_errors(python_lineage.parse_statements(cell_jobs.assemble_python_source(cells)))
    errors = python.unionByName(sql_lineage.sql_errors(_statements(spark, sf)))
    return quality.parse_accuracy(cells, errors).withColumn("accuracy", F.round("accuracy", 6))


@query("q9_unparsable_cells", _over_cells(f"SELECT path, cell_no, content, 'SyntaxError' AS error FROM cells WHERE {_BROKEN}"))
def q9(spark, sf):
    cells = _typed_cells(spark, sf)
    errors = python_lineage.parse_errors(python_lineage.parse_statements(cell_jobs.assemble_python_source(cells)))
    return quality.unparsable_cells(cells, errors).select("path", "cell_no", "content", "error")


# code files


@query(
    "l8_code_chunks",
    sql_over("code_files", """
        SELECT path AS file, CAST(chunk_no AS INT) AS chunk_no, kind, name FROM (
            SELECT path, 0 AS chunk_no, 'imports' AS kind, NULL AS name FROM code_files
            UNION ALL SELECT path, 1, 'function', 'f_0' FROM code_files
            UNION ALL SELECT path, 2, 'function', 'f_1' FROM code_files WHERE n_functions >= 2
            UNION ALL SELECT path, 3, 'class', 'C_2' FROM code_files WHERE n_functions >= 3)"""),
)
def l8(spark, sf):
    return python_lineage.code_chunks(inputs.code_files(spark, sf)).select("file", "chunk_no", "kind", "name")


@query(
    "l9_ast_nodes",
    sql_over("code_files", """
        SELECT path AS file, v.* FROM code_files, (VALUES ('Module', NULL, 1), ('Import', NULL, 1), ('alias', 'os', 1), ('FunctionDef', 'f_0', 1)) AS v(type, text, n)
        UNION ALL SELECT path, 'FunctionDef', 'f_1', 1 FROM code_files WHERE n_functions >= 2
        UNION ALL SELECT path, 'FunctionDef', 'f_2', 1 FROM code_files WHERE n_functions >= 3
        UNION ALL SELECT path, 'ClassDef', 'C_2', 1 FROM code_files WHERE n_functions >= 3"""),
)
def l9(spark, sf):
    tree = python_lineage.ast_nodes(inputs.code_files(spark, sf))
    kinds = ("Module", "Import", "alias", "FunctionDef", "ClassDef")
    return tree.where(F.col("type").isin(*kinds)).groupBy("file", "type", F.coalesce("text", F.lit(None)).alias("text")).agg(F.count("*").cast("int").alias("n"))


@query("a4_functions_per_file", sql_over("code_files", "SELECT path AS file, CAST(n_functions AS BIGINT) AS n_functions FROM code_files"))
def a4(spark, sf):
    return graph.functions_per_file(python_lineage.ast_nodes(inputs.code_files(spark, sf)))


@query(
    "g18_files_using_identifier",
    sql_over("code_files", """SELECT 'local_' || c_custkey % 7 AS name, path AS file FROM code_files
                              UNION ALL SELECT 'os', path FROM code_files WHERE n_functions >= 2"""),
)
def g18(spark, sf):
    files = inputs.code_files(spark, sf)
    names = files.select(F.concat(F.lit("local_"), (F.col("c_custkey") % 7).cast("string")).alias("name")).distinct()
    wanted = names.unionByName(spark.range(1).select(F.lit("os").alias("name")))
    return traverse.files_using_identifier(python_lineage.ast_nodes(files), wanted)
