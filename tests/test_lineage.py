"""Extraction rules on small inputs."""

import time

from pyspark.sql import functions as F

from threadline.functions import sql_text
from threadline.operators import cells, python_lineage, sql_lineage
from threadline.sources import exports


def python_rows(spark, code, readers=None):
    units = F.array(F.struct(F.lit(0).alias("cell_no"), F.lit(code).alias("text")))
    sources = spark.range(1).select(F.lit("nb").alias("path"), F.lit(code).alias("source"), units.alias("units"))
    return python_lineage.python_lineage(sources, readers).collect()


def edges(rows, *skip):
    return {(r.src, r.rel, r.dst) for r in rows if r.kind == "relationship" and r.rule not in ("L6", *skip)}


def test_reads_at_the_base_of_a_chain(spark):
    rows = python_rows(spark, 'a = spark.table("t").filter("x")\nb = spark.read.format("csv").option("h", 1).load("/p").select("y")\nc = a.join(b, "k")')
    assert edges(rows) == {
        ("table:t", "reads_from", "var:a"), ("path:/p", "reads_from", "var:b"), ("var:a", "derives_from", "var:c"), ("var:b", "derives_from", "var:c"),
    }


def test_other_frames_in_a_read_chain_are_kept(spark):
    rows = python_rows(spark, 'b = spark.table("u")\na = read_source("/p", 1).join(b, "k")')
    assert ("var:b", "derives_from", "var:a") in edges(rows) and ("path:/p", "reads_from", "var:a") in edges(rows)


def test_writes(spark):
    code = (
        'a = spark.table("t")\n'
        "def f(d):\n    d.write.insertInto('o1')\n"
        "a.filter('x').write.mode('append').save(path='/q')\n"
        "a.write.option('path', BASE + '/r').save()\n"
        "done = a.write.saveAsTable('o2')\n"
        "other = [unknown.write.saveAsTable('o3')]\n"
    )
    assert edges(python_rows(spark, code)) == {
        ("table:t", "reads_from", "var:a"), ("var:d", "writes_to", "table:o1"), ("var:a", "writes_to", "path:/q"),
        ("var:a", "writes_to", "path:${BASE}/r"), ("var:a", "derives_from", "var:done"), ("var:unknown", "writes_to", "table:o3"),
    }


def test_strings(spark):
    code = 'ENV = "dev"\nROOT = ENV + "/lake"\nx = x + "a"\na = spark.table(ROOT)\nb = spark.table(f"{ENV}.t")\nc = spark.table(cfg["k"])\nd = spark.table(x)'
    assert {s for s, _, _ in edges(python_rows(spark, code))} == {"table:dev/lake", "table:${ENV}.t", "table:${cfg['k']}", "table:${x}a"}


def test_blocked_names_and_actions(spark):
    rows = python_rows(spark, 'lit = spark.table("t")\nn = lit.count()\nm = lit.m()')
    assert "var:lit" not in {r.id for r in rows}
    scores = {r.dst: r.confidence for r in rows if r.rule == "L1e" and r.kind == "relationship"}
    assert scores == {"var:n": 0.5, "var:m": 1.0}


def test_self_loop_and_order(spark):
    rows = python_rows(spark, 'b = a.select("x")\na = spark.table("t")\na = a.filter("y")')
    assert edges(rows) == {("table:t", "reads_from", "var:a"), ("var:a", "derives_from", "var:a")}


def test_registered_reader(spark):
    rows = python_rows(spark, 'a = load_it(1, "db.t")', {"load_it": {"arg_index": 1, "kind": "table"}})
    assert edges(rows) == {("table:db.t", "reads_from", "var:a")}


def test_one_bad_cell_loses_only_itself(spark):
    made = spark.createDataFrame(
        [("n", 0, "python", 'a = spark.table("t")'), ("n", 1, "python", "b = ("), ("n", 2, "python", 'c = a.select("x")')],
        "path string, cell_no int, cell_type string, content string",
    )
    parsed = python_lineage.parse_statements(cells.assemble_python_source(made))
    assert [(r.cell_no, r.error) for r in python_lineage.parse_errors(parsed).collect()] == [(1, "SyntaxError")]
    assert ("var:a", "derives_from", "var:c") in edges(python_lineage.lineage_rows(parsed).collect())


def statements(spark, *texts):
    rows = spark.createDataFrame([("p", i, s) for i, s in enumerate(texts)], "path string, cell_no int, content string")
    return sql_lineage.sql_statements(rows)


def test_nested_sql(spark):
    text = (
        "with a as (select sum(case when x in (1,2) then y end) s, count(distinct z) from (select * from db.x join `db`.`y z` on true) q "
        "where x > (select max(v) from db.w where k = 1) group by f(a, b), c order by 1), b as (select 1 from a, db.k, range(3)) "
        "insert overwrite table tgt select a.s as s1, coalesce(b.u, 'a, from q') u2 from a left join b on a.i = b.i "
        "where a.s is distinct from b.u union all select s, u from db.last -- from zz\n order by s, g(a,b) desc; select 1 from t2"
    )
    found = sorted(sql_lineage.sql_components(statements(spark, text)).collect(), key=lambda r: r.stmt_no)
    first, second = found
    assert first.target == "tgt" and first.tables == ["a", "b", "db.k", "db.last", "db.w", "db.x", "db.y z"]
    assert second.target is None and second.tables == ["t2"]
    cte, other = first.ctes
    assert cte.filters == ["x > (select max(v) from db.w where k = 1)"] and cte.group_by == ["f(a, b)", "c"]
    assert [(a.function, a.argument, a.distinct) for a in cte.aggregations] == [
        ("SUM", "case when x in (1,2) then y end", False), ("COUNT", "z", True), ("MAX", "v", False),
    ]
    assert other.sources.tables == ["a", "db.k"] and other.sources.table_functions == ["range"]
    assert first.final_select["from"] == ["a"] and first.final_select.order_by == ["s", "g(a,b) desc"]
    columns = sql_lineage.column_lineage(sql_lineage.sql_components(statements(spark, text))).collect()
    assert {(r.src, r.dst) for r in columns} == {("column:db.last.s", "column:tgt.s1"), ("column:db.last.u", "column:tgt.u2")}


def test_false_froms_and_merge(spark):
    found = sql_lineage.sql_components(
        statements(
            spark, "CREATE OR REPLACE TEMP VIEW v (a) AS (SELECT trim(both 'x' FROM c) a FROM d.e)",
            "merge into a.b t using (select * from s1 join s2) s on t.i = s.i when matched then delete", "select (1", "   ",
        )
    )
    rows = {r.cell_no: r for r in found.collect()}
    assert set(rows) == {0, 1}
    assert rows[0].target == "v" and rows[0].tables == ["d.e"]
    assert rows[1].merge_target == "a.b" and rows[1].merge_sources == ["s1", "s2"]
    bad = statements(spark, "select (1")
    assert sql_lineage.sql_errors(bad).count() == 1


def components(spark, *texts):
    return sql_lineage.sql_components(statements(spark, *texts))


def edges_of(spark, *texts):
    rows = sql_lineage.sql_lineage(components(spark, *texts)).collect()
    return {(r.src, r.dst) for r in rows if r.kind == "relationship"}, {r.id for r in rows if r.kind == "entity"}


def test_names_and_targets(spark):
    assert edges_of(spark, "INSERT INTO ${cat}.db.t SELECT * FROM ${cat}.db.a JOIN {{ ref('b') }}.c ON 1 = 1")[0] == {
        ("table:${cat}.db.a", "table:${cat}.db.t"), ("table:{{ ref('b') }}.c", "table:${cat}.db.t"),
    }
    assert edges_of(spark, "CREATE TABLE ventas_año AS SELECT país FROM `región`.tabla") == (
        {("table:región.tabla", "table:ventas_año")}, {"table:ventas_año", "table:región.tabla"},
    )
    assert edges_of(spark, "SELECT 'INSERT INTO foo x' AS s FROM a") == (set(), {"table:a"})
    assert edges_of(spark, "INSERT OVERWRITE LOCAL DIRECTORY '/x' USING parquet SELECT a FROM t")[0] == {("table:t", "path:/x")}
    assert edges_of(spark, "SELECT * FROM (a JOIN (b JOIN c ON 1 = 1) ON a.x = b.x)")[1] == {f"table:{n}" for n in "abc"}
    assert edges_of(spark, "UPDATE t SET x = 1 WHERE y IN (SELECT z FROM u)")[1] == {"table:t", "table:u"}
    assert edges_of(spark, "FROM a INSERT OVERWRITE TABLE b SELECT x")[0] == {("table:a", "table:b")}


def test_ctes_are_told_once(spark):
    text = "WITH o AS (WITH i AS (SELECT a FROM db.deep) SELECT a FROM i) INSERT INTO t SELECT * FROM o"
    rows = sql_lineage.sql_lineage(components(spark, text)).collect()
    assert sorted((r.id, r.is_cte) for r in rows if r.kind == "entity" and r.name in "io") == [("table:i", True), ("table:o", True)]
    assert {("table:db.deep", "table:i"), ("table:i", "table:o"), ("table:o", "table:t")} <= {(r.src, r.dst) for r in rows if r.kind == "relationship"}


def test_window_flag(spark):
    texts = ("SELECT over x FROM a", "SELECT sum(x) OVER (ORDER BY y) FROM a", "SELECT first(x) IGNORE NULLS over w FROM a WINDOW w AS (ORDER BY y)", "SELECT f(x) over FROM a")
    flags = {r.cell_no: r.has_window for r in sql_lineage.feature_flags(statements(spark, *texts)).collect()}
    assert flags == {0: False, 1: True, 2: True, 3: False}


def columns(spark, text):
    return {(r.src.removeprefix("column:"), r.dst.removeprefix("column:"), r.expression) for r in sql_lineage.column_lineage(components(spark, text)).collect()}


def test_columns_through_subqueries_and_ctes(spark):
    assert columns(spark, "INSERT INTO t SELECT u.x AS y FROM (SELECT a AS x FROM s) u") == {("s.a", "t.y", "u.x")}
    assert columns(spark, "WITH c AS (SELECT a AS x FROM s) INSERT INTO t SELECT c.x + 1 AS y FROM c") == {("s.a", "t.y", "c.x + 1")}
    assert columns(spark, "INSERT INTO t WITH c(p, q) AS (SELECT a, b FROM s), d AS (SELECT * FROM c) SELECT d.*, q AS r FROM d") == {
        ("s.a", "t.p", "a"), ("s.b", "t.q", "b"), ("s.b", "t.r", "q"),
    }


def test_columns_through_unions_and_stars(spark):
    assert columns(spark, "INSERT INTO t SELECT a, b m FROM s UNION ALL (SELECT c, 'x, y' || d FROM r ORDER BY c)") == {
        ("s.a", "t.a", "a"), ("s.b", "t.m", "b"), ("r.c", "t.a", "c"), ("r.d", "t.m", "'x, y' || d"),
    }
    assert columns(spark, "INSERT INTO t SELECT k.v FROM (SELECT * FROM (SELECT * FROM s) i) k") == {("s.v", "t.v", "k.v")}
    assert columns(spark, "INSERT INTO t SELECT k.v, k.w FROM (SELECT * EXCEPT (w) FROM s) k") == {("s.v", "t.v", "k.v")}
    assert columns(spark, "INSERT INTO t SELECT * FROM ((SELECT a FROM s) UNION (SELECT b FROM r)) u") == {
        ("s.a", "t.a", "a"), ("r.b", "t.a", "b"),
    }


def test_columns_of_several_sources(spark):
    text = "INSERT INTO t SELECT x, a, z, r.n FROM s JOIN (SELECT x FROM q) u ON s.i = u.x"
    assert columns(spark, text) == {("q.x", "t.x", "x"), ("s.a", "t.a", "a"), ("s.z", "t.z", "z")}
    assert columns(spark, "INSERT INTO t SELECT x FROM s JOIN r ON s.i = r.i") == set()
    assert columns(spark, "INSERT INTO t SELECT (SELECT max(v) FROM w) AS m, CAST(p.c AS date) d, extract(year FROM p.e) f, sum(g) OVER (PARTITION BY h ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS k FROM p") == {
        ("w.v", "t.m", "(SELECT max(v) FROM w)"), ("p.c", "t.d", "CAST(p.c AS date)"), ("p.e", "t.f", "extract(year FROM p.e)"),
        ("p.g", "t.k", "sum(g) OVER (PARTITION BY h ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"), ("p.h", "t.k", "sum(g) OVER (PARTITION BY h ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"),
    }


def test_recursive_query_ends(spark):
    text = "WITH RECURSIVE r AS (SELECT a, 1 AS n FROM s UNION ALL SELECT r.a, r.n + 1 FROM r) INSERT INTO t SELECT a, n FROM r"
    assert columns(spark, text) == {("s.a", "t.a", "a")}


def test_long_statement_is_split_in_linear_time():
    seconds = []
    for n in (4_000, 32_000):
        text = "SELECT " + ", ".join(f"f(a{i}, 'x{i}') AS b{i}" for i in range(n)) + " FROM t"
        begun = time.process_time()
        found, balanced = sql_text.split_statements(text)
        seconds.append(time.process_time() - begun)
        assert balanced and len(found) == 1 and len(found[0][1]) == n
    assert seconds[1] < 24 * max(seconds[0], 0.01)


def test_cells(spark):
    source = "# Databricks notebook source\n  x = 1\n# COMMAND ----------   \n%SQL\nselect 1\n# COMMAND ----------\n\n# COMMAND ----------\n  %sql   select 2\n"
    jupyter = '{"cells": [{"cell_type": "markdown", "source": ["# t"]}, {"cell_type": "code", "source": ["%%sql\\n", "select 1"]}, {"cell_type": "raw", "source": "z"}, {"cell_type": "code", "source": []}]}'
    exports = spark.createDataFrame(
        [("s", "SOURCE", bytearray(source, "utf8")), ("j", "JUPYTER", bytearray(jupyter, "utf8")), ("u", "HTML", bytearray(b"\xff y")), ("b", "JUPYTER", bytearray(b"no"))],
        "path string, format string, content binary",
    )
    rows = {(r.path, r.cell_no): (r.cell_type, r.content) for r in cells.extract_cells(exports).collect()}
    assert rows == {
        ("s", 0): ("python", "x = 1"), ("s", 1): ("python", "%SQL\nselect 1"), ("s", 2): ("sql", "select 2"),
        ("j", 0): ("sql", "select 1"), ("j", 1): ("python", "z"), ("j", 2): ("python", ""), ("u", 0): ("python", "� y"),
    }
    assert [r.path for r in cells.unreadable_exports(exports).collect()] == ["b"]


def test_dedent_and_magic_lines(spark):
    code = "    a = 1\n  %md note\n      b = 2\n\n    c = 3"
    assert spark.range(1).select(cells.clean_python(F.lit(code))).first()[0] == "a = 1\n  b = 2\n\nc = 3"


def test_rows_read_more_than_once_are_parsed_once(spark, tmp_path):
    from threadline.plans import queries_lineage

    folder = str(tmp_path)
    spark.range(81).selectExpr("id AS o_orderkey", "id % 2 AS o_custkey").write.parquet(f"{folder}/orders.parquet")
    parses = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert parses(queries_lineage.l6(spark, folder)) == 0
    assert parses(queries_lineage.u1(spark, folder)) == 3  # SQL cells, and the SQL texts to variables and by themselves
    entities, links = queries_lineage.whole_lineage(spark, folder)
    assert parses(entities) == 0 and parses(links) == 1


def test_scopes_take_statements_apart_once(spark):
    cell = spark.range(1).selectExpr("'nb' AS path", "0 AS cell_no", "'CREATE TABLE o AS SELECT a, (SELECT max(b) FROM u) AS m FROM t' AS content")
    scopes = sql_lineage.query_scopes(sql_lineage.sql_components(sql_lineage.sql_statements(cell)))
    assert "MapInArrow" not in scopes._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.output, r.from_column) for r in scopes.collect()} >= {("a", "a"), ("m", "*")}


def test_every_export_is_a_file_in_a_folder_of_its_task(spark, tmp_path):
    texts = [f"# cell {n}\nx = 'é'" for n in range(2500)] + ["", None, "{", "same", "same"]
    rows = spark.createDataFrame([(t,) for t in texts], "content string")
    exports.write_notebook_exports(rows, str(tmp_path / "e"), len(texts))
    found = exports.read_notebook_exports(spark, str(tmp_path / "e")).select("format", F.col("content").cast("string").alias("content"), "path").collect()
    assert sorted(r.content for r in found) == sorted(f"{t or ''}\n" for t in texts)
    assert [r.format for r in found if r.content == "{\n"] == ["JUPYTER"] and sum(r.format == "JUPYTER" for r in found) == 1
    assert len({r.path.rsplit("/", 1)[0] for r in found}) > 1


def test_exports_elsewhere_are_written_by_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "local_path", lambda *_: None)
    exports.write_notebook_exports(spark.createDataFrame([("a",), ("b\nc",), (None,)], "content string"), str(tmp_path / "e"), 3)
    found = exports.read_notebook_exports(spark, str(tmp_path / "e")).select(F.col("content").cast("string").alias("content")).collect()
    assert sorted(r.content for r in found) == ["\n", "a\n", "b\nc\n"]


def test_files_of_a_local_folder_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "FILES_A_FOLDER", 10)
    names = ["a.py", "b c.ipynb", "d%20e.txt", "é/f.txt", "g/h=1/i.txt", "_j=1/k.txt", "_l/m.txt", ".n/o.txt", "_p", ".q.txt", "r._COPYING_", "_metadata_s", "_metadata/v", "_common_metadata", "_w=1", *(f"t/{n}/u" for n in range(60))]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(f" {{{name}".encode())
    (tmp_path / "empty").mkdir()
    (tmp_path / "to").symlink_to(tmp_path / "g")
    (tmp_path / "lost").symlink_to(tmp_path / "nowhere")
    found = exports.read_notebook_exports(spark, str(tmp_path))
    assert not found.inputFiles() or not any(str(tmp_path) in f for f in found.inputFiles())
    got = {(r.path, r.format, bytes(r.content)) for r in found.collect()}
    monkeypatch.setattr(exports, "local_path", lambda *_: None)
    want = {(r.path, r.format, bytes(r.content)) for r in exports.read_notebook_exports(spark, str(tmp_path)).collect()}
    assert got == want and len(got) == found.count() == 69
    one = {r.path for r in exports.read_notebook_exports(spark, f"{tmp_path}/a.p*").collect()}
    assert one == {f"file:{tmp_path}/a.py"}
