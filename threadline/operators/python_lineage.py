"""Lineage of Python notebooks.

Tasks parse each notebook once into an array of statements (``python_syntax``);
every rule is then a Spark expression over that array. Which variables hold
DataFrames depends on the order of statements, so it is one fold per notebook; the
rest looks only at one statement and what was marked before it. Nothing shuffles
until the final deduplication.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.operators import graph, python_syntax

# Names never listed as variables, and the wrapper readers known without registration.
BLOCKED_NAMES = ("col", "when", "sum", "lit", "broadcast", "reduce", "DataFrame", "current_timestamp")
DEFAULT_READERS = {"read_source": {"arg_index": 0, "kind": "path"}}

# Methods that return a value, not a DataFrame; a derivation ending in one is doubtful.
ACTIONS = ("count", "collect", "first", "head", "take", "show", "toPandas", "isEmpty", "tail")
OPERATIONS = ("join", "crossJoin", "union", "unionAll", "unionByName", "filter", "where", "groupBy", "agg", "select", "withColumn")

# Rows a task of code files holds before it hands them on.
_FLUSH_ROWS = 20_000

# Columns of a lineage row, each with its type.
ROW_FIELDS = {
    "rule": "string", "kind": "string", "id": "string", "type": "string", "name": "string", "src": "string",
    "dst": "string", "rel": "string", "confidence": "double", "bare": "boolean", "sql": "string", "operation": "string",
}


def parse_statements(sources: DataFrame) -> DataFrame:
    """(path, source, units) to (path, statements, errors)."""

    def run(batches):
        fields = [
            ("path", pa.string()),
            ("statements", pa.list_(python_syntax.STATEMENT)),
            ("errors", pa.list_(pa.struct([("cell_no", pa.int32()), ("error", pa.string())]))),
        ]
        schema = pa.schema(fields)
        for batch in batches:
            rows = []
            for path, source, units in zip(*(batch.column(n).to_pylist() for n in ("path", "source", "units"))):
                statements, errors = python_syntax.notebook_rows(source or "", units or [])
                rows.append({"path": path, "statements": statements, "errors": errors})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return sources.select("path", "source", "units").mapInArrow(
        run, f"path string, statements {python_syntax.STATEMENT_DDL}, errors array<struct<cell_no:int,error:string>>"
    )


def _words(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _source_sql(readers: Mapping[str, Mapping]) -> str:
    """What an assignment ``s`` reads, as struct(rule, kind, name), or NULL.

    A read may stand anywhere at the base of a chain: ``spark.table(n)``, or
    ``table(n)`` or ``load(p)`` after ``read``.
    """
    for name in readers:
        if not name.isidentifier():
            raise ValueError(f"not a function name: {name}")
    on_spark = "s.base = 'spark' AND s.base_args IS NULL"
    read = f"""get(transform(filter(s.steps, (x, i) -> x.called AND nullif(get(x.args, 0), '') IS NOT NULL AND (
            (x.name IN ('table', 'load') AND array_position(transform(s.steps, y -> y.name), 'read') BETWEEN 1 AND i)
            OR (x.name = 'table' AND i = 0 AND {on_spark}))),
        x -> struct(if(x.name = 'table', 'L1a', 'L1b') AS rule, if(x.name = 'table', 'table', 'path') AS kind, x.args[0] AS name)), 0)"""
    options = [read]
    for name, spec in readers.items():
        kind = "table" if spec.get("kind", "path") == "table" else "path"
        argument = f"get(s.base_args, {int(spec.get('arg_index', 0))})"
        options.append(f"if(s.base = '{name}' AND nullif({argument}, '') IS NOT NULL, struct('L1c' AS rule, '{kind}' AS kind, {argument} AS name), NULL)")
    options.append(
        f"""get(transform(filter(s.steps, (x, i) -> x.called AND x.name = 'sql' AND i = 0 AND {on_spark} AND nullif(get(x.args, 0), '') IS NOT NULL),
        x -> struct('L4' AS rule, 'sql' AS kind, x.args[0] AS name)), 0)"""
    )
    return f"if(s.target IS NOT NULL, coalesce({', '.join(options)}), NULL)"


# What a call ``s`` writes, as struct(rule, kind, name), or NULL.
_LAST = "try_element_at(s.steps, -1)"
_ARGUMENT = f"nullif(get({_LAST}.args, 0), '')"
_WRITES = "exists(s.steps, x -> x.name = 'write')"
_OPTION = """get(filter(s.steps, x -> x.called AND x.name = 'option' AND get(x.args, 0) = 'path' AND nullif(get(x.args, 1), '') IS NOT NULL), 0)"""
_SAVE_PATH = f"coalesce({_ARGUMENT}, nullif({_LAST}.path_kw, ''), get({_OPTION}.args, 1))"
_SINK_SQL = f"""CASE WHEN s.target IS NOT NULL THEN NULL
    WHEN {_WRITES} AND {_LAST}.name IN ('saveAsTable', 'insertInto') AND {_ARGUMENT} IS NOT NULL
        THEN struct('L1f' AS rule, 'table' AS kind, {_ARGUMENT} AS name)
    WHEN {_WRITES} AND {_LAST}.name = 'save' AND {_SAVE_PATH} IS NOT NULL THEN struct('L1g' AS rule, 'path' AS kind, {_SAVE_PATH} AS name)
    WHEN {_LAST}.name = 'createOrReplaceTempView' AND {_ARGUMENT} IS NOT NULL THEN struct('L5' AS rule, 'table' AS kind, {_ARGUMENT} AS name)
    WHEN {_LAST}.name = 'sql' AND size(s.steps) = 1 AND s.base = 'spark' AND {_ARGUMENT} IS NOT NULL
        THEN struct('L4' AS rule, 'sql' AS kind, {_ARGUMENT} AS name) END"""

# The variable a write starts from, if only attributes stand between it and the write.
_ROOT_SQL = """if(s.base_args IS NULL AND NOT exists(
        slice(s.steps, 1, greatest(if(array_position(transform(s.steps, x -> x.name), 'write') > 0,
                                      CAST(array_position(transform(s.steps, x -> x.name), 'write') AS INT), size(s.steps)) - 1, 0)),
        x -> x.called), s.base, NULL)"""


def _known(names: str, before: str = "s.ord") -> str:
    """Those names that held a DataFrame before a statement, ``marks`` saying since when."""
    return f"filter({names}, n -> exists(marks, m -> m.name = n AND m.at < {before}))"


# Whether assignment ``o`` is lineage, so that calls inside it are not looked at again.
_CONSUMES = f"(o.source IS NOT NULL OR o.union_of IS NOT NULL OR (o.shape IN ('call', 'attribute') AND size({_known('o.names', 'o.ord')}) > 0))"

# Whether call ``s`` is looked at: it stands alone, or in an assignment that is not lineage.
_LIVE = f"""(s.target IS NULL AND (s.parent IS NULL OR NOT exists(array(get(statements, s.parent)), o -> {_CONSUMES})))"""

# The name that statement ``s`` makes a DataFrame, or NULL.
_MARKED = f"""CASE
    WHEN s.target IS NOT NULL AND (s.source IS NOT NULL OR coalesce(size(s.union_of) > 0, false)
        OR (s.union_of IS NULL AND s.shape IN ('call', 'attribute') AND size({_known('s.names')}) > 0)) THEN s.target
    WHEN s.sink IS NOT NULL AND s.sink.kind <> 'sql' AND s.root IS NOT NULL AND {_LIVE} THEN s.root END"""

# array(name, at): where each variable first holds a DataFrame, a fold over the statements in order.
_MARKS_SQL = f"""aggregate(statements, CAST(array() AS array<struct<name: string, at: int>>), (marks, s) ->
    concat(marks, transform(filter(array({_MARKED}), v -> v IS NOT NULL AND NOT exists(marks, m -> m.name = v)),
                            v -> struct(v AS name, s.ord AS at))))"""


def _row(**values: str) -> str:
    fields = [f"CAST({values.get(n, 'NULL')} AS {t}) AS {n}" for n, t in ROW_FIELDS.items()]
    return f"struct({', '.join(fields)})"


def _entity(rule: str, kind: str, name: str) -> str:
    prefix = f"if({kind} = 'variable', 'var', {kind})"
    return _row(rule=rule, kind="'entity'", id=f"concat({prefix}, ':', {name})", type=kind, name=name)


def _edge(rule: str, src: str, dst: str, rel: str, confidence: str = "1.0", bare: str = "false") -> str:
    return _row(rule=rule, kind="'relationship'", src=src, dst=dst, rel=f"'{rel}'", confidence=confidence, bare=bare)


def _variables(rule: str, names: str) -> str:
    return f"transform(filter({names}, n -> n NOT IN ({_words(BLOCKED_NAMES)})), n -> {_entity(rule, chr(39) + 'variable' + chr(39), 'n')})"


def _statement_rows_sql() -> str:
    """All lineage rows of a statement whose fields are columns, as one array."""
    none = f"CAST(array() AS array<struct<{', '.join(f'{n}: {t}' for n, t in ROW_FIELDS.items())}>>)"
    target = "concat('var:', target)"
    operation = "array_join(used, ',')"
    operation_id = "concat('op:', path, '#', ord)"
    reads = f"""concat(
        CASE WHEN source.kind IN ('table', 'path')
             THEN concat(array({_entity('source.rule', 'source.kind', 'source.name')}), {_variables('source.rule', 'array(target)')},
                         array({_edge('source.rule', "concat(source.kind, ':', source.name)", target, 'reads_from')}))
             ELSE concat(array({_row(rule="'L4'", kind="'sql'", dst=target, sql='source.name')}), {_variables("'L4'", 'array(target)')}) END,
        transform(others, n -> {_edge("'L1e'", "concat('var:', n)", target, 'derives_from')}))"""
    union = f"""if(size(union_of) > 0, concat({_variables("'L1d'", 'concat(array(target), parents)')},
        transform(parents, n -> {_edge("'L1d'", "concat('var:', n)", target, 'derives_from')})), {none})"""
    derived = f"""concat(
        {_variables("'L1e'", 'concat(array(target), inputs)')},
        transform(inputs, n -> {_edge("'L1e'", "concat('var:', n)", target, 'derives_from', f"if(coalesce(last IN ({_words(ACTIONS)}), false), 0.5, 1.0)")}),
        if(size(used) > 0, concat(
            array({_row(rule="'L6'", kind="'entity'", id=operation_id, type="'transformation'", name=operation, operation=operation)}),
            transform(inputs, n -> {_edge("'L6'", "concat('var:', n)", operation_id, 'transforms_into')}),
            array({_edge("'L6'", operation_id, target, 'transforms_into')})), {none}))"""
    writers = "if(root IS NOT NULL, array(root), inputs)"
    written = f"""if(sink.kind = 'sql', array({_row(rule="'L4'", kind="'sql'", sql='sink.name')}), concat(
        array({_entity('sink.rule', 'sink.kind', 'sink.name')}), {_variables('sink.rule', writers)},
        transform({writers}, n -> {_edge('sink.rule', "concat('var:', n)", "concat(sink.kind, ':', sink.name)", 'writes_to', '1.0', 'parent IS NULL')})))"""
    return f"""CASE WHEN target IS NULL THEN if(sink IS NOT NULL AND live, {written}, {none})
        WHEN source IS NOT NULL THEN {reads}
        WHEN union_of IS NOT NULL THEN {union}
        WHEN shape IN ('call', 'attribute') AND size(inputs) > 0 THEN {derived}
        ELSE {_variables("'L1i'", 'array(target)')} END"""


def lineage_rows(parsed: DataFrame, readers: Mapping[str, Mapping] | None = None) -> DataFrame:
    """(path, ord, place, rule, kind, id, type, name, src, dst, rel, confidence, bare, sql, operation).

    ``kind`` is entity, relationship, or sql for SQL text found in the code. Generators
    are the outer kind throughout: for an inner one the optimizer adds a filter on the
    size of its array and so computes the array again.
    """
    kept = "s.ord, s.parent, s.target, s.shape, s.steps, s.union_of"
    ruled = parsed.selectExpr(
        "path",
        f"""transform(statements, s -> struct({kept}, s.names, s.later_names,
            {_source_sql(readers or DEFAULT_READERS)} AS source, {_SINK_SQL} AS sink, {_ROOT_SQL} AS root)) AS statements""",
    )
    marked = ruled.selectExpr("path", "statements", f"{_MARKS_SQL} AS marks")
    judged = marked.selectExpr(
        "path",
        f"""inline_outer(transform(statements, s -> struct({kept}, s.source, s.sink, s.root, {_known('s.names')} AS inputs,
            filter({_known('s.later_names')}, n -> n <> s.target) AS others, {_known('s.union_of')} AS parents, {_LIVE} AS live,
            {_LAST}.name AS last,
            transform(filter(s.steps, x -> x.called AND x.name IN ({_words(OPERATIONS)})), x -> x.name) AS used)))""",
    )
    rows = judged.selectExpr("path", "ord", f"posexplode_outer({_statement_rows_sql()}) AS (place, r)").where("place IS NOT NULL")
    return rows.select("path", "ord", "place", "r.*")


def parse_errors(parsed: DataFrame) -> DataFrame:
    """(path, cell_no, error) of Python cells that do not parse."""
    return parsed.select("path", F.inline("errors"))


def python_lineage(sources: DataFrame, readers: Mapping[str, Mapping] | None = None) -> DataFrame:
    return lineage_rows(parse_statements(sources), readers)


def entities(rows: DataFrame) -> DataFrame:
    """(path, cell_no, ord, id, type, name, properties) of a lineage table."""
    properties = F.when(F.col("operation").isNotNull(), F.create_map(F.lit("operation"), F.col("operation")))
    return rows.where(F.col("kind") == "entity").select(
        "path", F.lit(0).alias("cell_no"), graph.statement_order("ord", "place").alias("ord"), "id", "type", "name", properties.alias("properties")
    )


def relationships(rows: DataFrame) -> DataFrame:
    """(path, src, dst, type, confidence_score) of a lineage table."""
    return rows.where(F.col("kind") == "relationship").select(
        "path", "src", "dst", F.col("rel").alias("type"), F.col("confidence").cast("float").alias("confidence_score")
    )


def _per_file(files: DataFrame, one, columns: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    def run(batches):
        schema = pa.schema([("file", pa.string()), *columns, ("error", pa.string())])
        for batch in batches:
            rows = []
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                try:
                    rows += [{"file": path, **row} for row in one(text or "")]
                except (SyntaxError, ValueError, RecursionError, MemoryError) as error:
                    rows.append({"file": path, "error": type(error).__name__})
                if len(rows) >= _FLUSH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "text").mapInArrow(run, f"file string, {ddl}, error string")


def ast_nodes(files: DataFrame) -> DataFrame:
    """Syntax tree of every file, one row per node."""
    columns = [("ast_id", pa.int32()), ("parent_id", pa.int32()), ("type", pa.string()), ("text", pa.string()), ("line", pa.int32()), ("end_line", pa.int32())]
    return _per_file(files, python_syntax.tree_rows, columns, "ast_id int, parent_id int, type string, text string, line int, end_line int")


def code_chunks(files: DataFrame) -> DataFrame:
    """Import block, functions and classes of every file, one row per chunk."""
    columns = [("chunk_no", pa.int32()), ("kind", pa.string()), ("name", pa.string()), ("text", pa.string())]
    return _per_file(files, python_syntax.chunk_rows, columns, "chunk_no int, kind string, name string, text string")
