"""Lineage of SQL cells, as native expressions on the statement's own row."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.functions import sql_text as t
from threadline.operators import graph
from threadline.session import materialize, stack, store

_KEYS = ("path", "cell_no", "stmt_no")


def _marked(rows: DataFrame, *kept: str) -> DataFrame:
    """``kept`` with stmt_no, text, literals and balanced of every statement of ``content``."""

    def run(batches):
        for batch in batches:
            spots, numbers, texts, literals, matching = [], [], [], [], []
            for spot, content in enumerate(batch.column("content").to_pylist()):
                found, balanced = t.split_statements(content or "")
                spots += [spot] * len(found)
                numbers += range(len(found))
                texts += [text for text, _ in found]
                literals += [own for _, own in found]
                matching += [balanced] * len(found)
            columns = [batch.column(c).take(pa.array(spots, pa.int64())) for c in kept]
            made = [pa.array(numbers, pa.int32()), pa.array(texts, pa.string()), pa.array(literals, pa.list_(pa.string())), pa.array(matching, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, *made], [*kept, "stmt_no", "text", "literals", "balanced"])

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.select(*kept, "content").mapInArrow(run, f"{types}, stmt_no int, text string, literals array<string>, balanced boolean")


def sql_statements(cells: DataFrame) -> DataFrame:
    """(path, cell_no, stmt_no, text, literals, balanced) of SQL cells; text carries marks and no literals.

    ``cells`` needs path, cell_no and content.
    """
    return _marked(cells, "path", "cell_no")


def sql_errors(statements: DataFrame) -> DataFrame:
    """(path, cell_no, error) of cells whose parentheses do not match."""
    return statements.where("NOT balanced").select("path", "cell_no", F.lit("UnbalancedParentheses").alias("error")).distinct()


def sql_components(statements: DataFrame) -> DataFrame:
    """Keys with target, sources, ctes and the final select of each statement."""
    parts = statements.where("balanced").selectExpr(*_KEYS, "text", "literals", f"{t.without_ctes('text')} AS main").selectExpr(
        *_KEYS, "text", "literals", "main", f"{t.target('main')} AS target", f"{t.path_target('main')} AS path_target",
        f"{t.sorted_tables_in('text')} AS tables", f"{t.merge_target('main')} AS merge_target", f"{t.ctes('text')} AS cte_texts",
    )
    cte = f"""struct(c.name AS name,
        struct({t.sorted_tables_in('c.body')} AS tables, {t.functions_in_from('c.body')} AS table_functions,
               CAST(array() AS array<string>) AS scalar_functions) AS sources,
        {t.aggregations('c.body')} AS aggregations, {t.filters('c.body')} AS filters, {t.group_by('c.body')} AS group_by)"""
    return parts.selectExpr(
        *_KEYS, "text", "literals", "main", "target", "path_target", "tables", "merge_target",
        "transform(cte_texts, c -> struct(c.name AS name, c.columns AS columns, c.number AS number)) AS cte_blocks",
        f"if(merge_target IS NOT NULL, {t.merge_sources('text')}, NULL) AS merge_sources",
        f"transform(cte_texts, c -> {cte}) AS ctes",
        f"struct(coalesce({t.sorted_tables_in(t.final_from('main'))}, CAST(array() AS array<string>)) AS `from`, "
        f"{t.order_by('main')} AS order_by) AS final_select",
    )


def feature_flags(statements: DataFrame) -> DataFrame:
    """Which statements join, merge, or use window functions."""
    return statements.selectExpr(
        *_KEYS,
        r"""text RLIKE r"(?i)\bJOIN\x01" AS has_join""",
        r"""text RLIKE r"(?i)^\s*(?:WITH\x01.*)?\bMERGE\s+INTO\b" AS has_merge""",
        r"""text RLIKE r"(?i)\)\x01\d+\x02\s*(?:(?:IGNORE|RESPECT)\s+NULLS\s*)?OVER\b\s*(?:\(|(?!(?:FROM|AS)\b)\w)" AS has_window""",
    )


def sql_lineage(components: DataFrame) -> DataFrame:
    """(path, cell_no, stmt_no, place, rule, kind, id, type, name, is_cte, src, dst, rel)."""
    fields = {"rule": "string", "kind": "string", "id": "string", "type": "string", "name": "string",
              "is_cte": "boolean", "src": "string", "dst": "string", "rel": "string"}

    def row(**values: str) -> str:
        return "struct(" + ", ".join(f"CAST({values.get(n, 'NULL')} AS {k}) AS {n}" for n, k in fields.items()) + ")"

    def entity(rule: str, kind: str, name: str, is_cte: str = "false") -> str:
        return row(rule=f"'{rule}'", kind="'entity'", id=f"concat('{kind}:', {name})", type=f"'{kind}'", name=name, is_cte=is_cte)

    def edge(rule: str, src: str, dst: str, kind: str = "table") -> str:
        return row(rule=f"'{rule}'", kind="'relationship'", src=src, dst=f"concat('{kind}:', {dst})", rel="'reads_from'")

    table = "concat('table:', n)"
    none = "CAST(array() AS array<struct<" + ", ".join(f"{n}: {k}" for n, k in fields.items()) + ">>)"
    # a CTE is told as one, by the rows of its own rule
    plain_tables = "array_except(tables, transform(ctes, c -> c.name))"
    written = f"""if(target IS NOT NULL, concat(
        array({entity('L2a', 'table', 'target')}),
        transform({plain_tables}, n -> {entity('L2a', 'table', 'n')}),
        transform(filter(tables, n -> n <> target), n -> {edge('L2a', table, 'target')})), {none})"""
    stored = f"""if(path_target IS NOT NULL, concat(
        array({entity('L2a', 'path', 'path_target')}),
        transform({plain_tables}, n -> {entity('L2a', 'table', 'n')}),
        transform(tables, n -> {edge('L2a', table, 'path_target', 'path')})), {none})"""
    merged = f"""if(merge_target IS NOT NULL, concat(
        array({entity('L3', 'table', 'merge_target')}),
        transform(merge_sources, n -> {entity('L3', 'table', 'n')}),
        transform(filter(merge_sources, n -> n <> merge_target), n -> {edge('L3', table, 'merge_target')})), {none})"""
    cte_rows = f"""flatten(transform(ctes, c -> concat(
        array({entity('L2b', 'table', 'c.name', 'true')}),
        transform(array_except(c.sources.tables, transform(ctes, x -> x.name)), n -> {entity('L2b', 'table', 'n')}),
        transform(c.sources.tables, n -> {edge('L2b', table, 'c.name')}),
        transform(c.sources.table_functions, n -> {entity('L2c', 'function', 'n')}),
        transform(c.sources.table_functions, n -> {edge('L2c', "concat('function:', n)", 'c.name')}))))"""
    listed = f"if(target IS NULL AND path_target IS NULL AND merge_target IS NULL, transform({plain_tables}, n -> {entity('L2h', 'table', 'n')}), {none})"
    return components.selectExpr(
        *_KEYS, f"posexplode_outer(concat({written}, {stored}, {merged}, {cte_rows}, {listed})) AS (place, r)"
    ).where("place IS NOT NULL").select(*_KEYS, "place", "r.*")


def entities(rows: DataFrame) -> DataFrame:
    """(path, cell_no, ord, id, type, name, properties) in order of appearance."""
    properties = F.when(F.col("is_cte"), F.create_map(F.lit("is_cte"), F.lit("true")))
    return rows.where("kind = 'entity'").select(
        "path", "cell_no", graph.statement_order("stmt_no", "place").alias("ord"), "id", "type", "name", properties.alias("properties")
    )


def relationships(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'relationship'").select(
        "path", "src", "dst", F.col("rel").alias("type"), F.lit(1.0).cast("float").alias("confidence_score")
    )


def embedded_sql(python_rows: DataFrame) -> DataFrame:
    """(path, cell_no, content, dst) of SQL text inside Python; cell_no is the statement's place."""
    return python_rows.where("kind = 'sql'").select("path", F.col("ord").alias("cell_no"), F.col("sql").alias("content"), "dst")


def tables_to_variables(python_rows: DataFrame) -> DataFrame:
    """(path, rule, src, dst, rel) for ``x = spark.sql(text)``: tables of the text to the variable.

    The text's row carries the variable along, so no join brings them together again.
    """
    found = embedded_sql(python_rows).where("dst IS NOT NULL")
    read = _marked(found, "path", "dst").where("balanced").selectExpr("path", "dst", f"explode_outer({t.sorted_tables_in('text')}) AS n").where("n IS NOT NULL")
    return read.selectExpr("path", "'L4' AS rule", "concat('table:', n) AS src", "dst", "'reads_from' AS rel")


def stated_in_texts(python_rows: DataFrame) -> DataFrame:
    """Lineage rows that SQL text inside Python states by itself."""
    return sql_lineage(sql_components(sql_statements(embedded_sql(python_rows))))


def embedded_sql_lineage(python_rows: DataFrame, inner: DataFrame | None = None) -> DataFrame:
    """Relationships of SQL text inside Python: to the variable, and those the text itself states.

    ``python_rows`` is read twice, so let it be a table; ``inner`` is ``stated_in_texts`` where that is at hand.
    """
    inner = stated_in_texts(python_rows) if inner is None else inner
    stated = inner.where("kind = 'relationship'").select("path", F.lit("L4").alias("rule"), "src", "dst", "rel")
    return stack(tables_to_variables(python_rows), stated)


# Words that are no columns wherever they stand in an expression.
_RESERVED = (
    "ALL", "AND", "ANY", "AS", "ASC", "BETWEEN", "BOTH", "BY", "CASE", "CURRENT", "DESC", "DISTINCT", "DIV", "ELSE", "END", "ESCAPE", "EXISTS", "FALSE",
    "FILTER", "FOLLOWING", "FROM", "ILIKE", "IN", "IS", "LEADING", "LIKE", "NOT", "NULL", "OR", "ORDER", "OVER", "PARTITION", "PRECEDING", "RLIKE", "ROWS",
    "SOME", "THEN", "TRAILING", "TRUE", "UNBOUNDED", "WHEN", "WHERE",
)
# Parts of an expression in which a word is none: literals and what names their type, types of casts, units, frames.
_NO_COLUMNS = (
    r"\b(?:DATE|TIMESTAMP|TIMESTAMP_NTZ|TIME|X)\s*\x03\d+\x04|\x03\d+\x04|\bINTERVAL\s+\S+\s+\w+|\bAS\s+[`\w]+|(?<=\x02)\s*\w+\s+FROM\b"
    r"|\b(?:ROWS|RANGE)\s+(?:BETWEEN\b)?.*?(?=\)\x01)|\bNULLS\s+(?:FIRST|LAST)\b|\b(?:IGNORE|RESPECT)\s+NULLS\b|\bOVER\s+\w+"
)
_SUBQUERY = r"\(\x01(\d+)\x02\s*(?:SELECT|WITH)\b.*?\)\x01\1\x02"


def _column_sources() -> str:
    """array of struct(alias, table_name, number) a block reads: a table has a name, a subquery or CTE a number."""
    alias = rf"(?:AS\s+)?(?!(?:LEFT|RIGHT|FULL|INNER|CROSS|SEMI|ANTI|NATURAL|OUTER|TABLESAMPLE|PIVOT|UNPIVOT)\b)`?({t.WORD}+)`?"
    table = rf"^\s*(?:LATERAL\s+)?({t.NAME})(?!\s*\()(?:\s+{alias})?"
    query = rf"^\s*(?:LATERAL\s+)?\(\x01(\d+)\x02.*\)\x01\1\x02(?:\s*{alias})?"
    name, own = t.clean_name(t.extract("i", table, 1)), t.extract("i", query, 1)
    cte = f"get(filter(cte_blocks, c -> lower(c.name) = lower({name})), 0).number"
    entry = f"if({own} IS NOT NULL, struct({t.extract('i', query, 2)} AS alias, CAST(NULL AS string) AS table_name, {own} AS number), struct({t.extract('i', table, 2)} AS alias, {name} AS table_name, {cte} AS number))"
    return f"filter(transform({t.block_sources()}, i -> {entry}), s -> s.table_name IS NOT NULL OR s.number IS NOT NULL)"


def _select_outputs(items: str) -> str:
    """Names of a select list's columns; NULL for a star or an expression without a name."""
    return f"transform({items}, item -> {_output('item')})"


_EXPLICIT = rf"^(.*?)\s+AS\s+`?({t.WORD}+)`?\s*$"
_OPERATORS = "AND|OR|NOT|LIKE|IN|IS|BETWEEN|DIV|THEN|ELSE|WHEN|DISTINCT"
_IMPLICIT = rf"^(.*[\p{{L}}\p{{N}}_`)\x02\x04}}])(?<!\b(?:{_OPERATORS}))\s+(?!(?:END|NULL|TRUE|FALSE)\s*$)`?({t.WORD}+)`?\s*$"
_BARE = rf"^\s*(?:{t.WORD}+\.|`[^`]*`\.)*`?({t.WORD}+)`?\s*$"
_STAR = rf"^\s*(?:({t.NAME})\.)?\*\s*(?:EXCEPT\s*\(\x01\d+\x02(.*?)\)\x01\d+\x02)?\s*$"


def _output(item: str) -> str:
    return f"coalesce({t.extract(item, _EXPLICIT, 2)}, {t.extract(item, _IMPLICIT, 2)}, {t.extract(item, _BARE)})"


def _matching(qualifier: str) -> str:
    """The source a qualifier names: its alias, its table's name or the last part of that."""
    return f"""get(filter(sources, s -> lower(s.alias) = lower({qualifier}) OR lower(s.table_name) = lower({qualifier})
        OR lower(element_at(split(s.table_name, '[.]'), -1)) = lower({qualifier})), 0)"""


def query_scopes(components: DataFrame) -> DataFrame:
    """Where each column of each query block comes from.

    Keys, target, root (number of the statement's own query), then number and output
    of a block's column, its expression, and one source: a table, or the query of
    ``from_number``, with the column. A star is the column ``*``; ``listed`` are the
    block's own names and ``excluded`` those a star leaves out. Blocks of a union share
    a number, and the names of the first. ``sure`` is false where a bare name may
    belong to another source as well.
    """
    first = t.extract("main", r"^.*?\bSELECT\x01(\d+)\x02", 1)
    stated = components.where("target IS NOT NULL").selectExpr(*_KEYS, "target", "literals", "cte_blocks", f"{first} AS root", f"{t.blocks('text')} AS blocks")
    block = stated.selectExpr(*_KEYS, "target", "literals", "cte_blocks", "root", "transform(blocks, b -> b.number) AS numbers", "blocks", "posexplode(blocks) AS (place, b)")
    names = "nullif(get(filter(cte_blocks, c -> c.number = b.number), 0).columns, '')"
    block = block.selectExpr(
        *_KEYS, "target", "literals", "cte_blocks", "root", "place", "b.number AS number", "b.body AS body",
        "if(array_position(numbers, b.number) - 1 = place, NULL, blocks[CAST(array_position(numbers, b.number) - 1 AS INT)].body) AS first_body",
        f"transform(split({names}, ','), n -> {t.clean_name(t.plain('n'))}) AS given",
    )
    block = block.selectExpr(
        *_KEYS, "target", "literals", "root", "place", "number", "given", f"{t.block_items()} AS items", f"{_column_sources()} AS sources",
        f"if(first_body IS NULL, NULL, {t.block_items('first_body')}) AS first_items",
    )
    block = block.withColumn("own", F.expr(_select_outputs("items"))).withColumn("firsts", F.expr("if(first_items IS NULL, own, " + _select_outputs("first_items") + ")"))
    starred = lambda items: f"exists({items}, i -> {t.extract('i', _STAR, 0)} IS NOT NULL)"
    block = block.withColumn("by_place", ~F.expr(starred("items")) & ~F.expr(f"coalesce({starred('first_items')}, false)"))
    item = block.selectExpr(
        *_KEYS, "target", "literals", "root", "place", "number", "sources", "coalesce(given, filter(own, n -> n IS NOT NULL)) AS listed", "given", "own", "firsts", "by_place",
        "posexplode(items) AS (at, item)",
    )
    output = "coalesce(if(by_place, coalesce(get(given, at), get(firsts, at)), get(own, at)), if(number = root, NULL, concat('_c', at)))"
    expression = f"coalesce({t.extract('item', _EXPLICIT, 1)}, if(get(own, at) = {t.extract('item', _IMPLICIT, 2)}, {t.extract('item', _IMPLICIT, 1)}, NULL), item)"
    item = item.selectExpr(
        *_KEYS, "target", "literals", "root", "place", "number", "sources", "listed", "at", f"{output} AS output", f"{expression} AS marked_expression",
        f"{t.extract('item', _STAR, 0)} IS NOT NULL AS star", f"{t.extract('item', _STAR, 1)} AS star_of",
        f"transform(split({t.extract('item', _STAR, 2)}, ','), n -> lower({t.clean_name(t.plain('n'))})) AS excluded",
    )
    item = store(item, "select-items")  # read by every kind of source below
    keys = [*_KEYS, "target", "root", "place", "number", "listed", "at"]
    stars = item.where("star").selectExpr(
        *keys, "'*' AS output", "'*' AS expression", "excluded", f"explode(if(star_of IS NULL, sources, array({_matching('star_of')}))) AS s",
        "star_of IS NOT NULL OR size(sources) = 1 AS sure",
    ).selectExpr(*keys, "output", "expression", "excluded", "s.table_name AS from_table", "s.number AS from_number", "'*' AS from_column", "sure")
    outer = f"regexp_replace(marked_expression, {t._raw('(?is)' + _SUBQUERY)}, ' ')"
    bare = f"regexp_replace({outer}, {t._raw('(?is)' + _NO_COLUMNS)}, ' ')"
    found = t.extract_all(bare, rf"(?<![\p{{L}}\p{{N}}_.`])({t.NAME})(?!\s*\()(?![\p{{L}}\p{{N}}_.`])", 1)
    reserved = ", ".join(f"'{w}'" for w in _RESERVED)
    named = item.where("NOT star AND output IS NOT NULL").selectExpr(
        *keys, "output", f"{t.unmasked(t.plain('marked_expression'))} AS expression", "sources",
        f"array_distinct(transform(filter({found}, n -> upper(n) NOT IN ({reserved}) AND n NOT RLIKE '^[0-9]'), n -> {t.clean_name('n')})) AS names",
        f"{t.extract_all('marked_expression', _SUBQUERY, 1)} AS inner_numbers",
    )
    named = store(named, "named-items")
    inner = named.selectExpr(
        *keys, "output", "expression", "CAST(NULL AS array<string>) AS excluded", "CAST(NULL AS string) AS from_table",
        "explode(inner_numbers) AS from_number", "'*' AS from_column", "true AS sure",
    )
    parts = "split(reference, '[.]')"
    whole, head = _matching("substring_index(reference, '.', size(split(reference, '[.]')) - 1)"), _matching("substring_index(reference, '.', 1)")
    some = "CAST(NULL AS struct<alias: string, table_name: string, number: string>)"
    sole = f"if(size(sources) = 1, sources[0], {some})"
    pick = lambda s, c, sure="true": f"struct({s} AS s, {c} AS c, {sure} AS sure)"
    candidates = f"""CASE
        WHEN contains(reference, '.') AND {whole} IS NOT NULL THEN array({pick(whole, f"element_at({parts}, -1)")})
        WHEN contains(reference, '.') AND {head} IS NOT NULL THEN array({pick(head, f"{parts}[1]")})
        WHEN size(sources) = 1 THEN array({pick(sole, f"{parts}[0]")})
        WHEN contains(reference, '.') THEN array()
        ELSE transform(sources, s -> {pick('s', 'reference', 'false')}) END"""
    used = named.selectExpr(*keys, "output", "expression", "sources", "explode(names) AS reference").selectExpr(
        *keys, "output", "expression", f"inline({candidates})"
    ).selectExpr(*keys, "output", "expression", "CAST(NULL AS array<string>) AS excluded", "s.table_name AS from_table", "s.number AS from_number", "c AS from_column", "sure")
    columns = ["*", F.when(F.col("from_number").isNull(), F.col("from_table")).alias("table_name")]
    return stack(stars, inner, used).select(*columns).drop("from_table")


def column_lineage(components: DataFrame) -> DataFrame:
    """(path, cell_no, stmt_no, src, dst, rel, expression): columns of a written select list, from tables' columns.

    Columns of subqueries, CTEs and unions are followed to the tables they come from, a
    level of nesting each round, stars included; a table's star passes on any column
    asked of it. A bare name belongs to the only source, or to the only one known to have
    it; to a table among subqueries if none of those has it and it is the only table.
    """
    scopes = materialize(query_scopes(components))
    keys = list(_KEYS)
    has = scopes.where("output <> '*'").select(*keys, F.col("number").alias("from_number"), F.lower("output").alias("_name")).distinct()
    # bare names with several sources: those a query is known to have, else those of the only table
    unsure = scopes.where("NOT sure AND output <> '*'")
    spot = [*keys, "place", "at", "output", "from_column"]
    known = unsure.where("from_number IS NOT NULL").withColumn("_name", F.lower("from_column")).join(has, [*keys, "from_number", "_name"], "left_semi").select(*scopes.columns)
    left = unsure.where("table_name IS NOT NULL").join(known.select(*spot), spot, "left_anti")
    only = left.groupBy(*spot).agg(F.count("*").alias("_n")).where("_n = 1").select(*spot)
    start = materialize(stack(scopes.where("sure OR output = '*'"), known, left.join(only, spot, "left_semi").select(*scopes.columns)))
    ahead = start.select(
        *keys, F.col("number").alias("from_number"), F.col("output").alias("own"), F.col("expression").alias("inner"), "listed", "excluded",
        F.col("from_number").alias("_number"), F.col("from_column").alias("_column"), F.col("table_name").alias("_table"), F.col("sure").alias("_sure"),
    )
    state = [*keys, "target", "output", "expression", "from_number", "from_column", "table_name"]
    open_ = start.where("number = root").select(*state)
    seen = open_
    while not open_.where("from_number IS NOT NULL").isEmpty():
        met = open_.where("from_number IS NOT NULL").drop("table_name").join(ahead, [*keys, "from_number"])
        wanted, own = F.lower("from_column"), F.lower("own")
        same = (wanted == own) | (F.col("from_column") == "*")
        hidden = F.array_contains(F.transform("listed", F.lower), wanted) | F.coalesce(F.array_contains("excluded", wanted), F.lit(False))
        through = (F.col("own") == "*") & (F.col("from_column") != "*") & ~hidden & (F.col("_sure") | F.col("_number").isNotNull())
        starred = (F.col("output") == "*") & (F.col("own") != "*")
        step = met.where(same | through).select(
            *keys, "target", F.when(starred, F.col("own")).otherwise(F.col("output")).alias("output"), F.when(starred, F.col("inner")).otherwise(F.col("expression")).alias("expression"),
            F.col("_number").alias("from_number"), F.when(through, F.col("from_column")).otherwise(F.col("_column")).alias("from_column"), F.col("_table").alias("table_name"),
        ).distinct()
        open_ = materialize(step.exceptAll(seen.select(*state)))  # a recursive query comes back to itself
        seen = stack(seen, open_)
    found = seen.where("table_name IS NOT NULL AND output <> '*' AND from_column <> '*'")
    return found.selectExpr(
        *keys, "concat('column:', table_name, '.', from_column) AS src", "concat('column:', target, '.', output) AS dst", "'transforms_into' AS rel", "expression",
    ).distinct()
