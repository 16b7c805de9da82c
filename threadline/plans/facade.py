"""The two entry points: keep a graph current from notebooks, answer questions over it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions.text import embedding_text
from threadline.functions.vectors import hashed_embedding
from threadline.operators import cells as cell_jobs
from threadline.operators import graph, python_lineage, search, sql_lineage, traverse, versions
from threadline.session import materialize, stack

LINEAGE_DDL = (
    "path string, cell_no int, ord bigint, kind string, id string, type string, name string, "
    "properties map<string,string>, src string, dst string, confidence_score float"
)


def index_nodes(nodes: DataFrame, dim: int = 64) -> DataFrame:
    """Nodes with their searchable text and its vector."""
    text = embedding_text(F.col("entity_type"), F.col("entity_name"), F.col("properties"))
    rows = nodes.select("id", "entity_type", "entity_name", "properties", "is_active", text.alias("text"))
    return rows.withColumn("embedding", hashed_embedding(F.col("text"), dim))


def embed_questions(questions: DataFrame, dim: int = 64) -> DataFrame:
    return questions.select("query_id", "text", hashed_embedding(F.col("text"), dim).alias("embedding"))


@dataclass
class Answer:
    answers: DataFrame  # query_id, insufficient, context, citations
    impact: DataFrame  # query_id, entity, direction, related, role, hops, transformations


def answer_lineage(
    questions: DataFrame, nodes: DataFrame, edges: DataFrame, cache: DataFrame, k: int = 8, threshold: float = 0.4
) -> Answer:
    """Evidence for each question: facts with citations, whether they suffice, and the impact table.

    The text of an answer is for a language model, which is not part of this.
    """
    active = nodes.where("is_active")
    questions, active = materialize(questions), materialize(active)
    vector_hits = materialize(search.vector_top_k(active, questions, search.proof_depth(k)))
    hits = materialize(search.hybrid_search(active, questions, k, near=vector_hits))
    context = search.grounded_context(hits, nodes, edges, cache)
    evidence = search.insufficient_evidence(questions, vector_hits, threshold)
    answers = evidence.join(context, "query_id", "left").select("query_id", "insufficient", "context", "citations")
    impact = traverse.impact_analysis(hits.select("id"), cache, nodes, edges)
    asked = hits.select("query_id", F.col("id").alias("entity"))
    return Answer(answers, impact.join(asked, "entity"))


def extract_lineage(exports: DataFrame, readers: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Entities, relationships and errors of notebooks in one table (``LINEAGE_DDL``, kind says which).

    Notebooks stay on their own rows and nothing is shuffled; what is parsed is
    checkpointed, since several parts of the result read it. An error row has its
    message as name.
    """
    exports = materialize(exports.select("path", "format", "content"))
    parsed = materialize(python_lineage.parse_statements(cell_jobs.python_sources(exports)))
    python = materialize(python_lineage.lineage_rows(parsed, readers))
    cells = cell_jobs.extract_cells(exports).where("cell_type = 'sql'").select("path", "cell_no", "content")
    embedded = sql_lineage.embedded_sql(python)
    statements = materialize(sql_lineage.sql_statements(stack(cells, embedded.select("path", "cell_no", "content"))))
    components = materialize(sql_lineage.sql_components(statements))
    found = F.col("kind").isin("entity", "relationship")
    from_python = python.where(found).select(
        "path", F.lit(0).alias("cell_no"), graph.statement_order("ord", "place").alias("ord"), "kind", "id",
        F.coalesce("rel", "type").alias("type"), "name", "src", "dst", F.col("confidence").alias("confidence_score"),
        F.when(F.col("operation").isNotNull(), F.create_map(F.lit("operation"), F.col("operation"))).alias("properties"),
    )
    from_sql = sql_lineage.sql_lineage(components).select(
        "path", "cell_no", graph.statement_order("stmt_no", "place").alias("ord"), "kind", "id",
        F.coalesce("rel", "type").alias("type"), "name", "src", "dst", F.lit(1.0).alias("confidence_score"),
        F.when(F.col("is_cte"), F.create_map(F.lit("is_cte"), F.lit("true"))).alias("properties"),
    )
    to_variables = sql_lineage.tables_to_variables(python).select(
        F.lit("relationship").alias("kind"), "path", "src", "dst", F.col("rel").alias("type"), F.lit(1.0).alias("confidence_score")
    )
    columns = sql_lineage.column_lineage(components)
    column_edges = columns.select(
        F.lit("relationship").alias("kind"), "path", "src", "dst", F.col("rel").alias("type"), F.lit(1.0).alias("confidence_score"),
        F.create_map(F.lit("expression"), F.col("expression")).alias("properties"),
    )
    column_ends = columns.select(F.lit("entity").alias("kind"), "path", F.explode(F.array("src", "dst")).alias("id")).select(
        "*", F.lit("column").alias("type"), F.substr("id", F.lit(8)).alias("name")
    )
    errors = stack(python_lineage.parse_errors(parsed), sql_lineage.sql_errors(statements), cell_jobs.unreadable_exports(exports).drop("format"))
    error_rows = errors.select(F.lit("error").alias("kind"), "path", "cell_no", F.col("error").alias("name"))
    merged = stack(from_python, from_sql, to_variables, column_edges, column_ends, error_rows)
    kinds = [field.strip().split(" ", 1) for field in LINEAGE_DDL.split(", ")]
    return merged.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds])


@dataclass
class GraphState:
    """What is kept between runs; every field is a stored or checkpointed table."""

    notebooks: DataFrame  # path, content hash
    lineage: DataFrame
    nodes: DataFrame
    edges: DataFrame


def graph_tables(lineage: DataFrame, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a lineage table."""
    found = lineage.where("kind = 'entity'").select("path", "cell_no", "ord", "id", "type", "name", "properties")
    nodes = graph.build_nodes(graph.dedupe_entities(found.fillna({"cell_no": 0, "ord": 0})), stamp)
    linked = lineage.where("kind = 'relationship'").select("path", "src", "dst", "type", "properties", "confidence_score")
    edges = graph.build_edges(graph.dedupe_relationships(linked, ["path"]), stamp)
    return nodes, edges


def _carry(old: DataFrame | None, new: DataFrame, keys: list[str], stamp: Column) -> DataFrame:
    """New rows with the history of the old ones; rows no longer found stay, inactive."""
    if old is None:
        return new
    past = old.select(*keys, F.struct("created_at", "updated_at", "version", "is_active").alias("past"))
    back = F.col("past").isNotNull() & ~F.col("past.is_active")
    kept = new.join(past, keys, "left").select(
        *[
            {
                "created_at": F.coalesce("past.created_at", "created_at"),
                "updated_at": F.when(back | F.col("past").isNull(), F.col("updated_at")).otherwise(F.col("past.updated_at")),
                "version": F.when(back, F.col("past.version") + 1).otherwise(F.coalesce("past.version", "version")),
            }.get(c, F.col(c)).alias(c)
            for c in new.columns
        ]
    )
    gone = versions.soft_delete(old, new, keys, stamp).join(new.select(*keys), keys, "left_anti")
    return stack(kept, gone.select(*new.columns))


def update_graph(
    state: GraphState | None, exports: DataFrame, stamp: Column, readers: Mapping[str, Mapping] | None = None
) -> GraphState:
    """The graph after a run over all current exports, parsing only what is new or changed."""
    notebooks = exports.select("path", "content")
    if state is None:
        todo, kept = exports, None
    else:
        hashed = exports.select("path", F.sha2("content", 256).alias("hash"))
        before = state.notebooks.select("path", F.col("hash").alias("old_hash"))
        compared = hashed.join(before, "path", "full_outer").where("NOT hash <=> old_hash").select("path")
        changes = materialize(compared)
        todo = exports.join(changes, "path", "left_semi")
        kept = state.lineage.join(changes, "path", "left_anti")
    fresh = extract_lineage(todo, readers)
    lineage = materialize(fresh if kept is None else stack(kept, fresh))
    nodes, edges = graph_tables(lineage, stamp)
    old = state or GraphState(None, None, None, None)
    return GraphState(
        materialize(notebooks.select("path", F.sha2("content", 256).alias("hash"))),
        lineage,
        materialize(_carry(old.nodes, nodes, ["id"], stamp)),
        materialize(_carry(old.edges, edges, ["edge_id"], stamp)),
    )
