"""Checked queries: retrieval, grounding, the facade."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.functions import text as fx
from threadline.functions.vectors import hashed_embedding
from threadline.operators import search
from threadline.plans import facade, inputs, stored
from threadline.plans.catalog import query
from threadline.plans.inputs import sql_over

# SQL twins of the text functions.
_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
_BUCKET = "CAST(('0x' || substr(md5({}), 1, 8))::BIGINT % 64 AS INT)"


def _hashed(name: str, rows: str) -> str:
    """CTEs name_words, name_counts and name(id, embedding) for rows(id, text)."""
    return f"""{name}_words AS (SELECT id, unnest({_WORDS.format('text')}) AS word FROM {rows}),
        {name}_counts AS (SELECT id, {_BUCKET.format('word')} AS bucket, count(*) AS n FROM {name}_words GROUP BY ALL),
        {name}_norms AS (SELECT id, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT) AS value FROM {name}_counts),
        {name} AS (SELECT id, list(coalesce(value, 0)::DOUBLE ORDER BY slot) AS embedding FROM
            (SELECT DISTINCT id, slot FROM {name}_counts, range(64) AS s(slot)) LEFT JOIN {name}_norms ON {name}_norms.id = id AND bucket = slot GROUP BY id)"""


_HASH_FIX = "(SELECT DISTINCT id, slot FROM {0}_counts, range(64) AS s(slot)) LEFT JOIN {0}_norms ON {0}_norms.id = id AND bucket = slot GROUP BY id"
_HASH_OK = "(SELECT DISTINCT id AS own, slot FROM {0}_counts, range(64) AS s(slot)) LEFT JOIN {0}_norms ON {0}_norms.id = own AND bucket = slot GROUP BY own"


def hashed(name: str, rows: str) -> str:
    return _hashed(name, rows).replace(_HASH_FIX.format(name), _HASH_OK.format(name)).replace(
        f"{name} AS (SELECT id, list(", f"{name} AS (SELECT own AS id, list("
    )


def _bm25(name: str, docs: str, questions: str) -> str:
    """CTE name(query_id, id, score) over docs(id, text) and questions(query_id, text)."""
    return f"""{name}_tokens AS (SELECT id, unnest({_WORDS.format('text')}) AS word FROM {docs}),
        {name}_sizes AS (SELECT id, len({_WORDS.format('text')}) AS length FROM {docs}),
        {name}_asked AS (SELECT DISTINCT query_id, word FROM (SELECT query_id, unnest({_WORDS.format('text')}) AS word FROM {questions})),
        {name}_tf AS (SELECT id, word, count(*) AS tf FROM {name}_tokens WHERE word IN (SELECT word FROM {name}_asked) GROUP BY ALL),
        {name}_df AS (SELECT word, count(*) AS df FROM {name}_tf GROUP BY word),
        {name}_all AS (SELECT count(*) AS n, avg(length) AS mean_length FROM {name}_sizes),
        {name} AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))), 6) AS score
            FROM {name}_tf JOIN {name}_asked USING (word) JOIN {name}_df USING (word) JOIN {name}_sizes USING (id), {name}_all GROUP BY ALL)"""


def _cosines(name: str, nodes: str, questions: str) -> str:
    return f"""{name} AS (SELECT q.id AS query_id, d.id, round(list_cosine_similarity(d.embedding, q.embedding), 6) AS score FROM {nodes} d, {questions} q)"""


def _top(name: str, scored: str, k: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank FROM {scored}) WHERE rank <= {k})"""


def _ranked(name: str, scored: str) -> str:
    """CTE name: every row of scored with its rank."""
    return f"{name} AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM {scored})"


# Entity text, and one question for every brand and type of part.
_NODE_TEXT = """node_text AS (
    SELECT id, is_active, concat_ws(chr(10), 'Entity Type: ' || entity_type, 'Entity Name: ' || entity_name,
           'Properties: brand=' || brand || ', size=' || size || ', type=' || kind) AS text FROM graph_nodes)"""
_QUESTIONS = "questions AS (SELECT DISTINCT p_type || ' ' || p_brand AS query_id, 'which ' || p_type || ' table has ' || p_brand AS text FROM part)"
_QUESTION_ROWS = "question_rows AS (SELECT query_id AS id, text FROM questions)"


def _hybrid_ctes(k: int, nodes: str = "node_text") -> list[str]:
    return [
        hashed("nv", nodes), _QUESTION_ROWS, hashed("qv", "question_rows"), _cosines("vs", "nv", "qv"), _ranked("vt", "vs"),
        _bm25("kw", nodes, "questions"), _ranked("kt", "kw"),
        """fused AS (SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM
            (SELECT query_id, id, rank FROM vt UNION ALL SELECT query_id, id, rank FROM kt) GROUP BY ALL)""",
        _top("hits", "fused", k),
    ]


def node_index(spark, sf):
    """(id, text, embedding, is_active, ...) of every node, embedded from its text."""
    return facade.index_nodes(stored.nodes(spark, sf))


def questions(spark, sf):
    part = inputs.table(spark, sf, "part")
    asked = part.select(
        F.concat_ws(" ", "p_type", "p_brand").alias("query_id"), F.concat(F.lit("which "), "p_type", F.lit(" table has "), "p_brand").alias("text")
    ).distinct()
    return facade.embed_questions(asked)


@query(
    "r1_hashed_embedding",
    f"WITH docs AS (SELECT doc_id AS id, text FROM documents), {hashed('v', 'docs')} "
    "SELECT id AS doc_id, slot, round(value, 5) AS value FROM (SELECT id, unnest(embedding) AS value, unnest(range(64))::INT AS slot FROM v) WHERE value <> 0",
)
def r1(spark, sf):
    docs = inputs.spread(inputs.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    rows = docs.select("doc_id", F.posexplode(hashed_embedding(F.col("text"))).alias("slot", "value"))
    return rows.where("value <> 0").select("doc_id", "slot", F.round(F.col("value").cast("double"), 5).alias("value"))


_CENTROIDS = """centroids AS (SELECT label AS id, list(value ORDER BY slot) AS embedding FROM (
    SELECT label, slot, avg(value)::FLOAT AS value FROM (SELECT label, unnest(embedding)::DOUBLE AS value, unnest(range(64)) AS slot FROM embeddings)
    GROUP BY ALL) GROUP BY label)"""


def _centroids(spark, sf):
    """One query vector per label: the mean of its vectors."""
    rows = inputs.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("slot", "value"))
    means = rows.groupBy("label", "slot").agg(F.avg(F.col("value").cast("double")).cast("float").alias("value"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("slot", "value"))), lambda x: x["value"])
    return means.groupBy(F.col("label").alias("query_id")).agg(listed.alias("embedding"))


def _vectors(spark, sf):
    return inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(
    "r2_vector_top_k",
    f"WITH {_CENTROIDS}, vectors AS (SELECT vec_id AS id, embedding FROM embeddings), scored AS (SELECT q.id AS query_id, d.id, "
    f"round(list_cosine_similarity(d.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM vectors d, centroids q), {_top('best', 'scored', 8)} "
    "SELECT query_id, id, score, rank FROM best",
)
def r2(spark, sf):
    return search.vector_top_k(_vectors(spark, sf), _centroids(spark, sf), 8)


@query(
    "o2_top_k_per_query",
    """SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM (SELECT event_type AS query_id, event_id AS id, value AS score,
       row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 8""",
)
def o2(spark, sf):
    scored = inputs.table(spark, sf, "events").select(F.col("event_type").alias("query_id"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    return search.top_k_per_query(scored, 8)


@query(
    "r3_keyword_search",
    f"WITH docs AS (SELECT doc_id AS id, text FROM documents), asked AS (SELECT item_id AS query_id, text FROM benchmark), {_bm25('kw', 'docs', 'asked')}, "
    f"{_top('best', 'kw', 8)} SELECT query_id, id, score, rank FROM best",
)
def r3(spark, sf):
    docs = inputs.spread(inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "id")
    asked = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.keyword_search(docs, asked, 8)


@query("r4_hybrid_search", sql_over("graph_nodes", "SELECT query_id, id, score, rank FROM hits", _NODE_TEXT, _QUESTIONS, *_hybrid_ctes(8)))
def r4(spark, sf):
    return search.hybrid_search(node_index(spark, sf), questions(spark, sf), 8)


@query(
    "r6_filtered_search",
    sql_over("graph_nodes", "SELECT query_id, id, score, rank FROM hits", _NODE_TEXT, "active_text AS (SELECT * FROM node_text WHERE is_active)",
             _QUESTIONS, *_hybrid_ctes(8, "active_text")),
)
def r6(spark, sf):
    return search.filtered_search(node_index(spark, sf), questions(spark, sf), 8)


from threadline.plans.queries_graph import _CACHE, _FLOW  # noqa: E402


@query(
    "r5_rerank",
    sql_over("graph_nodes graph_edges", "SELECT query_id, id, score, rank FROM reranked", _NODE_TEXT, _QUESTIONS, *_hybrid_ctes(8), _FLOW, _CACHE,
             """near AS (SELECT query_id, id, sum(closeness) AS closeness FROM (
                 SELECT a.query_id, unnest([p.src, p.tgt]) AS id, 1.0::DOUBLE / p.min_hops AS closeness
                 FROM hits a JOIN pc p ON p.src = a.id JOIN hits b ON b.query_id = a.query_id AND b.id = p.tgt) GROUP BY ALL)""",
             """rescored AS (SELECT h.query_id, h.id, round(list_cosine_similarity(nv.embedding, qv.embedding) + 0.1 * coalesce(closeness, 0), 6) AS score
                 FROM hits h JOIN nv ON nv.id = h.id JOIN qv ON qv.id = h.query_id LEFT JOIN near n ON n.query_id = h.query_id AND n.id = h.id)""",
             _top("reranked", "rescored", 8)),
)
def r5(spark, sf):
    nodes, asked = node_index(spark, sf), questions(spark, sf)
    hits = search.hybrid_search(nodes, asked, 8)
    return search.rerank(hits, nodes, asked, stored.path_cache(spark, sf), 8)


_TYPED = """typed AS (SELECT DISTINCT entity_name AS name, substr(entity_name, 1, 8 + i) || substr(entity_name, 10 + i) AS typed
    FROM (SELECT entity_name, CAST(length(entity_name) % 6 AS INT) AS i FROM graph_nodes WHERE entity_type <> 'table'))"""


@query(
    "r7_fuzzy_match",
    sql_over("graph_nodes", """SELECT t.typed, n.name, CAST(levenshtein(t.typed, n.name) AS INT) AS distance
        FROM (SELECT DISTINCT typed FROM typed) t, (SELECT DISTINCT entity_name AS name FROM graph_nodes) n
        WHERE abs(length(t.typed) - length(n.name)) <= 1 AND levenshtein(t.typed, n.name) <= 1""", _TYPED),
)
def r7(spark, sf):
    nodes = stored.nodes(spark, sf)
    at = (F.length("entity_name") % 6).cast("int")
    name = F.col("entity_name")
    typed = nodes.where("entity_type <> 'table'").select(
        F.concat(F.substr(name, F.lit(1), at + 8), F.substr(name, at + 10)).alias("typed")
    )
    return search.fuzzy_match(nodes.select(name.alias("name")), typed, 1)


_COSINE = "round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)"


@query(
    "r8_approx_vector_top_k",
    f"""WITH {_CENTROIDS}, vectors AS (SELECT vec_id AS id, embedding FROM embeddings),
    centres AS MATERIALIZED (SELECT id, embedding FROM vectors ORDER BY md5(id::VARCHAR), id LIMIT 32),
    members AS MATERIALIZED (SELECT id, centre FROM (SELECT a.id, b.id AS centre, row_number() OVER (PARTITION BY a.id ORDER BY {_COSINE} DESC, b.id) AS place
        FROM vectors a, centres b) WHERE place = 1),
    probes AS (SELECT query_id, centre FROM (SELECT a.id AS query_id, b.id AS centre, row_number() OVER (PARTITION BY a.id ORDER BY {_COSINE} DESC, b.id) AS place
        FROM centroids a, centres b) WHERE place <= 12),
    scored AS (SELECT p.query_id, a.id, {_COSINE} AS score FROM probes p JOIN members m ON m.centre = p.centre JOIN vectors a ON a.id = m.id
        JOIN centroids b ON b.id = p.query_id), {_top('best', 'scored', 8)} SELECT query_id, id, score, rank FROM best""",
)
def r8(spark, sf):
    index = search.build_vector_index(_vectors(spark, sf), 32)
    return search.indexed_top_k(index, _centroids(spark, sf), 8, 12)


@query(
    "r8_indexed_vector_top_k",
    f"WITH {_CENTROIDS}, vectors AS (SELECT vec_id AS id, embedding FROM embeddings), scored AS (SELECT q.id AS query_id, d.id, "
    f"round(list_cosine_similarity(d.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM vectors d, centroids q), {_top('best', 'scored', 8)} "
    "SELECT query_id, id, score, rank FROM best",
)
def r8_exact(spark, sf):
    """The same index, gone on with until no cluster can hold a better one."""
    index = search.build_vector_index(_vectors(spark, sf), 32)
    return search.indexed_top_k(index, _centroids(spark, sf), 8, 4, exact=True)


@query(
    "r10_insufficient_evidence",
    sql_over("graph_nodes", """SELECT query_id, best, coalesce(best < 0.4, true) AS insufficient FROM
        (SELECT DISTINCT query_id FROM questions) LEFT JOIN (SELECT query_id, max(score) AS best FROM vs GROUP BY query_id) USING (query_id)""",
             _NODE_TEXT, _QUESTIONS, hashed("nv", "node_text"), _QUESTION_ROWS, hashed("qv", "question_rows"), _cosines("vs", "nv", "qv")),
)
def r10(spark, sf):
    asked = questions(spark, sf)
    return search.insufficient_evidence(asked, search.vector_top_k(node_index(spark, sf), asked, 1), 0.4)


@query(
    "r11_edge_text_index",
    sql_over("graph_edges", "SELECT query_id, id, score, rank FROM best",
             "edge_rows AS (SELECT src || '|' || dst || '|' || relationship AS id, expression AS text FROM graph_edges)",
             "asked AS (SELECT DISTINCT p_name AS query_id, p_name AS text FROM part)", _bm25("kw", "edge_rows", "asked"), _top("best", "kw", 8)),
)
def r11(spark, sf):
    asked = inputs.table(spark, sf, "part").select(F.col("p_name").alias("query_id"), F.col("p_name").alias("text")).distinct()
    return search.keyword_search(search.edge_text(stored.edges(spark, sf)), asked, 8)


@query(
    "r12_suggest_names",
    sql_over("graph_nodes graph_edges", """SELECT typed, entity_name, in_degree, CAST(rank AS INT) AS rank FROM (
        SELECT t.typed, n.entity_name, n.in_degree, row_number() OVER (PARTITION BY t.typed ORDER BY n.in_degree DESC, n.entity_name) AS rank
        FROM (SELECT DISTINCT 'cat.sch.' || split_part(p_name, ' ', 1) AS typed FROM part) t
        JOIN (SELECT entity_name, coalesce(d, 0) AS in_degree FROM graph_nodes LEFT JOIN (SELECT dst, count(*) AS d FROM graph_edges GROUP BY dst) ON dst = id) n
          ON starts_with(lower(n.entity_name), t.typed)) WHERE rank <= 8"""),
)
def r12(spark, sf):
    typed = inputs.table(spark, sf, "part").select(F.concat(F.lit("cat.sch."), F.split("p_name", " ")[0]).alias("typed"))
    return search.suggest_names(stored.nodes(spark, sf), stored.edges(spark, sf), typed, 8)


_FACTS = """facts AS (
    SELECT h.query_id, h.rank, 0 AS kind, 0 AS hops, '' AS finish, '' AS label, concat_ws(' ', n.entity_type, n.entity_name) AS fact, h.id AS citation
    FROM hits h JOIN graph_nodes n ON n.id = h.id
    UNION ALL
    SELECT h.query_id, h.rank, 1, 1, e.dst, e.relationship, concat_ws(' ', e.src, e.relationship, e.dst), h.id FROM hits h JOIN (
        SELECT DISTINCT src, dst, relationship FROM graph_edges WHERE relationship <> 'contains') e ON e.src = h.id
    UNION ALL
    SELECT h.query_id, h.rank, 2, p.min_hops, p.tgt, '', array_to_string(p.path, ' > ') || ' in ' || p.min_hops || ' hops', h.id
    FROM hits h JOIN pc p ON p.src = h.id AND p.min_hops > 1)"""
_CONTEXT = """contexts AS (SELECT query_id, '- ' || string_agg(fact, chr(10) || '- ' ORDER BY rank, kind, hops, finish, label, fact) AS context,
    array_to_string(list_sort(list_distinct(list(citation))), ',') AS citations FROM facts GROUP BY query_id)"""


@query(
    "r9_grounded_context",
    sql_over("graph_nodes graph_edges", "SELECT query_id, md5(context) AS digest, citations FROM contexts",
             _NODE_TEXT, _QUESTIONS, *_hybrid_ctes(8), _FLOW, _CACHE, _FACTS, _CONTEXT),
)
def r9(spark, sf):
    nodes = node_index(spark, sf)
    hits = search.hybrid_search(nodes, questions(spark, sf), 8)
    found = search.grounded_context(hits, nodes, stored.flow_edges(spark, sf), stored.path_cache(spark, sf))
    return found.select("query_id", F.md5("context").alias("digest"), F.array_join("citations", ",").alias("citations"))


@query(
    "e1_answer_lineage",
    sql_over("graph_nodes graph_edges", """
        SELECT q.query_id, coalesce(b.best < 0.4, true) AS insufficient, md5(c.context) AS digest, c.citations,
               CAST(coalesce(i.n_origins, 0) AS BIGINT) AS n_origins, CAST(coalesce(i.n_destinations, 0) AS BIGINT) AS n_destinations
        FROM questions q LEFT JOIN (SELECT query_id, max(score) AS best FROM vs GROUP BY query_id) b USING (query_id)
        LEFT JOIN contexts c USING (query_id)
        LEFT JOIN (SELECT h.query_id, count(*) FILTER (role = 'origin') AS n_origins, count(*) FILTER (role = 'destination') AS n_destinations
                   FROM hits h JOIN (
                       SELECT src AS entity, CASE WHEN tgt NOT IN (SELECT src FROM flow WHERE src <> dst) THEN 'destination' END AS role FROM pc
                       UNION ALL SELECT tgt, CASE WHEN src NOT IN (SELECT dst FROM flow WHERE src <> dst) THEN 'origin' END FROM pc) r ON r.entity = h.id
                   GROUP BY h.query_id) i USING (query_id)""",
             _NODE_TEXT, "active_text AS (SELECT * FROM node_text WHERE is_active)", _QUESTIONS, *_hybrid_ctes(8, "active_text"), _FLOW, _CACHE, _FACTS, _CONTEXT),
)
def e1(spark, sf):
    answer = facade.answer_lineage(
        questions(spark, sf), node_index(spark, sf), stored.flow_edges(spark, sf), stored.path_cache(spark, sf), k=8, threshold=0.4
    )
    roles = answer.impact.groupBy("query_id").agg(
        F.count_if(F.col("role") == "origin").alias("n_origins"), F.count_if(F.col("role") == "destination").alias("n_destinations")
    )
    return answer.answers.join(roles, "query_id", "left").select(
        "query_id", "insufficient", F.md5("context").alias("digest"), F.array_join("citations", ",").alias("citations"),
        F.coalesce("n_origins", F.lit(0)).alias("n_origins"), F.coalesce("n_destinations", F.lit(0)).alias("n_destinations"),
    )


# keeping the graph current

from threadline.plans import queries_lineage as ql  # noqa: E402
from threadline.session import scratch_path, stack  # noqa: E402
from threadline.streaming import updates  # noqa: E402

_EDGES_SQL = ql._over_cells(
    "SELECT src, dst, CASE type WHEN 'derives_from' THEN 'transforms' ELSE type END AS relationship FROM all_relationships "
    f"UNION SELECT src, dst, 'transforms' FROM ({ql.COLUMNS_SQL})",
    ql._python_expected(), ql._SQL_EXPECTED, ql._ALL_RELATIONSHIPS,
)


def _told_edges(edges):
    """Edges but those of operations, whose ids the SQL twin cannot tell."""
    outer = ~F.col("src").startswith("op:") & ~F.col("dst").startswith("op:")
    return edges.where(outer & F.col("is_active")).select("src", "dst", "relationship")


def _setup_only(text):
    """The first cell of a SOURCE export, as a notebook once was."""
    return F.encode(F.substring_index(text.cast("string"), "\n\n# COMMAND", 1), "UTF-8")


@query("e2_update_graph", _EDGES_SQL)
def e2(spark, sf):
    """A first run over notebooks in their early form, then a run over what they became."""
    now = inputs.exports(spark, sf).where("format = 'SOURCE'")
    early = now.where(F.length("path") % 2 == 0).withColumn("content", _setup_only(F.col("content")))
    first = facade.update_graph(None, early, stored.fixed_stamp())
    second = facade.update_graph(first, now, F.lit("2024-07-01 00:00:00").cast("timestamp"))
    return _told_edges(second.edges)


@query("t6_stream_lineage_updates", _EDGES_SQL)
def t6(spark, sf):
    """The same by stream: notebooks arrive early, then as they became, some of them twice."""
    folder, log, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "lineage-log"), scratch_path(spark, "stream")
    now = inputs.exports(spark, sf).where("format = 'SOURCE'").select("path", "format", "content", F.lit(2).alias("seq"))
    early = now.withColumn("content", _setup_only(F.col("content"))).withColumn("seq", F.lit(1))
    for arrivals in (early, stack(now, early)):
        arrivals.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(now.schema).parquet(folder)
        updates.start_lineage_updates(stream, log, checkpoint).awaitTermination()
    _, edges = updates.current_graph(spark, log, stored.fixed_stamp())
    return _told_edges(edges)
