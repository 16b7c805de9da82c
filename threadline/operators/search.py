"""Searching entities: by vector, by keyword, fused, reranked, fuzzy, by prefix; grounding facts.

Vectors meet in blocks of bounded size, however many queries there are; the planner
ships the query blocks where they are small. Top hits are cut inside each task before
they are shuffled (group limit of ``row_number``, or in the vector kernel).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.functions.text import tokens
from threadline.session import materialize, stack, store

#: Vectors a block of nodes or of queries holds; a product of two blocks is what a task has in memory.
NODE_BLOCK, QUERY_BLOCK = 2048, 1024
GROUP_ROWS = 50_000
#: Words a block of documents or of queries holds, and how many of them are multiplied at a time.
BLOCK_WORDS, WORD_SLICE = 500_000, 2048
#: Constant of reciprocal-rank fusion.
FUSION = 60


def top_k_per_query(scored: DataFrame, k: int = 8, query: str = "query_id", score: str = "score", tie: str = "id") -> DataFrame:
    """The k best rows of each query with their rank; ties go to the smaller id."""
    window = Window.partitionBy(query).orderBy(F.desc(score), F.col(tie))
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _unit_rows(vectors) -> np.ndarray:
    matrix = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _codes(ids: pa.Array) -> np.ndarray:
    """Numbers in the order of the ids, equal ones for equal ids; null comes first."""
    order = pc.array_sort_indices(ids, null_placement="at_start")
    listed, codes = ids.take(order), np.zeros(len(ids), np.int64)
    missing = np.asarray(listed.is_null())
    other = np.asarray(pc.fill_null(pc.not_equal(listed[1:], listed[:-1]), False)) | (missing[1:] != missing[:-1])
    codes[np.asarray(order)] = np.concatenate([[0], np.cumsum(other)])[: len(ids)]
    return codes


def _code_places(ids: pa.Array, names: pa.Array) -> np.ndarray:
    """How many codes of ``ids`` belong to smaller ids than each name, which is not null."""
    listed = np.sort(pc.unique(ids.drop_null()).to_numpy(zero_copy_only=False))
    return np.searchsorted(listed, names.to_numpy(zero_copy_only=False)) + int(ids.null_count > 0)


def _best_of(ids: pa.Array, scores: np.ndarray, query_ids: pa.Array, k: int, floors: np.ndarray | None = None) -> pa.RecordBatch:
    """The k best ids of one block for each query, by rounded score and then id; no score is minus infinity.

    ``floors`` has the k best scores a query has met so far and is brought up to date: an id
    below the last of them is not among the k best, so a task gives few rows for each query.
    """
    codes, rows, columns = _codes(ids), [], []
    for column, own in enumerate(np.ascontiguousarray(scores.T)):
        floor = np.partition(own, len(own) - k)[len(own) - k] if len(own) > k else -np.inf
        if floors is not None:
            floor = max(floor, floors[column].min())
        near = np.flatnonzero((own >= floor) & (own > -np.inf))
        best = near[np.lexsort((codes[near], -own[near]))][:k]
        rows.append(best)
        columns.append(np.full(len(best), column))
        if floors is not None and len(best):
            both = np.concatenate([floors[column], own[best]])
            floors[column] = np.partition(both, len(best))[len(best):]
    at, of = np.concatenate(rows).astype(np.int64), np.concatenate(columns).astype(np.int64)
    return pa.RecordBatch.from_arrays([query_ids.take(pa.array(of)), ids.take(pa.array(at)), pa.array(scores[at, of])], ["query_id", "id", "score"])


class _Floors:
    """The scores that ids must reach, for the blocks of queries a task met last."""

    def __init__(self, k: int, kept: int = 32):
        self.k, self.kept, self.blocks = k, kept, {}

    def of(self, query_ids: pa.Array) -> np.ndarray:
        key = (query_ids[0].as_py(), len(query_ids)) if len(query_ids) else None
        if key not in self.blocks:
            if len(self.blocks) >= self.kept:
                del self.blocks[next(iter(self.blocks))]
            self.blocks[key] = np.full((len(query_ids), self.k), -np.inf)
        return self.blocks[key]


def _ahead(own: np.ndarray, codes: np.ndarray, values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each (value, place): how many of a block are better, or as good with a smaller code than the place."""
    levels, level = np.unique(own, return_inverse=True)
    width = len(own) + 1
    keys = np.sort(level * width - codes)
    at = np.searchsorted(levels, values)
    same = levels[np.minimum(at, len(levels) - 1)] == values
    return len(keys) - np.searchsorted(keys, np.where(same, at * width - places, (at - 1) * width), side="right")


def _numbers(count: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)


def _types(nodes: DataFrame, queries: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {nodes.schema['id'].dataType.simpleString()}, score double"


def _node_blocks(nodes: DataFrame) -> DataFrame:
    """``ids, vectors``: up to ``NODE_BLOCK`` nodes a row, their unit vectors as the bytes of one matrix."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, NODE_BLOCK):
                part = batch.slice(at, NODE_BLOCK)
                unit = _unit_rows(part.column("embedding").to_numpy(zero_copy_only=False))
                ids = part.column("id")
                block = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([unit.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(block, ["ids", "vectors"])

    return nodes.mapInArrow(pack, f"ids array<{nodes.schema['id'].dataType.simpleString()}>, vectors binary")


def _query_blocks(queries: DataFrame, *more: str) -> DataFrame:
    """``asked``: a list of about ``QUERY_BLOCK`` queries a row; stored, so the planner knows its size."""
    queries = materialize(queries.select("query_id", "embedding", *more))
    blocks = max(-(-queries.count() // QUERY_BLOCK), 1)
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    return store(queries.groupBy(block.alias("block")).agg(F.collect_list(F.struct("query_id", "embedding", *more)).alias("asked")).drop("block"), "query-blocks")


def _met(nodes: DataFrame, blocks: DataFrame, schema: str, kernel, k: int = 1) -> DataFrame:
    """``kernel(ids, unit vectors, asked, unit queries, floors)`` over every block of nodes and every block of queries."""

    def run(batches):
        floors = _Floors(k)
        for batch in batches:
            for ids, vectors, asked in zip(*batch.columns, strict=True):
                questions = asked.values
                unit = _unit_rows(questions.field("embedding").to_numpy(zero_copy_only=False))
                matrix = np.frombuffer(vectors.as_buffer()).reshape(len(ids), -1)
                yield from kernel(ids.values, matrix, questions, unit, floors)

    return _node_blocks(nodes).crossJoin(blocks).mapInArrow(run, schema)


def vector_top_k(nodes: DataFrame, queries: DataFrame, k: int = 8) -> DataFrame:
    """(query_id, id, score, rank) by cosine similarity, exact.

    ``nodes`` is (id, embedding), ``queries`` is (query_id, embedding). Nodes are not
    shuffled: they are packed where they are, and every block of them meets every
    block of queries in one matrix product, of which each query keeps its k best.
    """
    nodes = nodes.select("id", "embedding").where("embedding IS NOT NULL")
    queries = queries.select("query_id", "embedding").where("embedding IS NOT NULL")

    def best(ids, matrix, questions, unit, floors):
        names = questions.field("query_id")
        yield _best_of(ids, np.round(matrix @ unit.T, 6), names, k, floors.of(names))

    return top_k_per_query(_met(nodes, _query_blocks(queries), _types(nodes, queries), best, k), k)


def vector_ranks(nodes: DataFrame, queries: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, id, rank): places of some nodes among all, by ``vector_top_k``'s order.

    ``wanted`` is (query_id, id), of a bounded number for each query. A block counts
    for each of them its nodes that come before; the counts are added up.
    """
    nodes = nodes.select("id", "embedding").where("embedding IS NOT NULL")
    queries = queries.select("query_id", "embedding").where("embedding IS NOT NULL")
    scored = wanted.join(nodes.withColumnRenamed("embedding", "_of"), "id").join(queries, "query_id")
    score = F.round(F.coalesce(cosine(F.col("_of"), F.col("embedding")), F.lit(0.0)), 6)
    lists = scored.groupBy("query_id").agg(F.collect_list(F.struct(score.alias("score"), "id")).alias("wanted"))

    def before(ids, matrix, questions, unit, _):
        scores = np.ascontiguousarray(np.round(matrix @ unit.T, 6).T)
        codes, places = _codes(ids), questions.field("wanted")
        counts = []
        for own, wanted in zip(scores, places, strict=True):
            values = wanted.values.field("score").to_numpy(zero_copy_only=False)
            counts.append(_ahead(own, codes, values, _code_places(ids, wanted.values.field("id"))))
        rows = pa.array(np.repeat(np.arange(len(places)), places.value_lengths().to_numpy(zero_copy_only=False)))
        columns = [questions.field("query_id").take(rows), places.flatten().field("id"), pa.array(np.concatenate(counts).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "n"])

    counted = _met(nodes, _query_blocks(queries.join(lists, "query_id"), "wanted"), _types(nodes, queries).replace("score double", "n long"), before)
    return counted.groupBy("query_id", "id").agg((F.sum("n") + 1).alias("rank"))


def score_ranks(scored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, id, rank): places of some rows of ``scored`` (query_id, id, score) among all of their query.

    ``wanted`` is (query_id, id), of a bounded number for each query; ids that were not
    scored have no place. Every scored row counts for the first wanted one that it does
    not come after, and the counts are added up: no query's rows meet in one task.
    """
    order = F.struct((-F.col("score")).alias("score"), F.col("id"))
    lists = scored.join(wanted, ["query_id", "id"], "left_semi").groupBy("query_id").agg(F.array_sort(F.collect_list(order)).alias("listed"))
    ahead = F.size(F.filter("listed", lambda w: (w["score"] < -F.col("score")) | ((w["score"] == -F.col("score")) & (w["id"] < F.col("id")))))
    placed = scored.join(lists, "query_id").select("query_id", F.size("listed").alias("n"), ahead.alias("at")).where("at < n")
    counted = placed.groupBy("query_id", "at").agg(F.count("*").alias("rows"))
    upto = counted.withColumn("rank", F.sum("rows").over(Window.partitionBy("query_id").orderBy("at")))
    spots = lists.select("query_id", F.posexplode("listed").alias("at", "w")).select("query_id", "at", F.col("w.id").alias("id"))
    return spots.join(upto, ["query_id", "at"]).select("query_id", "id", "rank")


def _grouped_scores(nodes: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        scores = np.round(_unit_rows(left["embedding"]) @ _unit_rows(right["embedding"]).T, 6)
        return _best_of(pa.array(left["id"], from_pandas=True), scores, pa.array(right["query_id"], from_pandas=True), k).to_pandas()

    return nodes.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(score, _types(nodes, queries))


@dataclass
class VectorIndex:
    """Vectors by the nearest of some centres; two stored tables that later batches read."""

    centres: DataFrame  # id, embedding, radius (largest angle to a member), n
    members: DataFrame  # centre, id, embedding


def build_vector_index(nodes: DataFrame, clusters: int = 256) -> VectorIndex:
    """Index of ``nodes`` (id, embedding). The centres are the vectors whose ids have the smallest MD5, so they are the same each time."""
    nodes = store(nodes.select("id", "embedding").where("embedding IS NOT NULL"), "vectors")
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    centres = store(nodes.orderBy(*order).limit(clusters), "centres")

    def nearest(ids, matrix, questions, unit, _):
        names = questions.field("query_id")
        turn = np.argsort(names.to_numpy(zero_copy_only=False), kind="stable")
        scores = np.round(matrix @ unit[turn].T, 6)
        best = scores.argmax(axis=1)
        columns = [ids, names.take(pa.array(turn[best])), pa.array(scores[np.arange(len(ids)), best])]
        yield pa.RecordBatch.from_arrays(columns, ["id", "centre", "score"])

    kind = nodes.schema["id"].dataType.simpleString()
    found = _met(nodes, _query_blocks(centres.withColumnRenamed("id", "query_id")), f"id {kind}, centre {kind}, score double", nearest)
    closest = found.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("score"), "centre")).alias("at"))
    placed = store(closest.select("id", F.col("at.centre").alias("centre"), (-F.col("at.score")).alias("score")), "placed")
    members = store(nodes.join(placed.select("id", "centre"), "id").select("centre", "id", "embedding"), "members")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("score") - 1e-6)))
    spread = placed.groupBy("centre").agg(F.max(angle).alias("radius"), F.count("*").alias("n")).withColumnRenamed("centre", "id")
    return VectorIndex(store(centres.join(spread, "id"), "centres"), members)


def indexed_top_k(index: VectorIndex, queries: DataFrame, k: int = 8, probes: int = 16, exact: bool = False) -> DataFrame:
    """(query_id, id, score, rank) from the ``probes`` clusters whose centres are nearest to each query.

    ``exact`` goes on to every cluster that may still hold a better one: by the triangle
    inequality no member is nearer than the centre's angle less the cluster's radius. A
    cluster is cut into slices of bounded size, so a hot one is no single group.
    """
    queries = materialize(queries.select("query_id", "embedding").where("embedding IS NOT NULL"))
    radius = index.centres.select(F.col("id").alias("centre"), "radius", "n")
    count = index.centres.count() if exact else probes
    near = vector_top_k(index.centres.select("id", "embedding"), queries, count).withColumnRenamed("id", "centre").join(radius, "centre")
    near = store(near.withColumn("slices", F.expr(f"(n + {GROUP_ROWS - 1}) div {GROUP_ROWS}")), "near-centres")
    cut = F.pmod(F.xxhash64("id"), F.expr(f"(n + {GROUP_ROWS - 1}) div {GROUP_ROWS}")).alias("slice")
    members = index.members.join(radius, "centre").select("centre", "id", "embedding", cut)

    def scored(pairs: DataFrame) -> DataFrame:
        share = F.pmod(F.xxhash64("query_id"), F.lit(shares)).alias("share")
        asked = pairs.select("query_id", "centre", F.explode(_numbers(F.col("slices"))).alias("slice"), share).join(queries, "query_id")
        spread = members.withColumn("share", F.explode(_numbers(F.lit(shares))))
        return _grouped_scores(spread, asked, ["centre", "slice", "share"], k)

    shares = max(-(-queries.count() // QUERY_BLOCK), 1)
    found = top_k_per_query(scored(near.where(F.col("rank") <= probes)), k)
    if not exact:
        return found
    found = materialize(found)
    bar = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("bar"))
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("score"))))
    reach = F.cos(F.greatest(F.lit(0.0), apart - F.col("radius")))
    rest = near.where(F.col("rank") > probes).join(bar, "query_id", "left").where(F.col("bar").isNull() | (reach >= F.col("bar") - 2e-3))
    return top_k_per_query(stack(found.select("query_id", "id", "score"), scored(rest)), k)


@dataclass
class KeywordIndex:
    """Documents by the words that queries hold, in blocks; two stored tables."""

    blocks: DataFrame  # block, query_ids, of, nos (word ``nos[i]`` is asked by query ``of[i]``), idf (by word)
    postings: DataFrame  # block, ids, lengths, at (a document's postings end there), nos, tfs
    shares: int  # blocks of queries
    mean_length: float
    types: str


def _asked_blocks(queries: DataFrame) -> tuple[DataFrame, int]:
    """(block, query_ids, words, of, nos): queries in blocks of bounded size, the words of a block listed once, in order."""
    held = queries.select("query_id", F.array_distinct(tokens(F.col("text"))).alias("words")).where(F.size("words") > 0)
    held = materialize(held)
    n, words = held.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    shares = max(-(-n // QUERY_BLOCK), -(-words // BLOCK_WORDS), 1)
    merged = held.groupBy("query_id").agg(F.flatten(F.collect_list("words")).alias("words"))
    listed = merged.groupBy(_share(shares)).agg(F.collect_list(F.struct("query_id", "words")).alias("asked"))

    def number(batches):
        for batch in batches:
            for block, asked in zip(*batch.columns, strict=True):
                words = asked.values.field("words")
                found = pc.unique(words.flatten()).sort()
                sizes = words.value_lengths().to_numpy(zero_copy_only=False)
                row = [block.as_py(), asked.values.field("query_id"), found, np.repeat(np.arange(len(sizes)), sizes), pc.index_in(words.flatten(), found)]
                yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), *[_one_list(c) for c in row[1:3]], *[_one_list(pa.array(c, pa.int32())) for c in row[3:]]], ["block", "query_ids", "words", "of", "nos"])

    kind = queries.schema["query_id"].dataType.simpleString()
    return store(listed.mapInArrow(number, f"block long, query_ids array<{kind}>, words array<string>, of array<int>, nos array<int>"), "asked-blocks"), shares


def _share(shares: int) -> Column:
    return F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("long").alias("block")


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int32()))


def _token_blocks(docs: DataFrame) -> DataFrame:
    """(ids, sizes, tokens): up to ``NODE_BLOCK`` documents a row and, but for a single document, ``BLOCK_WORDS`` words."""

    def pack(batches):
        for batch in batches:
            words, at = batch.column("words"), 0
            sizes = pc.fill_null(words.value_lengths(), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            while at < len(sizes):
                end = min(at + NODE_BLOCK, max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_WORDS, side="right")) - 1))
                columns = [batch.column("id").slice(at, end - at), pa.array(sizes[at:end], pa.int32()), words.slice(at, end - at).flatten()]
                yield pa.RecordBatch.from_arrays([_one_list(c) for c in columns], ["ids", "sizes", "tokens"])
                at = end

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", tokens(F.col("text")).alias("words")).mapInArrow(pack, f"ids array<{kind}>, sizes array<int>, tokens array<string>")


def keyword_index(docs: DataFrame, queries: DataFrame) -> KeywordIndex:
    """``docs`` (id, text) by the words of ``queries`` (query_id, text).

    A document's words are looked up in the list of a block of queries where the document
    is; what is shuffled is one row a document with the numbers and counts of those found.
    """
    length = F.regexp_count("text", F.lit(r"[\p{L}\p{N}_]+"))
    totals = docs.agg(F.count("*").alias("n"), F.avg(length).alias("mean_length")).first()
    blocks, shares = _asked_blocks(queries)
    kind = docs.schema["id"].dataType.simpleString()

    def look_up(batches):
        for batch in batches:
            for ids, sizes, words, block, listed in zip(*batch.columns, strict=True):
                no = pc.index_in(words.values, listed.values)
                held = no.is_valid().to_numpy(zero_copy_only=False)
                codes = _codes(ids.values)
                sizes, width = sizes.values.to_numpy(), len(listed)
                keys, tfs = np.unique(np.repeat(codes, sizes)[held] * width + no.drop_null().to_numpy(), return_counts=True)
                some, ends = np.unique(keys // width, return_counts=True)
                first = np.unique(codes, return_index=True)[1][some]
                columns = [pa.array(np.full(len(some), block.as_py())), ids.values.take(pa.array(first)), pa.array(sizes[first], pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, _lists(np.cumsum(ends), keys % width), _lists(np.cumsum(ends), tfs)], ["block", "id", "length", "nos", "tfs"])

    def pack(batches):
        for batch in batches:
            share = batch.column("block").to_numpy()
            for block in np.unique(share):
                part = batch.filter(pa.array(share == block))
                for at in range(0, part.num_rows, NODE_BLOCK):
                    ids, lengths, nos, tfs = part.slice(at, NODE_BLOCK).columns[1:]
                    # an id on several rows has several lists
                    rows = np.repeat(np.arange(len(ids)), pc.list_value_length(nos).to_numpy())
                    nos, tfs = nos.flatten(), tfs.flatten()
                    rows = np.repeat(rows, pc.list_value_length(nos).to_numpy())
                    nos, tfs = nos.flatten().to_numpy(), tfs.flatten().to_numpy()
                    width = int(nos.max()) + 1
                    keys, back = np.unique(rows * width + nos, return_inverse=True)
                    counts = np.cumsum(np.bincount(keys // width, minlength=len(ids)))
                    columns = [ids, lengths, *[pa.array(c, pa.int32()) for c in (counts, keys % width, np.bincount(back, tfs).astype(np.int64))]]
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *[_one_list(c) for c in columns]], ["block", "ids", "lengths", "at", "nos", "tfs"])

    found = _token_blocks(docs).crossJoin(blocks.select("block", "words")).mapInArrow(look_up, f"block long, id {kind}, length int, nos array<int>, tfs array<int>")
    merged = found.groupBy("block", "id").agg(F.first("length").alias("length"), F.collect_list("nos").alias("nos"), F.collect_list("tfs").alias("tfs"))
    postings = store(merged.mapInArrow(pack, f"block long, ids array<{kind}>, lengths array<int>, at array<int>, nos array<int>, tfs array<int>"), "postings")

    def count(batches):
        for batch in batches:
            for block, nos in zip(*batch.columns, strict=True):
                no, df = np.unique(nos.values.to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(no), block.as_py())), pa.array(no, pa.int32()), pa.array(df, pa.int64())], ["block", "no", "df"])

    df = postings.select("block", "nos").mapInArrow(count, "block long, no int, df long").groupBy("block", "no").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.lit(totals["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    listed = df.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("no", idf.alias("idf")))).alias("known"))
    weighted = store(blocks.drop("words").join(listed, "block"), "asked-blocks")
    types = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {kind}"
    return KeywordIndex(weighted, postings, shares, totals["mean_length"] or 1.0, types)


def _keyword_met(index: KeywordIndex, schema: str, kernel, wanted: DataFrame | None = None, k: int = 1, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``kernel(ids, scores, query_ids, floors, wanted)`` over every block of documents and its queries; minus infinity where they share no word.

    ``wanted`` is (query_id, id, ...), of a bounded number for each query; a block has the list of its queries.
    """
    blocks, mean_length, width = index.blocks, index.mean_length, WORD_SLICE
    if wanted is not None:
        of_block = wanted.groupBy(_share(index.shares)).agg(F.collect_list(F.struct(*wanted.columns)).alias("wanted"))
        blocks = store(blocks.join(of_block, "block"), "wanted-blocks")

    def run(batches):
        floors = _Floors(k)
        for batch in batches:
            for ids, lengths, at, nos, tfs, names, of, asked, known, *more in zip(*batch.columns, strict=True):
                ends = at.values.to_numpy()
                rows = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                nos, tfs = nos.values.to_numpy(), tfs.values.to_numpy().astype(np.float64)
                weight = tfs * (k1 + 1) / (tfs + k1 * (1 - b + b * lengths.values.to_numpy()[rows] / mean_length))
                columns, asked = of.values.to_numpy(), asked.values.to_numpy()
                top = max(int(asked.max()), int(nos.max())) + 1
                idf = np.zeros(top)
                idf[known.values.field("no").to_numpy()] = known.values.field("idf").to_numpy()
                scores = np.zeros((len(ends), len(names)))
                for low in range(0, top, width):
                    held, meant = (nos >= low) & (nos < low + width), (asked >= low) & (asked < low + width)
                    left, right = np.zeros((len(ends), width)), np.zeros((width, len(names)))
                    left[rows[held], nos[held] - low] = weight[held]
                    np.add.at(right, (asked[meant] - low, columns[meant]), idf[asked[meant]])
                    scores += left @ right
                scores = np.where(scores > 0, np.round(scores, 6), -np.inf)
                yield from kernel(ids.values, scores, names.values, floors, *[m.values for m in more])

    listed = ["ids", "lengths", "at", "nos", "tfs", "query_ids", "of", "asked", "known", *(["wanted"] if wanted is not None else [])]
    joined = index.postings.join(blocks.withColumnRenamed("nos", "asked"), "block").select(*listed)
    return joined.mapInArrow(run, schema)


def keyword_scores(docs: DataFrame, queries: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, id, score): BM25 of ``docs`` (id, text) for ``queries`` (query_id, text), a row for every pair that shares a word."""
    index = keyword_index(docs, queries)

    def every(ids, scores, names, _):
        at, of = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), ids.take(pa.array(at)), pa.array(scores[at, of])], ["query_id", "id", "score"])

    return _keyword_met(index, f"{index.types}, score double", every, k1=k1, b=b)


def keyword_top_k(index: KeywordIndex, k: int = 8) -> DataFrame:
    """(query_id, id, score, rank): the k best of each query. No row is made for a pair that is not near the best of its block."""

    def best(ids, scores, names, floors):
        yield _best_of(ids, scores, names, k, floors.of(names))

    return top_k_per_query(_keyword_met(index, f"{index.types}, score double", best, k=k), k)


def keyword_search(docs: DataFrame, queries: DataFrame, k: int = 8) -> DataFrame:
    return keyword_top_k(keyword_index(docs, queries), k)


def keyword_ranks(index: KeywordIndex, wanted: DataFrame) -> DataFrame:
    """(query_id, id, rank): places of some documents among all that share a word with their query; others have none.

    ``wanted`` is (query_id, id), of a bounded number for each query. A block counts for
    each of them its documents that come before; the counts are added up.
    """

    def own(ids, scores, names, _, asked):
        at, of = pc.index_in(asked.field("id"), ids), pc.index_in(asked.field("query_id"), names)
        here = pc.and_(at.is_valid(), of.is_valid())
        at, of = at.filter(here).to_numpy(), of.filter(here).to_numpy()
        found = scores[at, of] > -np.inf
        at, of = at[found], of[found]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), ids.take(pa.array(at)), pa.array(scores[at, of])], ["query_id", "id", "score"])

    def before(ids, scores, names, _, asked):
        codes = _codes(ids)
        of = pc.index_in(asked.field("query_id"), names).to_numpy()
        values = asked.field("score").to_numpy(zero_copy_only=False)
        places = _code_places(ids, asked.field("id"))
        counts = np.zeros(len(of), np.int64)
        for column, column_scores in enumerate(np.ascontiguousarray(scores.T)):
            mine = np.flatnonzero(of == column)
            if len(mine):
                counts[mine] = _ahead(column_scores, codes, values[mine], places[mine])
        yield pa.RecordBatch.from_arrays([asked.field("query_id"), asked.field("id"), pa.array(counts)], ["query_id", "id", "n"])

    valued = materialize(_keyword_met(index, f"{index.types}, score double", own, wanted.select("query_id", "id").where("id IS NOT NULL AND query_id IS NOT NULL")))
    return _keyword_met(index, f"{index.types}, n long", before, valued).groupBy("query_id", "id").agg((F.sum("n") + 1).alias("rank"))


def edge_text(edges: DataFrame) -> DataFrame:
    """(id, text): the searchable text of edges, their expression."""
    key = F.concat_ws("|", "src", "dst", "relationship")
    return edges.where(F.col("properties")["expression"].isNotNull()).select(key.alias("id"), F.col("properties")["expression"].alias("text"))


def fuse_ranks(*rankings: DataFrame, k: int = 8, constant: int = FUSION) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists (query_id, id, rank).

    The lists are stacked and summed, which is their full outer join without one.
    """
    stacked = stack(*[ranking.select("query_id", "id", "rank") for ranking in rankings])
    scored = stacked.groupBy("query_id", "id").agg(F.round(F.sum(1.0 / (constant + F.col("rank"))), 9).alias("score"))
    return top_k_per_query(scored, k)


def proof_depth(k: int, lists: int = 2, constant: int = FUSION) -> int:
    """How deep lists must be read so that no id below that in all of them can enter the fused top k.

    k ids have at least ``1 / (constant + k)``, from one list alone. An id that no list has
    shown down to this depth has less than ``lists / (constant + depth)``, which is as much.
    """
    return lists * (constant + k) - constant


def hybrid_search(nodes: DataFrame, queries: DataFrame, k: int = 8, near: DataFrame | None = None, constant: int = FUSION) -> DataFrame:
    """Whole vector and keyword rankings fused; nodes need (id, text, embedding), queries (query_id, text, embedding).

    A threshold algorithm: both lists are read as deep as the proof needs. An id that is
    in one of them only may still have a place further down in the other, at most the
    share of the next place; where that can lift it into the top k, its place among all
    rows is counted. ``near`` is the vector list down to ``proof_depth(k)``, if there is one.
    """
    depth = proof_depth(k, constant=constant)
    nodes, queries = materialize(nodes.select("id", "text", "embedding")), materialize(queries.select("query_id", "text", "embedding"))
    near = materialize(vector_top_k(nodes, queries, depth)) if near is None else near
    index = keyword_index(nodes, queries)
    words = materialize(keyword_top_k(index, depth))
    place = lambda rows, own, other: rows.select("query_id", "id", F.col("rank").cast("long").alias(own), F.lit(None).cast("long").alias(other))
    seen = stack(place(near, "near", "word"), place(words, "word", "near")).groupBy("query_id", "id").agg(F.max("near").alias("near"), F.max("word").alias("word"))
    share = lambda rank: F.coalesce(1.0 / (constant + rank), F.lit(0.0))
    known = seen.withColumn("_known", share(F.col("near")) + share(F.col("word")))
    missing = F.col("near").isNull() | F.col("word").isNull()
    bar = top_k_per_query(known, k, score="_known").groupBy("query_id").agg(F.when(F.count("*") == k, F.min("_known")).alias("_bar"))
    may = F.col("_known") + F.when(missing, 1.0 / (constant + depth + 1)).otherwise(0.0)
    able = materialize(known.join(bar, "query_id").where(F.coalesce(may >= F.col("_bar") - 1e-8, F.lit(True))).drop("_bar", "_known"))
    far = vector_ranks(nodes, queries, able.where("near IS NULL").select("query_id", "id")).select("query_id", "id", F.col("rank").alias("_near"))
    low = keyword_ranks(index, able.where("word IS NULL").select("query_id", "id")).select("query_id", "id", F.col("rank").alias("_word"))
    placed = able.join(far, ["query_id", "id"], "left").join(low, ["query_id", "id"], "left")
    score = F.round(share(F.coalesce("near", "_near")) + share(F.coalesce("word", "_word")), 9)
    return top_k_per_query(placed.select("query_id", "id", score.alias("score")), k)


def filtered_search(nodes: DataFrame, queries: DataFrame, k: int = 8) -> DataFrame:
    """Search among active entities only; the filter comes before any scoring."""
    return hybrid_search(nodes.where("is_active"), queries, k)


def cosine(left: Column, right: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return dot(left, right) / F.nullif(F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)), F.lit(0.0))


def rerank(hits: DataFrame, nodes: DataFrame, queries: DataFrame, cache: DataFrame, k: int = 8, weight: float = 0.1) -> DataFrame:
    """Order hits by cosine plus closeness to the query's other hits in the graph.

    Hits are k per query, so pairs of hits of one query are bounded by k squared.
    """
    vectors = nodes.select("id", F.col("embedding").alias("node_vector"))
    asked = queries.select("query_id", F.col("embedding").alias("query_vector"))
    base = hits.select("query_id", "id").join(vectors, "id").join(asked, "query_id")
    base = base.select("query_id", "id", F.coalesce(cosine(F.col("node_vector"), F.col("query_vector")), F.lit(0.0)).alias("cosine"))
    ends = hits.select("query_id", F.col("id").alias("tgt_node_id"))
    near = (
        hits.select("query_id", F.col("id").alias("src_node_id"))
        .join(cache.select("src_node_id", "tgt_node_id", "min_hops"), "src_node_id")
        .join(ends, ["query_id", "tgt_node_id"], "left_semi")
        .select("query_id", F.explode(F.array("src_node_id", "tgt_node_id")).alias("id"), (1.0 / F.col("min_hops")).alias("closeness"))
        .groupBy("query_id", "id").agg(F.sum("closeness").alias("closeness"))
    )
    score = F.round(F.col("cosine") + weight * F.coalesce("closeness", F.lit(0.0)), 6)
    return top_k_per_query(base.join(near, ["query_id", "id"], "left").select("query_id", "id", score.alias("score")), k)


def _deletions(text: Column, depth: int) -> Column:
    """The text and every text made of it by leaving out up to ``depth`` characters."""
    found = F.array(text)
    for _ in range(depth):
        shorter = F.flatten(
            F.transform(
                F.filter(found, lambda w: F.length(w) > 0),
                lambda w: F.transform(
                    F.sequence(F.lit(1), F.length(w)),
                    lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)),
                ),
            )
        )
        found = F.array_distinct(F.concat(found, shorter))
    return found


def fuzzy_match(names: DataFrame, typed: DataFrame, distance: int = 1) -> DataFrame:
    """(typed, name, distance): names within an edit distance of what was typed, exact.

    Two texts within n edits share a text made by at most n deletions from each, so
    an equi-join on those finds every pair and almost no other; no block of names is
    compared with itself. Only hashes are shuffled, and the distance is checked.
    The planner does not know how many texts a name gives and would send a large
    side through the driver, so both sides are asked to be sorted and merged.
    """
    left = names.select("name").distinct().select("name", F.explode_outer(_deletions(F.col("name"), distance)).alias("v"))
    right = typed.select("typed").distinct().select("typed", F.explode_outer(_deletions(F.col("typed"), distance)).alias("v"))
    pairs = (
        left.select("name", F.xxhash64("v").alias("v"))
        .join(right.select("typed", F.xxhash64("v").alias("v")).hint("merge"), "v")
        .select("typed", "name").distinct()
    )
    return pairs.withColumn("distance", F.levenshtein("typed", "name", distance)).where("distance >= 0")


def suggest_names(nodes: DataFrame, edges: DataFrame, typed: DataFrame, k: int = 8) -> DataFrame:
    """(typed, entity_name, in_degree, rank): names beginning with what was typed, most used first.

    Names are cut at the lengths that were typed and joined by equality.
    """
    lengths = typed.agg(F.collect_set(F.length("typed")).alias("lengths")).scalar()
    degree = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))
    named = nodes.select("id", "entity_name").join(degree, "id", "left").select("entity_name", F.coalesce("in_degree", F.lit(0)).alias("in_degree"))
    cut = named.withColumn("n", F.explode(F.array_distinct(lengths))).where(F.col("n") <= F.length("entity_name"))
    prefixed = cut.select("entity_name", "in_degree", F.lower(F.substr("entity_name", F.lit(1), F.col("n"))).alias("typed"))
    asked = typed.select(F.lower("typed").alias("typed")).distinct()
    matches = prefixed.join(asked, "typed", "left_semi")
    return top_k_per_query(matches, k, "typed", "in_degree", "entity_name")


def grounded_context(hits: DataFrame, nodes: DataFrame, edges: DataFrame, cache: DataFrame, facts_per_hit: int | None = None) -> DataFrame:
    """(query_id, context, citations): bulleted facts about each question's hits.

    Facts are direct edges and cached paths that leave a hit, the nearest first. A caller whose prompt has
    room for few names how many of each list a hit may give; without a number all are given.
    """
    named = hits.join(nodes.select("id", "entity_type", "entity_name"), "id")
    entity = named.select(
        "query_id", "rank", F.struct(F.lit(0).alias("kind"), F.lit(0).alias("hops"), F.lit("").alias("end"), F.lit("").alias("label")).alias("place"),
        F.concat_ws(" ", "entity_type", "entity_name").alias("fact"), F.col("id").alias("citation"),
    )
    wanted = hits.select("id").distinct()

    def nearest(rows: DataFrame) -> DataFrame:
        if facts_per_hit is None:
            return rows
        return rows.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("place"))).where(F.col("n") <= facts_per_hit)

    def place(kind: int, hops: Column, end: str, label: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), hops.cast("int").alias("hops"), F.col(end).alias("end"), label.alias("label")).alias("place")

    out = nearest(
        edges.select(F.col("src").alias("id"), "dst", "relationship").distinct().join(wanted, "id", "left_semi")
        .withColumn("place", place(1, F.lit(1), "dst", F.col("relationship")))
    )
    direct = hits.select("query_id", "rank", "id").join(out, "id").select(
        "query_id", "rank", "place", F.concat_ws(" ", "id", "relationship", "dst").alias("fact"), F.col("id").alias("citation")
    )
    far = nearest(
        cache.select(F.col("src_node_id").alias("id"), "tgt_node_id", "min_hops", "path").where("min_hops > 1").join(wanted, "id", "left_semi")
        .withColumn("place", place(2, F.col("min_hops"), "tgt_node_id", F.lit("")))
    )
    paths = hits.select("query_id", "rank", "id").join(far, "id").select(
        "query_id", "rank", "place",
        F.concat(F.array_join("path", " > "), F.lit(" in "), F.col("min_hops").cast("string"), F.lit(" hops")).alias("fact"),
        F.col("id").alias("citation"),
    )
    facts = stack(entity, direct, paths)
    listed = facts.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "place", "fact"))).alias("facts"), F.array_sort(F.collect_set("citation")).alias("citations")
    )
    bullets = F.concat(F.lit("- "), F.array_join(F.transform("facts", lambda f: f["fact"]), "\n- "))
    return listed.select("query_id", bullets.alias("context"), "citations")


def insufficient_evidence(queries: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """(query_id, best, insufficient): questions without a hit at or above the threshold."""
    best = scored.groupBy("query_id").agg(F.max("score").alias("best"))
    flag = F.coalesce(F.col("best") < threshold, F.lit(True))
    return queries.select("query_id").distinct().join(best, "query_id", "left").select("query_id", "best", flag.alias("insufficient"))
