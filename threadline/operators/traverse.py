"""Walking the graph.

Bounded walks (``reach``) are one lazy plan: every step reads
the step before once, so the plan grows linearly with the number of hops and the
exchange of the edges is shared by all steps. A state row exists once per
(root, node), so no step emits more rows than roots times edges, however many
walks there are. Unbounded or pair-producing walks run level by level and cut the
lineage after each level with a reliable checkpoint; only an emptiness test
reaches the driver. No side is broadcast by hint: the adaptive planner decides
from measured sizes and splits skewed join partitions of hub nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.session import materialize, stack, store

MAX_HOPS = 5
#: Roots walked by pairs when no limit of hops is given, and roots a row of bits holds, whole words of 64.
FEW_ROOTS, _ROOTS_A_ROW = 64, 512
#: Edges that every task may hold to walk from many roots.
EDGES_SHARED = 1_000_000
#: Edges left at which strong components are found in one task.
EDGES_A_TASK = 200_000
#: Ends of a block when pairs of ends are given out, and pairs that one task gives.
_ENDS_A_BLOCK, _PAIRS_A_TASK = 512, 4_000_000


def links(edges: DataFrame, relationships: Sequence[str] | None = None, orientation: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct (src, dst) along the data flow.

    ``orientation`` names relationships stored against the flow as ``reverse``.
    """
    if relationships:
        edges = edges.where(F.col("relationship").isin(*relationships))
    turned = [name for name, way in (orientation or {}).items() if way == "reverse"]
    if turned:
        against = F.col("relationship").isin(*turned)
        edges = edges.select(
            F.when(against, F.col("dst")).otherwise(F.col("src")).alias("src"),
            F.when(against, F.col("src")).otherwise(F.col("dst")).alias("dst"),
        )
    return edges.select("src", "dst").distinct()


def reverse(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def reach(pairs: DataFrame, starts: DataFrame, hops: int = MAX_HOPS) -> DataFrame:
    """(root, node, depth): every depth up to ``hops`` at which a walk from root ends in node.

    ``starts`` is (root, node). The depths of a node are the bits of one number, so
    a step shifts them and an aggregate ors them.
    """
    if not 1 <= hops <= 62:
        raise ValueError("hops must be between 1 and 62")
    begin = starts.select("root", "node", F.lit(1).cast("long").alias("depths")).distinct()
    out = pairs.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    state = begin
    for _ in range(hops):
        step = state.join(out, "node").select("root", F.col("next").alias("node"), F.shiftleft("depths", 1).alias("depths"))
        state = stack(begin, step).groupBy("root", "node").agg(F.bit_or("depths").alias("depths"))
    seen = F.filter(F.sequence(F.lit(1), F.lit(hops)), lambda d: F.getbit("depths", d) == 1)
    return state.select("root", "node", F.explode(seen).alias("depth"))


def downstream(edges: DataFrame, roots: DataFrame, relationship: str | None = None, hops: int = MAX_HOPS) -> DataFrame:
    """(root, node, depth) along one relationship; ``roots`` has a column root."""
    pairs = links(edges, [relationship] if relationship else None)
    return reach(pairs, roots.select("root", F.col("root").alias("node")), hops)


def upstream_walks(edges: DataFrame, roots: DataFrame, hops: int = 10) -> DataFrame:
    """(root, src, dst, relationship, depth, n_walks): edges walked backwards from root.

    ``n_walks`` is how many walks use the edge at that depth, so a bag of walks is
    told without listing it. A level holds the walks of one length by their ends and
    is written once; a step shuffles the last level and none before it.
    """
    back = edges.select(F.col("dst").alias("node"), F.col("src").alias("next"))
    level = roots.select("root", F.col("root").alias("node"), F.lit(1).cast("long").alias("n_walks"))
    if hops > 1:
        level = store(level.groupBy("root", "node").agg(F.sum("n_walks").alias("n_walks")), "walks")
    levels = [level]
    for _ in range(hops - 1):
        step = levels[-1].join(back, "node").groupBy("root", F.col("next").alias("node")).agg(F.sum("n_walks").alias("n_walks"))
        levels.append(store(step, "walks"))
    used = stack(*[rows.select("root", F.col("node").alias("dst"), F.lit(d + 1).alias("depth"), "n_walks") for d, rows in enumerate(levels)])
    return edges.select("src", "dst", "relationship").join(used, "dst").select("root", "src", "dst", "relationship", "depth", "n_walks")


def order_by_depth(rows: DataFrame, *ties: str) -> DataFrame:
    return rows.orderBy("depth", *ties)


def with_node_attributes(rows: DataFrame, nodes: DataFrame, column: str, prefix: str, keep_missing: bool = True) -> DataFrame:
    """Name and type of the node a column points at."""
    names = nodes.select(
        F.col("id").alias(column),
        F.col("entity_name").alias(f"{prefix}_name"),
        F.col("entity_type").alias(f"{prefix}_type"),
    )
    return rows.join(names, column, "left" if keep_missing else "inner")


def lineage_edges(pairs_with_kind: DataFrame, starts: DataFrame, hops: int, direction: str) -> DataFrame:
    """(root, direction, src, dst, relationship, depth): edges within ``hops`` of root.

    ``pairs_with_kind`` is (src, dst, relationship) along the flow; depth is the
    smallest number of hops at which the edge is used.
    """
    flow = pairs_with_kind.select("src", "dst").distinct()
    near, far = ("src", "dst") if direction == "downstream" else ("dst", "src")
    walked = flow if direction == "downstream" else reverse(flow)
    begin = starts.select("root", "node", F.lit(0).alias("depth"))
    if hops > 1:
        inner = reach(walked, starts, hops - 1)
        begin = stack(begin, inner)
    closest = begin.groupBy("root", "node").agg(F.min("depth").alias("depth"))
    return (
        pairs_with_kind.join(closest, pairs_with_kind[near] == closest["node"])
        .select("root", F.lit(direction).alias("direction"), "src", "dst", "relationship", (F.col("depth") + 1).alias("depth"))
    )


def oriented(edges: DataFrame, orientation: Mapping[str, str] | None = None) -> DataFrame:
    """(src, dst, relationship) along the data flow."""
    turned = [name for name, way in (orientation or {}).items() if way == "reverse"]
    against = F.col("relationship").isin(*turned) if turned else F.lit(False)
    return edges.select(
        F.when(against, F.col("dst")).otherwise(F.col("src")).alias("src"),
        F.when(against, F.col("src")).otherwise(F.col("dst")).alias("dst"),
        "relationship",
    ).distinct()


def lineage(
    edges: DataFrame,
    nodes: DataFrame,
    roots: DataFrame,
    direction: str = "both",
    hops: int = MAX_HOPS,
    include_transformations: bool = True,
    orientation: Mapping[str, str] | None = None,
) -> DataFrame:
    """Edges of the lineage subgraph of each root, by direction.

    Without transformations, flows through them become one edge between the
    entities on either side, before hops are counted.
    """
    flow = oriented(edges, orientation)
    if not include_transformations:
        kept = nodes.where(F.col("entity_type") != "transformation").select("id")
        flow = contract(flow.select("src", "dst"), kept).withColumn("relationship", F.lit("flows_to"))
    starts = roots.select("root", F.col("root").alias("node"))
    ways = ["upstream", "downstream"] if direction == "both" else [direction]
    found = [lineage_edges(flow, starts, hops, way) for way in ways]
    return found[0] if len(found) == 1 else lineage_both(*found)


def lineage_both(upstream: DataFrame, downstream_rows: DataFrame) -> DataFrame:
    return stack(upstream, downstream_rows)


def lineage_nodes(found_edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(root, id, entity_type, entity_name): the nodes on the edges of a subgraph."""
    ends = found_edges.select("root", F.explode(F.array("src", "dst")).alias("id")).distinct()
    return ends.join(nodes.select("id", "entity_type", "entity_name"), "id")


def contract(pairs: DataFrame, kept: DataFrame, doublings: int = 3) -> DataFrame:
    """(src, dst) between kept nodes that a walk through only other nodes joins.

    Other nodes on a cycle reach the same ends and become one node first, however long
    the cycle. Walks among what is left are composed with themselves a few times, so
    that one step covers up to ``2 ** doublings`` edges; then each kept node walks
    in such steps until it meets no new node. Composing alone would join all pairs
    with all pairs, stepping alone would need a round per edge of the longest chain.
    """
    marks = kept.select("id", F.lit(True).alias("is_kept")).distinct()

    def marked(rows: DataFrame, column: str) -> DataFrame:
        named = marks.select(F.col("id").alias(column), F.col("is_kept").alias(f"{column}_kept"))
        return rows.join(named, column, "left").withColumn(f"{column}_kept", F.coalesce(f"{column}_kept", F.lit(False)))

    edges = materialize(marked(marked(pairs.select("src", "dst").distinct(), "src"), "dst"))
    inner = edges.where("NOT src_kept AND NOT dst_kept").select("src", "dst")
    component = materialize(short_components(inner))

    def joined(rows: DataFrame, column: str) -> DataFrame:
        named = component.select(F.col("id").alias(column), "component")
        return rows.join(named, column, "left").withColumn(column, F.coalesce("component", column)).drop("component")

    left = materialize(joined(edges.where("NOT src_kept AND dst_kept").select("src", "dst"), "src").select(F.col("src").alias("at"), "dst").distinct())
    steps = materialize(joined(joined(inner, "src"), "dst").where("src <> dst").select("src", "dst").distinct())
    # a node that nothing leaves joins no kept nodes, and would meet every walk composed through a cycle
    steps = materialize(steps.join(stack(steps.select(F.col("src").alias("dst")), left.select(F.col("at").alias("dst"))).distinct(), "dst", "left_semi").select("src", "dst"))
    size = steps.count()
    for _ in range(doublings):
        ahead = steps.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
        steps = materialize(stack(steps, steps.join(ahead, "dst").select("src", F.col("next").alias("dst"))).distinct())
        grown = steps.count()
        if grown == size:
            break
        size = grown
    ahead = steps.select(F.col("src").alias("at"), F.col("dst").alias("next"))
    entered = joined(edges.where("src_kept AND NOT dst_kept").select("src", "dst"), "dst")
    frontier = materialize(entered.select(F.col("src").alias("root"), F.col("dst").alias("at")).distinct())
    visited = [frontier]
    while not frontier.isEmpty():
        step = frontier.join(ahead, "at").select("root", F.col("next").alias("at")).distinct()
        if len(visited) == 8:
            tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            visited = [materialize(stack(*visited).repartition(tasks, "root", "at"))]
        frontier = materialize(step.join(stack(*visited), ["root", "at"], "left_anti"))
        visited.append(frontier)
    # an edge between kept nodes is met at its own source
    direct = edges.where("src_kept AND dst_kept").select("src", "dst")
    met = stack(*visited, direct.select(F.col("src").alias("root"), F.col("src").alias("at")).distinct())
    return _ends_joined(met, stack(left, direct.select(F.col("src").alias("at"), "dst")))


def _ends_joined(met: DataFrame, left: DataFrame) -> DataFrame:
    """(src, dst), each once: roots and the ends they share an ``at`` with; rows of ``met`` (root, at) and ``left`` (at, dst) do not repeat.

    The result may be far larger than both inputs, so it is not shuffled. A dst has one main ``at``, that
    which most roots meet, and pairs through it cannot repeat: blocks of roots and of ends are dealt out, and
    a task gives their pairs. Pairs through any other ``at`` are told apart row by row, without roots that meet
    the main one as well.
    """
    met = store(met, "ends-met")
    known = left.join(met.groupBy("at").agg(F.count("*").alias("n_roots")), "at")
    known = store(known, "ends-left")
    main = known.groupBy("dst").agg(F.max(F.struct("n_roots", "at"))["at"].alias("main"))
    ways = store(known.join(main, "dst").select("at", "dst", "main", "n_roots"), "ends-left")
    firsts = ways.where("at = main")
    sizes = store(firsts.groupBy("at").agg(F.max("n_roots").alias("n_roots"), F.count("*").alias("n_ends")), "ends-sizes")
    block = lambda column, n: F.pmod(F.xxhash64(column), F.ceil(F.col(n) / _ENDS_A_BLOCK)).alias("block")
    roots = met.join(sizes, "at").groupBy("at", block("root", "n_roots")).agg(F.collect_list("root").alias("roots"))
    ends = firsts.drop("n_roots").join(sizes, "at").groupBy("at", block("dst", "n_ends")).agg(F.collect_list("dst").alias("ends"))
    total = sizes.agg(F.sum(F.col("n_roots").cast("double") * F.col("n_ends"))).first()[0] or 0
    tasks = max(met.sparkSession.sparkContext.defaultParallelism, math.ceil(total / _PAIRS_A_TASK))
    blocks = roots.select("at", "roots").join(ends.select("at", "ends"), "at").select("roots", "ends").repartition(tasks)
    through_main = blocks.select(F.explode("roots").alias("src"), "ends").select("src", F.explode("ends").alias("dst"))
    rest = met.join(ways.where("at <> main").select("at", "dst", "main"), "at").select("root", "dst", "main").distinct()
    rest = rest.join(met.select("root", F.col("at").alias("main")), ["root", "main"], "left_anti")
    return stack(through_main, rest.select(F.col("root").alias("src"), "dst"))


class _Visited:
    """Rows met so far, as one table: the latest levels and those before them folded together."""

    def __init__(self, first: DataFrame | None = None, every: int = 8):
        self.parts, self.every = [] if first is None else [first], every

    def add(self, rows: DataFrame) -> None:
        self.parts.append(rows)
        if len(self.parts) > self.every:
            tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            self.parts = [materialize(stack(*self.parts).repartition(tasks))]

    def new(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.join(stack(*self.parts).select(*keys), keys, "left_anti") if self.parts else rows


def shortest_pairs(
    pairs: DataFrame,
    sources: DataFrame | None = None,
    hops: int | None = MAX_HOPS,
    with_path: bool = True,
    until: DataFrame | None = None,
) -> DataFrame:
    """(src, tgt, min_hops[, path]) for every pair a walk of at most ``hops`` joins.

    Level by level; a pair is kept at the first level it appears on, with the
    smallest path of that level. A path of n hops is the smallest path of n - 1
    hops plus a node, so one path per pair and level is enough. A source that has met
    an id of ``until`` walks no further.
    """
    out = materialize(pairs.where("src <> dst").select(F.col("src").alias("node"), F.col("dst").alias("next")))
    begin = sources.select(F.col("id").alias("src")) if sources is not None else out.select(F.col("node").alias("src"))
    frontier = begin.distinct().select("src", F.col("src").alias("node"), F.array("src").alias("path"))
    if not with_path:
        frontier = frontier.drop("path")
    columns = ["src", "node", "min_hops"] + (["path"] if with_path else [])
    visited, found, hop = _Visited(), [], 0
    while hops is None or hop < hops:
        hop += 1
        step = frontier.join(out, "node").where(F.col("next") != F.col("src"))
        if with_path:
            step = step.select("src", F.col("next").alias("node"), F.concat("path", F.array("next")).alias("path"))
            step = step.groupBy("src", "node").agg(F.min("path").alias("path"))
        else:
            step = step.select("src", F.col("next").alias("node")).distinct()
        frontier = materialize(visited.new(step, ["src", "node"]).withColumn("min_hops", F.lit(hop)).select(*columns))
        if (hops is None or hop < hops) and frontier.isEmpty():
            break
        visited.add(frontier.select("src", "node"))
        found.append(frontier)
        if until is not None:
            met = frontier.join(until.select(F.col("id").alias("node")), "node", "left_semi").select("src").distinct()
            frontier = frontier.join(met, "src", "left_anti")
    empty = frontier if not found else stack(*found)
    return empty.withColumnRenamed("node", "tgt")


def distances(pairs: DataFrame, starts: DataFrame, hops: int | None = None, stride: int = 8) -> DataFrame:
    """(root, node, hops): fewest edges from a root's start nodes, which themselves have 0.

    ``starts`` is (root, node). Each round walks ``stride`` edges in one plan from the
    nodes found last, so a chain of n edges takes n / stride rounds.
    """
    pairs = materialize(pairs.select("src", "dst").distinct())
    frontier = materialize(starts.select("root", "node").distinct())
    visited, found, walked = _Visited(frontier), [frontier.withColumn("hops", F.lit(0))], 0
    while hops is None or walked < hops:
        far = stride if hops is None else min(stride, hops - walked)
        nearest = reach(pairs, frontier, far).groupBy("root", "node").agg(F.min("depth").alias("depth"))
        new = materialize(visited.new(nearest, ["root", "node"]))
        found.append(new.select("root", "node", (F.col("depth") + walked).alias("hops")))
        visited.add(new.select("root", "node"))
        frontier = new.where(F.col("depth") == far).select("root", "node")
        walked += far
        if frontier.isEmpty():
            break
    return stack(*found)


def distances_of_many(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, node, hops): as ``distances`` of many roots that each start at themselves.

    Up to ``EDGES_SHARED`` edges are shared with all tasks, which walk from some roots each. Where there are more, roots
    are numbered, and a row holds one bit for each of ``_ROOTS_A_ROW`` of them, so a level shuffles
    rows of nodes and groups of roots; pairs are told apart only where they are given out.
    """
    words = [f"w{i}" for i in range(_ROOTS_A_ROW // 64)]
    some = [F.bit_or(w).alias(w) for w in words]
    numbered = store(roots.select("root").distinct().withColumn("n", F.monotonically_increasing_id()), "roots")
    ahead = store(pairs.select(F.col("src").alias("node"), F.col("dst").alias("next")).distinct(), "edges")
    if ahead.count() <= EDGES_SHARED:
        return _distances_in_tasks(ahead, numbered.select("root"))
    place = F.col("n") % _ROOTS_A_ROW
    bits = [F.when(F.floor(place / 64) == i, F.expr("shiftleft(1L, CAST(n % 64 AS INT))")).otherwise(F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)]
    frontier = store(numbered.select(F.col("root").alias("node"), F.floor(F.col("n") / _ROOTS_A_ROW).alias("block"), F.lit(0).alias("hops"), *bits), "level")
    levels, seen, hops = [frontier], [frontier.drop("hops")], 0
    while True:
        hops += 1
        step = frontier.join(ahead, "node").groupBy(F.col("next").alias("node"), "block").agg(*some)
        known = stack(*seen).groupBy("node", "block").agg(*[F.bit_or(w).alias(f"known_{w}") for w in words])
        fresh = [F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"known_{w}", F.lit(0).cast("long")))).alias(w) for w in words]
        new = step.join(known, ["node", "block"], "left").select("node", "block", F.lit(hops).alias("hops"), *fresh)
        frontier = store(new.where(" OR ".join(f"{w} <> 0" for w in words)), "level")
        if frontier.isEmpty():
            break
        levels.append(frontier)
        seen.append(frontier.drop("hops"))
        if len(seen) > 8:
            seen = [store(stack(*seen).groupBy("node", "block").agg(*some), "seen")]

    def pairs_of(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                packed = np.stack([batch.column(w).to_numpy() for w in words], axis=1).astype("<i8")
                row, bit = np.nonzero(np.unpackbits(packed.view(np.uint8), axis=1, bitorder="little"))
                n = batch.column("block").to_numpy()[row] * _ROOTS_A_ROW + bit
                yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(row)), batch.column("hops").take(pa.array(row)), pa.array(n)], ["node", "hops", "n"])

    kind = pairs.schema["dst"].dataType.simpleString()
    found = stack(*levels).mapInArrow(pairs_of, f"node {kind}, hops int, n long")
    return found.join(numbered, "n").select("root", "node", "hops")


def _distances_in_tasks(ahead: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, node, hops) from distinct roots over few edges (node, next), which every task holds.

    A task walks from its roots together, a level at a time, a bit for each; it gives a row a node and level
    with the list of roots that are that far, which only Spark unfolds.
    """
    edges = ahead.where("node IS NOT NULL").toArrow().combine_chunks()
    n_edges = edges.num_rows
    both = pa.concat_arrays([c for name in ("node", "next") for c in edges[name].chunks] or [pa.array([], edges.schema.field("node").type)])
    coded = both.dictionary_encode(null_encoding="encode")
    names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    by_end = np.argsort(code[n_edges:], kind="stable")
    src, dst = code[:n_edges][by_end], code[n_edges:][by_end]
    by_start = np.argsort(src, kind="stable").astype(np.int32)
    begins = np.searchsorted(src[by_start], np.arange(len(names) + 1)).astype(np.int64)
    spark = ahead.sparkSession
    shared = spark.sparkContext.broadcast((names, src, dst, by_start, begins))
    # about 32 MB of bits a task
    most = int(min(_ROOTS_A_ROW, max(64, 64 * (4_000_000 // max(len(names), 1)))))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, src, dst, by_start, begins = shared.value
        found = [batch.column(0) for batch in batches if batch.num_rows]
        mine = pa.concat_arrays(found) if found else pa.array([], names.type)
        blocks = -(-len(mine) // (2 * most))
        for block in range(blocks):
            starts = mine.slice(block * len(mine) // blocks, (block + 1) * len(mine) // blocks - block * len(mine) // blocks)
            yield from level_by_level(starts, names, src, dst, by_start, begins)

    def level_by_level(starts, names, src, dst, by_start, begins):
        at = pc.index_in(starts, value_set=names)
        alone = starts.filter(pc.is_null(at))
        if len(alone):
            yield batch_of(alone, np.zeros(len(alone), np.int32), pa.ListArray.from_arrays(pa.array(np.arange(len(alone) + 1, dtype=np.int32)), alone))
        roots = starts.filter(pc.is_valid(at))
        active = at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.arange(len(roots))
        bits = np.zeros((len(roots), -(-len(roots) // 64)), "<u8")
        bits[number, number >> 6] = np.left_shift(np.uint64(1), (number & 63).astype(np.uint64))
        seen = np.zeros((len(names), bits.shape[1]), "<u8")
        seen[active] = bits
        hops, kept, n_kept = 0, [], 0
        while len(active):
            kept.append((active, np.full(len(active), hops, np.int32), bits))
            n_kept += len(active)
            if n_kept >= 1000:
                yield from unfolded(kept, roots, names)
                kept, n_kept = [], 0
            hops += 1
            counts = begins[active + 1] - begins[active]
            if counts.sum() * 8 < len(src):
                row = np.repeat(np.arange(len(active)), counts)
                edge = by_start[np.arange(len(row)) + np.repeat(begins[active] - np.cumsum(counts) + counts, counts)]
                order = np.argsort(dst[edge], kind="stable")
                row, end = row[order], dst[edge][order]
            else:
                place = np.full(len(names), -1, np.int64)
                place[active] = np.arange(len(active))
                row = place[src]
                end, row = dst[row >= 0], row[row >= 0]
            if not len(end):
                break
            cut = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
            node = end[cut].astype(np.int64)
            fresh = np.bitwise_or.reduceat(bits[row], cut, axis=0) & ~seen[node]
            some = fresh.any(axis=1)
            active, bits = node[some], fresh[some]
            seen[active] |= bits
        if kept:
            yield from unfolded(kept, roots, names)

    def unfolded(kept, roots, names):
        nodes, hops, bits = (np.concatenate(column) for column in zip(*kept, strict=True))
        for begin in range(0, len(nodes), 1000):
            row, bit = np.nonzero(np.unpackbits(bits[begin : begin + 1000].view(np.uint8), axis=1, bitorder="little"))
            some = nodes[begin : begin + 1000]
            ends = np.cumsum(np.r_[0, np.bincount(row, minlength=len(some))]).astype(np.int32)
            yield batch_of(names.take(pa.array(some)), hops[begin : begin + 1000], pa.ListArray.from_arrays(pa.array(ends), roots.take(pa.array(bit))))

    def batch_of(nodes, hops, lists):
        return pa.RecordBatch.from_arrays([nodes, pa.array(hops), lists], ["node", "hops", "roots"])

    kind = ahead.schema["node"].dataType.simpleString()
    tasks = max(spark.sparkContext.defaultParallelism, -(-roots.count() // most))
    found = roots.repartition(tasks).mapInArrow(walk, f"node {kind}, hops int, roots array<{kind}>")
    return found.select(F.explode("roots").alias("root"), "node", "hops")


def path_cache(edges: DataFrame, stamp: Column, hops: int = MAX_HOPS, sources: DataFrame | None = None) -> DataFrame:
    """The stored cache of shortest paths between all pairs within ``hops``."""
    return _as_cache(shortest_pairs(links(edges), sources, hops), stamp)


def _as_cache(found: DataFrame, stamp: Column) -> DataFrame:
    return found.select(
        F.col("src").alias("src_node_id"),
        F.col("tgt").alias("tgt_node_id"),
        "min_hops",
        "path",
        stamp.alias("computed_at"),
    )


def refresh_path_cache(
    cache: DataFrame, old_edges: DataFrame, new_edges: DataFrame, stamp: Column, hops: int = MAX_HOPS
) -> DataFrame:
    """The cache after an edge change, with only the pairs repaired that the change affects.

    A pair is lost if its stored path uses a removed edge; any other stored path is
    still the best without the added edges. Level by level, paths that changed go on
    along every edge, unchanged ones along added edges, and lost pairs are found again
    from the unchanged pairs that end before their last node. A pair changes where such
    a path is shorter than what is stored, or as long and smaller. What changes is written
    as tables, whose size the planner knows, so that a small change shuffles no cache.
    """
    before, after = links(old_edges).where("src <> dst"), store(links(new_edges).where("src <> dst"), "edges-now")
    came = store(after.join(before, ["src", "dst"], "left_anti").select(F.col("src").alias("node"), F.col("dst").alias("next")), "edges-added")
    gone = store(before.join(after, ["src", "dst"], "left_anti"), "edges-removed")
    stored = cache.select(F.col("src_node_id").alias("src"), F.col("tgt_node_id").alias("node"), "min_hops", "path")
    last = F.size("path") - 1
    steps = F.arrays_zip(F.slice("path", F.lit(1), last).alias("src"), F.slice("path", F.lit(2), last).alias("dst"))
    walked = stored.select(F.col("src").alias("root"), "node", F.inline(steps)).toDF("root", "node", "src", "dst")
    lost = store(walked.join(gone, ["src", "dst"], "left_semi").select(F.col("root").alias("src"), "node").distinct(), "pairs-lost")
    kept = stored.join(lost, ["src", "node"], "left_anti")
    out = after.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    # the edges that may end a lost pair's new path
    ends = store(lost.withColumnRenamed("node", "next").join(out, "next").select("src", "node", "next"), "pairs-sought")
    extended = lambda rows: rows.select("src", F.col("next").alias("node"), F.concat("path", F.array("next")).alias("path"))
    old = kept.select("src", "node", F.col("min_hops").alias("_hops"), F.col("path").alias("_path"))
    changed: list[DataFrame] = []
    for hop in range(1, hops + 1):
        if hop == 1:
            candidates = came.select(F.col("node").alias("src"), F.col("next").alias("node"), F.array("node", "next").alias("path"))
        else:
            level = kept.where(F.col("min_hops") == hop - 1)
            candidates = stack(
                extended(changed[-1].join(out, "node")),
                extended(level.join(came, "node")),
                extended(level.join(ends, ["src", "node"])),
            )
        best = candidates.where("src <> node").groupBy("src", "node").agg(F.min("path").alias("path"))
        if changed:
            best = best.join(stack(*changed).select("src", "node"), ["src", "node"], "left_anti")
        better = F.col("_hops").isNull() | (F.col("_hops") > hop) | ((F.col("_hops") == hop) & (F.col("path") < F.col("_path")))
        changed.append(store(best.join(old, ["src", "node"], "left").where(better).select("src", "node", F.lit(hop).alias("min_hops"), "path"), "pairs-changed"))
    repaired = stack(*changed)
    same = cache.join(
        stack(lost, repaired.select("src", "node")).select(F.col("src").alias("src_node_id"), F.col("node").alias("tgt_node_id")), ["src_node_id", "tgt_node_id"], "left_anti"
    )
    return stack(same, _as_cache(repaired.withColumnRenamed("node", "tgt"), stamp))


def bfs(pairs: DataFrame, sources: DataFrame, targets: DataFrame, hops: int | None = MAX_HOPS) -> DataFrame:
    """Per source the nearest targets: (src, tgt, min_hops, path).

    Every node first learns how far the nearest target is, walking back from all of them
    at once: one row a node, whatever the number of sources. A source then only follows
    edges that come one nearer. A source that is a target itself looks for another one
    on its own and stops when it has met it.
    """
    wanted = materialize(targets.select("id").distinct())
    asked = materialize(sources.select("id").distinct())
    own = shortest_pairs(pairs, asked.join(wanted, "id", "left_semi"), hops, until=wanted).join(wanted.withColumnRenamed("id", "tgt"), "tgt", "left_semi")
    near = own.groupBy("src").agg(F.min("min_hops").alias("min_hops"))
    found = own.join(near, ["src", "min_hops"]).select("src", "tgt", "min_hops", "path")
    back = distances(reverse(pairs), wanted.select(F.lit(0).alias("root"), F.col("id").alias("node")), hops)
    left = materialize(back.select("node", F.col("hops").alias("left")))
    nearer = pairs.join(left.withColumnRenamed("node", "src"), "src").join(left.select(F.col("node").alias("dst"), F.col("left").alias("then")), "dst")
    nearer = nearer.where("left = then + 1").select(F.col("src").alias("node"), F.col("dst").alias("next"), "then").distinct()
    stay = wanted.select(F.col("id").alias("node"), F.lit(None).cast(wanted.schema["id"].dataType).alias("next"), F.lit(0).alias("then"))
    ahead = materialize(stack(nearer, stay))
    begin = materialize(asked.join(wanted, "id", "left_anti").withColumnRenamed("id", "node").join(left, "node"))
    longest = begin.agg(F.max("left")).first()[0] or 0
    frontier = begin.select(F.col("node").alias("src"), "node", F.col("left").alias("min_hops"), F.array("node").alias("path"))
    for hop in range(1, longest + 1):
        path = F.when(F.col("next").isNull(), F.col("path")).otherwise(F.concat("path", F.array("next")))
        step = frontier.join(ahead, "node").select("src", F.coalesce("next", "node").alias("node"), "min_hops", path.alias("path"))
        frontier = step.groupBy("src", "node", "min_hops").agg(F.min("path").alias("path"))
        if hop % 8 == 0:
            frontier = materialize(frontier)
    return stack(found, frontier.where("min_hops > 0").select("src", F.col("node").alias("tgt"), "min_hops", "path"))


def shortest_paths(pairs: DataFrame, landmarks: DataFrame, hops: int | None = None) -> DataFrame:
    """(id, landmark, hops): distance from every node to each landmark it reaches, 0 from itself.

    A few landmarks, or a few hops, are walked several edges a round, many landmarks a level at a time.
    """
    starts = landmarks.select(F.col("id").alias("root"), F.col("id").alias("node"))
    if hops is None and starts.distinct().limit(FEW_ROOTS + 1).count() > FEW_ROOTS:
        found = distances_of_many(reverse(pairs), starts)
    else:
        found = distances(reverse(pairs), starts, hops)
    return found.select(F.col("node").alias("id"), F.col("root").alias("landmark"), "hops")


def trimmed(pairs: DataFrame, rounds: int | None = None) -> DataFrame:
    """The edges left when those from nodes without an edge in, or to nodes without one out, are taken away again and again."""
    left, n, done = materialize(pairs.where("src <> dst").select("src", "dst").distinct()), None, 0
    while rounds is None or done < rounds:
        done += 1
        ends, starts = left.select(F.col("dst").alias("src")).distinct(), left.select(F.col("src").alias("dst")).distinct()
        left = materialize(left.join(ends, "src", "left_semi").join(starts, "dst", "left_semi").select("src", "dst"))
        before, n = n, left.count()
        if n in (0, before):
            break
    return left


def strong_components(pairs: DataFrame, stride: int = 8) -> DataFrame:
    """(id, component): nodes that lie on a cycle with another node, and the largest id they share all cycles with.

    Every node takes the largest id that reaches it as its colour. The nodes of a colour
    that reach the node it is named after are that node's component; they are taken out,
    what remains is trimmed, and the rest is coloured again.
    """
    rest, found = trimmed(pairs), []
    while not rest.isEmpty():
        nodes = rest.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        out = materialize(stack(rest.select(F.col("src").alias("node"), F.col("dst").alias("next")), nodes.select("node", F.col("node").alias("next"))))
        colours, mark = nodes.withColumn("colour", F.col("node")), None
        while True:
            for _ in range(stride):
                colours = colours.join(out, "node").groupBy(F.col("next").alias("node")).agg(F.max("colour").alias("colour"))
            colours = materialize(colours)
            before, mark = mark, colours.agg(F.sum(F.xxhash64("node", "colour").cast("decimal(38,0)"))).first()[0]
            if mark == before:
                break
        named = lambda column, name: colours.select(F.col("node").alias(column), F.col("colour").alias(name))
        within = rest.join(named("src", "a"), "src").join(named("dst", "b"), "dst").where("a = b").select("src", "dst")
        roots = colours.where("node = colour").select(F.col("colour").alias("root"), "node")
        part = materialize(distances(reverse(within), roots).select(F.col("node").alias("id"), F.col("root").alias("component")))
        found.append(part)
        gone = part.select(F.col("id"))
        rest = trimmed(rest.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti"))
    if not found:
        return pairs.select(F.col("src").alias("id"), F.col("src").alias("component")).limit(0)
    whole = stack(*found)
    several = whole.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    return whole.join(several, "component", "left_semi").select("id", "component")


def _components_in_task(edges: DataFrame) -> DataFrame:
    """(id, component) of a few edges (src, dst), without nodes that are alone; Tarjan's walk without recursion."""

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict = {}
        kinds = None
        for batch in batches:
            kinds = batch.schema.field("src").type
            for src, dst in zip(batch.column("src").to_pylist(), batch.column("dst").to_pylist(), strict=True):
                out.setdefault(src, []).append(dst)
        first, low, waiting, held, found = {}, {}, [], set(), ([], [])
        for start in out:
            if start in first:
                continue
            walk = [(start, iter(out[start]))]
            first[start] = low[start] = len(first)
            waiting.append(start)
            held.add(start)
            while walk:
                node, ahead = walk[-1]
                for to in ahead:
                    if to not in first:
                        first[to] = low[to] = len(first)
                        waiting.append(to)
                        held.add(to)
                        walk.append((to, iter(out.get(to, ()))))
                        break
                    if to in held:
                        low[node] = min(low[node], first[to])
                else:
                    walk.pop()
                    if walk:
                        low[walk[-1][0]] = min(low[walk[-1][0]], low[node])
                    if low[node] == first[node]:
                        place = len(waiting) - 1
                        while waiting[place] != node:
                            place -= 1
                        members = waiting[place:]
                        del waiting[place:]
                        held.difference_update(members)
                        if len(members) > 1:
                            found[0].extend(members)
                            found[1].extend([max(members)] * len(members))
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(column, kinds) for column in found], ["id", "component"])

    kind = edges.schema["src"].dataType.simpleString()
    return edges.repartition(1).mapInArrow(components, f"id {kind}, component {kind}")


def short_components(pairs: DataFrame) -> DataFrame:
    """(id, component): as ``strong_components``, under any id of the component, in few rounds where cycles are long.

    A node with a single edge out (or in) is taken out and its other edges go on to the node
    at that edge's end, which leaves all walks between the others. No two neighbours go in one
    round, which takes about a third of a chain or cycle, so rounds grow with the logarithm
    of the longest. What has several edges both ways is left to ``strong_components``. Once few edges
    are left, one task finishes them, however many there were. Backwards, a node belongs to the
    component of the node it was led to where that component led to it.
    """
    left, gone = store(pairs.where("src <> dst").select("src", "dst").distinct(), "edges-left"), []
    parts: list[DataFrame] = []
    while n := left.count():
        if n <= EDGES_A_TASK:
            parts.append(store(_components_in_task(left), "components"))
            break
        outs = left.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("outs"), F.min("dst").alias("ahead"))
        ins = left.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("ins"), F.min("src").alias("behind"))
        # without an edge in or out a node is on no cycle
        stand = F.when(F.col("outs") == 1, F.col("ahead")).when(F.col("ins") == 1, F.col("behind"))
        inside = store(outs.join(ins, "node").select("node", (F.col("outs") == 1).alias("forth"), stand.alias("stand")), "nodes-inside")
        end = lambda column: inside.select(
            F.col("node").alias(column), F.struct(F.col("stand").isNotNull().alias("single"), F.xxhash64("node", F.lit(len(gone))).alias("rank")).alias(f"{column}_end")
        )
        within = store(left.join(end("src"), "src").join(end("dst"), "dst"), "edges-inside")
        first = F.struct("src_end.rank", F.col("src").alias("id")) < F.struct("dst_end.rank", F.col("dst").alias("id"))
        later = within.where("src_end.single AND dst_end.single").select(F.when(first, F.col("dst")).otherwise(F.col("src")).alias("node")).distinct()
        chosen = store(inside.where("stand IS NOT NULL").join(later, "node", "left_anti"), "nodes-chosen")
        if chosen.isEmpty():
            parts.append(store(strong_components(within.select("src", "dst")), "components"))
            break
        out, into = (chosen.select(F.col("node").alias(c), F.struct("forth", "stand").alias(f"{c}_goes")) for c in ("src", "dst"))
        moved = within.select("src", "dst").join(out, "src", "left").join(into, "dst", "left")
        moved = moved.where("(src_goes IS NULL OR NOT src_goes.forth) AND (dst_goes IS NULL OR dst_goes.forth)")
        moved = store(moved.select("src", "dst", F.col("src_goes.stand").alias("before"), F.col("dst_goes.stand").alias("after")), "edges-moved")
        led = "before IS NOT NULL OR after IS NOT NULL"
        node, other = F.when(F.col("after").isNotNull(), F.col("dst")).otherwise(F.col("src")), F.when(F.col("after").isNotNull(), F.col("src")).otherwise(F.col("dst"))
        gone.append(moved.where(led).select(node.alias("node"), F.coalesce("after", "before").alias("stand"), other.alias("other")))
        ends = moved.select(F.coalesce("before", "src").alias("src"), F.coalesce("after", "dst").alias("dst"))
        left = store(ends.where("src <> dst").distinct(), "edges-left")
    for rows in reversed(gone):
        if parts:
            known = stack(*parts)
            for column in ("stand", "other"):
                named = known.select(F.col("id").alias(column), F.col("component").alias(f"{column}_component"))
                rows = rows.join(named, column, "left").withColumn(f"{column}_component", F.coalesce(f"{column}_component", column))
            rows = rows.where("stand_component = other_component").select("node", F.col("stand_component").alias("component"))
        else:
            rows = rows.where("stand = other").select("node", F.col("stand").alias("component"))
        rows = store(rows.select(F.col("node").alias("id"), "component").distinct(), "components")
        parts = [store(stack(*parts, rows), "components")] if len(parts) == 8 else [*parts, rows]
    if not parts:
        return pairs.select(F.col("src").alias("id"), F.col("src").alias("component")).limit(0)
    whole = stack(*parts)
    return stack(whole, whole.select(F.col("component").alias("id"), "component")).distinct()


def find_cycles(pairs: DataFrame, hops: int | None = MAX_HOPS) -> DataFrame:
    """(id, length, path): nodes on a cycle of at most ``hops`` edges, a self-loop having length 1.

    Only edges with edges before and behind them are walked, and without a limit of hops
    only those within a strong component, of which every node has a cycle. Before a level
    is walked, edges back to the start close the cycles of that length, and a node that
    has found its cycle walks no further: a hub and its leaves are done after two edges.
    """
    loops = pairs.where("src = dst").select(F.col("src").alias("id"), F.lit(1).alias("length"), F.array("src", "dst").alias("path")).distinct()
    if hops is None:
        component = materialize(strong_components(pairs))
        named = lambda column, name: component.select(F.col("id").alias(column), F.col("component").alias(name))
        inside = pairs.where("src <> dst").join(named("src", "a"), "src").join(named("dst", "b"), "dst").where("a = b").select("src", "dst").distinct()
        inside = materialize(inside)
    else:
        inside = trimmed(pairs, hops)
    out = inside.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    back = inside.select(F.col("src").alias("node"), F.col("dst").alias("src"))
    frontier = inside.join(loops.select(F.col("id").alias("src")), "src", "left_anti").select("src", F.col("dst").alias("node"), F.array("src", "dst").alias("path"))
    visited, found = _Visited(frontier.select("src", "node")), [loops]
    hop = 1
    while hops is None or hop < hops:
        hop += 1
        closed = frontier.join(back, ["src", "node"], "left_semi").groupBy("src").agg(F.min("path").alias("path"))
        closed = materialize(closed.select(F.col("src").alias("id"), F.lit(hop).alias("length"), F.concat("path", F.array("src")).alias("path")))
        found.append(closed)
        if hop == hops:
            break
        walking = frontier.join(closed.select(F.col("id").alias("src")), "src", "left_anti")
        step = walking.join(out, "node").where(F.col("next") != F.col("src")).select("src", F.col("next").alias("node"), F.concat("path", F.array("next")).alias("path"))
        frontier = materialize(visited.new(step.groupBy("src", "node").agg(F.min("path").alias("path")), ["src", "node"]))
        if frontier.isEmpty():
            break
        visited.add(frontier.select("src", "node"))
    return stack(*found)


def motif(
    edges: DataFrame,
    pattern: Sequence[tuple[str, str | None, str]],
    without: Sequence[tuple[str, str | None, str]] = (),
) -> DataFrame:
    """Bindings of node names to ids for which every edge of the pattern exists.

    Each entry is (from, relationship or None, to). ``without`` lists edges that
    must not exist.
    """

    def edge(source: str, relationship: str | None, target: str) -> DataFrame:
        rows = edges if relationship is None else edges.where(F.col("relationship") == relationship)
        if source == target:
            return rows.where(F.col("src") == F.col("dst")).select(F.col("src").alias(source)).distinct()
        return rows.select(F.col("src").alias(source), F.col("dst").alias(target)).distinct()

    bound = edge(*pattern[0])
    for entry in pattern[1:]:
        part = edge(*entry)
        shared = [c for c in part.columns if c in bound.columns]
        if not shared:
            raise ValueError("order the pattern so that each edge shares a name with those before it")
        bound = bound.join(part, shared)
    for entry in without:
        part = edge(*entry)
        shared = [c for c in part.columns if c in bound.columns]
        bound = bound.join(part.select(*shared).distinct(), shared, "left_anti")
    return bound


def heads(parents: DataFrame, tops: DataFrame) -> DataFrame:
    """(node, head): the nearest node above each that ``tops`` holds, by doubled pointers.

    ``parents`` is (node, up), one row a node, none for a top. Every round a pointer
    takes the pointer of the node it points at, so rounds grow with the logarithm of the
    longest chain. Nodes that no top is above have no row.
    """
    ends = tops.select(F.col("node").alias("up"), F.lit(True).alias("ended")).distinct()
    state = materialize(parents.select("node", "up").join(ends, "up", "left").select("node", "up", F.coalesce("ended", F.lit(False)).alias("ended")))
    longest, covered = state.count(), 1
    while covered < longest and not state.where("NOT ended").isEmpty():
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("ended").alias("done"))
        moved = state.where("NOT ended").join(ahead, "up").select("node", F.col("further").alias("up"), F.col("done").alias("ended"))
        state = materialize(stack(state.where("ended"), moved))
        covered *= 2
    return state.where("ended").select("node", F.col("up").alias("head"))


def descendants(pairs: DataFrame, starts: DataFrame, hops: int | None = None) -> DataFrame:
    """(root, node): everything below each root, each node once, without the start nodes.

    Nodes with one parent hang below a head: a start, or a node with several parents or
    none. They find it by doubled pointers, and only heads are walked level by level, so a
    chain or a deep tree takes rounds by the logarithm of its depth.
    """
    begin = starts.select("root", "node").distinct()
    if hops is not None:
        return distances(pairs, begin, hops).where("hops > 0").select("root", "node")
    edges = materialize(pairs.where("src <> dst").select(F.col("src").alias("up"), F.col("dst").alias("node")).distinct())
    single = edges.groupBy("node").agg(F.count("*").alias("n"), F.first("up").alias("up")).where("n = 1").select("node", "up")
    single = single.join(begin.select("node"), "node", "left_anti")
    every = stack(edges.select("node"), edges.select(F.col("up").alias("node")), begin.select("node")).distinct()
    tops = materialize(every.join(single.select("node"), "node", "left_anti"))
    below = materialize(heads(single, tops))
    of = stack(below, tops.select("node", F.col("node").alias("head")))
    between = edges.join(tops, "node", "left_semi").join(of.select(F.col("node").alias("up"), "head"), "up").select(F.col("head").alias("src"), F.col("node").alias("dst"))
    reached = materialize(distances(between, begin))
    hanging = reached.select("root", F.col("node").alias("head")).join(below, "head").select("root", "node")
    return stack(reached.where("hops > 0").select("root", "node"), hanging)


def impact_analysis(affected: DataFrame, cache: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(entity, direction, related, role, hops, transformations) for each affected entity.

    A source has no incoming edge, a sink no outgoing one; one row per related
    entity, so origins and destinations are never multiplied.
    """
    wanted = affected.select(F.col("id").alias("entity")).distinct()
    down = cache.join(wanted.withColumnRenamed("entity", "src_node_id"), "src_node_id", "left_semi").select(
        F.col("src_node_id").alias("entity"), F.lit("downstream").alias("direction"),
        F.col("tgt_node_id").alias("related"), F.col("min_hops").alias("hops"), "path",
    )
    up = cache.join(wanted.withColumnRenamed("entity", "tgt_node_id"), "tgt_node_id", "left_semi").select(
        F.col("tgt_node_id").alias("entity"), F.lit("upstream").alias("direction"),
        F.col("src_node_id").alias("related"), F.col("min_hops").alias("hops"), "path",
    )
    found = stack(up, down)
    steps = nodes.where(F.col("entity_type") == "transformation").select(F.col("id").alias("step"))
    key = ["entity", "direction", "related"]
    passed = (
        found.select(*key, F.posexplode("path").alias("place", "step"))
        .join(steps, "step")
        .groupBy(*key)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "step"))), lambda s: s["step"]), ",").alias("transformations"))
    )
    flow = edges.where(F.col("src") != F.col("dst"))
    has_input = flow.select(F.col("dst").alias("related"), F.lit(True).alias("has_input")).distinct()
    has_output = flow.select(F.col("src").alias("related"), F.lit(True).alias("has_output")).distinct()
    kinds = nodes.select(F.col("id").alias("related"), "entity_type")
    role = (
        F.when((F.col("direction") == "upstream") & F.col("has_input").isNull(), "origin")
        .when((F.col("direction") == "downstream") & F.col("has_output").isNull(), "destination")
        .when(F.col("entity_type") == "transformation", "transformation")
        .otherwise("intermediate")
    )
    return (
        found.join(passed, key, "left")
        .join(has_input, "related", "left")
        .join(has_output, "related", "left")
        .join(kinds, "related", "left")
        .select(*key, role.alias("role"), "hops", F.coalesce("transformations", F.lit("")).alias("transformations"))
    )


def impact_score(cache: DataFrame) -> DataFrame:
    """(id, score, n_dependents): dependents weighted by closeness."""
    return cache.groupBy(F.col("src_node_id").alias("id")).agg(
        F.sum(1.0 / F.col("min_hops")).alias("score"),
        F.count("*").alias("n_dependents"),
    )


def pagerank(edges: DataFrame, nodes: DataFrame, iterations: int = 10, damping: float = 0.85) -> DataFrame:
    """(id, rank): rank flows along edges in proportion to weight, NULL weight being 1; ranks sum to one.

    In every iteration the rank of nodes without outgoing edges is spread over all. Spreading
    is the same for every node, so each iteration is a weighted sum of what a uniform start
    becomes after 0, 1, 2, ... steps: those are computed in one chain, one column a step, and
    the weights follow from the columns' sums, which are all the driver sees.
    """
    ids = stack(nodes.select("id"), edges.select(F.col("src").alias("id")), edges.select(F.col("dst").alias("id"))).distinct()
    ids = materialize(ids)
    n = ids.count()
    weighted = edges.groupBy("src", "dst").agg(F.sum(F.coalesce(F.col("weight").cast("double"), F.lit(1.0))).alias("weight"))
    totals = weighted.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = weighted.join(totals, "src").select(F.col("src").alias("id"), "dst", (F.col("weight") / F.col("total")).alias("share"))
    steps = materialize(stack(shares, ids.select("id", F.col("id").alias("dst"), F.lit(None).cast("double").alias("share"))))  # no share: the node itself
    state = ids.withColumn("v0", F.lit(1.0 / max(n, 1)))
    for k in range(iterations):
        own = [F.sum(F.when(F.col("share").isNull(), F.col(f"v{j}"))).alias(f"v{j}") for j in range(k + 1)]
        moved = F.coalesce(F.sum(F.col(f"v{k}") * F.col("share") * damping), F.lit(0.0)).alias(f"v{k + 1}")
        state = state.join(steps, "id").groupBy(F.col("dst").alias("id")).agg(*own, moved)
        if (k + 1) % 5 == 0:
            state = materialize(state)
    mass = [m or 0.0 for m in state.agg(*[F.sum(f"v{j}") for j in range(iterations + 1)]).first()]
    weights = [1.0]
    for _ in range(iterations):
        dangling = sum(w * (mass[j] - mass[j + 1] / damping) for j, w in enumerate(weights))
        weights = [1.0 - damping + damping * dangling, *weights]
    rank = sum((F.lit(w) * F.col(f"v{j}") for j, w in enumerate(weights)), F.lit(0.0))
    return state.select("id", rank.alias("rank"))


def tagged_flows(edges: DataFrame, tags: DataFrame, hops: int = MAX_HOPS) -> DataFrame:
    """(regulation, src, dst, relationship): edges up- or downstream of tagged columns."""
    starts = tags.select(F.col("regulation").alias("root"), F.col("id").alias("node")).distinct()
    flow = oriented(edges)
    up = lineage_edges(flow, starts, hops, "upstream")
    down = lineage_edges(flow, starts, hops, "downstream")
    return stack(up, down).select(F.col("root").alias("regulation"), "src", "dst", "relationship").distinct()


def project_lineage(edges: DataFrame, nodes: DataFrame, kinds: Sequence[str] = ("table", "path")) -> DataFrame:
    """(src, dst): tables and paths feeding tables and paths, all between contracted."""
    kept = nodes.where(F.col("entity_type").isin(*kinds)).select("id")
    return contract(links(edges), kept)


def files_using_identifier(ast_nodes: DataFrame, names: DataFrame) -> DataFrame:
    """(name, file): files whose syntax tree holds the identifier."""
    used = ast_nodes.where(F.col("type").isin("Name", "arg")).select(F.col("text").alias("name"), "file").distinct()
    return used.join(names.select("name"), "name", "left_semi")
