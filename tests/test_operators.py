"""Operators against brute force, and what streams and files must keep."""

import itertools
import os
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadline.operators import graph, search, traverse, versions
from threadline.plans import queries_changes
from threadline.session import materialize, stack
from threadline.sources import lineage_files, paths
from threadline.streaming import keyed


def vectors(spark, n, name, seed):
    made = np.random.default_rng(seed).standard_normal((n, 64)).astype("float32")
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(made)], f"{name} int, embedding array<float>"), made


def test_vector_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 10)  # three blocks of queries
    nodes, left = vectors(spark, 300, "id", 1)
    queries, right = vectors(spark, 25, "query_id", 2)
    want = {(r.query_id, r.rank): r.id for r in search.vector_top_k(nodes, queries, 5).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    order = np.argsort(-(unit(right.astype(float)) @ unit(left.astype(float)).T), axis=1)
    assert all(want[(q, k + 1)] == order[q, k] for q in range(25) for k in range(5)) and len(want) == 125
    wanted = spark.createDataFrame([(q, int(order[q, k])) for q in range(25) for k in (0, 7, 150, 299)], "query_id int, id int")
    places = {(r.query_id, r.id): r["rank"] for r in search.vector_ranks(nodes, queries, wanted).collect()}
    assert places == {(q, order[q, k]): k + 1 for q in range(25) for k in (0, 7, 150, 299)}


def test_score_ranks(spark):
    rng = random.Random(4)
    rows = [(q, f"d{i}", float(rng.randrange(12))) for q in "ab" for i in range(200)]
    wanted = [(q, f"d{i}") for q in "ab" for i in (3, 50, 51, 199)] + [("a", "none"), ("c", "d1")]
    got = search.score_ranks(spark.createDataFrame(rows, "query_id string, id string, score double"), spark.createDataFrame(wanted, "query_id string, id string"))
    want = {}
    for q in "ab":
        order = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))
        want |= {(q, r[1]): k + 1 for k, r in enumerate(order)}
    assert {(r.query_id, r.id): r["rank"] for r in got.collect()} == {k: want[k] for k in wanted if k in want}


def test_fusion_equals_whole_lists(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(600)]
    made = np.random.default_rng(3).standard_normal((600, 8)).astype("float32")
    nodes = spark.createDataFrame([(f"n{i:03d}", t, [float(x) for x in v]) for i, (t, v) in enumerate(zip(texts, made, strict=True))], "id string, text string, embedding array<float>")
    asked = spark.createDataFrame([(f"q{i}", " ".join(rng.sample(words, 2)), [float(x) for x in made[i] + 1]) for i in range(6)], "query_id string, text string, embedding array<float>")
    for k in (2, 8):
        whole = search.fuse_ranks(search.vector_top_k(nodes, asked, 600), search.keyword_search(nodes, asked, 600), k=k)
        found = search.hybrid_search(nodes, asked, k)
        assert sorted(map(tuple, found.select("query_id", "rank", "id", "score").collect())) == sorted(map(tuple, whole.select("query_id", "rank", "id", "score").collect()))


def test_index_recall_and_exact_answers(spark):
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((60, 24))
    made = (middles[rng.integers(0, 60, 4000)] + 0.45 * rng.standard_normal((4000, 24))).astype("float32")
    nodes = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(made)], "id int, embedding array<float>")
    queries = nodes.where("id < 40").select(F.col("id").alias("query_id"), "embedding")
    index = search.build_vector_index(nodes, 64)
    rows = lambda found: {(r.query_id, r["rank"], r.id, r.score) for r in found.collect()}
    want = rows(search.vector_top_k(nodes, queries, 5))
    assert rows(search.indexed_top_k(index, queries, 5, 2, exact=True)) == want
    close = rows(search.indexed_top_k(index, queries, 5, 16))
    assert len({(q, i) for q, _, i, _ in close} & {(q, i) for q, _, i, _ in want}) / len(want) >= 0.95


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_match_is_exact(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab_") for _ in range(rng.randint(1, 6))) for _ in range(80)})
    names = spark.createDataFrame([(w,) for w in words[::2]], "name string")
    typed = spark.createDataFrame([(w,) for w in words[1::2]], "typed string")
    got = {(r.typed, r.name, r.distance) for r in search.fuzzy_match(names, typed, 2).collect()}
    assert got == {(t, n, edit_distance(t, n)) for t in words[1::2] for n in words[::2] if edit_distance(t, n) <= 2}


def test_fuzzy_match_sends_no_side_through_the_driver(spark):
    names, typed = spark.createDataFrame([("abc",)], "name string"), spark.createDataFrame([("abd",), (None,)], "typed string")
    found = search.fuzzy_match(names, typed, 1)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("abd", "abc", 1)]


def test_versions_of_one_hot_key(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.choice("ab"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, content string, at int").repartition(8)
    got = {(r.id, r.at): r.version for r in versions.number_versions(df, "id", "content", ["at"]).collect()}
    last, want = {}, {}
    for key, content, at in rows:
        version, before = last.get(key, (0, None))
        last[key] = (version + (content != before), content)
        want[(key, at)] = last[key][0]
    assert got == want


def test_batches(spark):
    got = versions.assign_batches(spark.range(95).select(F.format_string("%03d", "id").alias("path")), "path", 20)
    assert sorted((r.path, r.batch) for r in got.collect()) == [(f"{i:03d}", i // 20) for i in range(95)]


def random_edges(spark, n, m, seed):
    rng = random.Random(seed)
    made = sorted({(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)})
    return spark.createDataFrame(made, "src string, dst string"), made


def test_contract_through_long_chains(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("n7", "n3"), ("n0", "n40"), ("n20", "n20")]
    kept = {"n0", "n25", "n40"}
    pairs = spark.createDataFrame(chain, "src string, dst string")
    got = {tuple(r) for r in traverse.contract(pairs, spark.createDataFrame([(k,) for k in kept], "id string")).collect()}
    assert got == {("n0", "n25"), ("n25", "n40"), ("n0", "n40")}


def test_contract_through_a_long_cycle(spark, monkeypatch):
    made = [(f"c{i}", f"c{(i + 1) % 120}") for i in range(120)] + [("a", "c3"), ("c2", "b"), ("c9", "d"), ("d", "d"), ("b", "c60")]
    rounds = []
    monkeypatch.setattr(traverse, "materialize", lambda df: rounds.append(1) or materialize(df))
    pairs = spark.createDataFrame(made, "src string, dst string")
    got = {tuple(r) for r in traverse.contract(pairs, spark.createDataFrame([("a",), ("b",)], "id string")).collect()}
    assert got == {("a", "b"), ("b", "b")}
    assert len(rounds) <= 12


def test_short_components(spark):
    for seed, n, m in ((5, 24, 27), (6, 16, 40)):
        pairs, made = random_edges(spark, n, m, seed)
        reach = {v: {v} for e in made for v in e}
        for _ in range(n):
            for s, d in made:
                reach[s] |= reach[d]
        want = {frozenset(w for w in reach[v] if v in reach[w]) for v in reach}
        groups = {}
        for r in traverse.short_components(pairs).collect():
            groups.setdefault(r.component, []).append(r.id)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(c) for c in want if len(c) > 1)
        assert all(c in ids for c, ids in groups.items())


def test_short_components_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(traverse, "EDGES_A_TASK", 0)
    test_short_components(spark)
    cycle = spark.createDataFrame([(f"c{i}", f"c{(i + 1) % 30}") for i in range(30)] + [("c3", "x"), ("x", None)], "src string, dst string")
    assert {r.id for r in traverse.short_components(cycle).collect()} == {f"c{i}" for i in range(30)}


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    written = []
    kept = traverse.store
    monkeypatch.setattr(traverse, "store", lambda df, name: written.append(name) or kept(df, name))
    cycle = spark.createDataFrame([(f"c{i}", f"c{(i + 1) % 3000}") for i in range(3000)], "src string, dst string")
    assert traverse.short_components(cycle).groupBy("component").count().collect()[0]["count"] == 3000
    assert len(written) <= 3


def test_contracted_pairs_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(traverse, "_ENDS_A_BLOCK", 7)
    monkeypatch.setattr(traverse, "_PAIRS_A_TASK", 200)
    made = [(f"r{i}", m) for i in range(60) for m in ("m0", f"m{i % 5}")] + [(m, f"t{i}") for i in range(40) for m in ("m0", f"m{1 + i % 7}")]
    made += [("r1", "t3"), ("r2", "r2"), ("m4", "m0"), ("m6", "t1"), ("r7", "t40"), (None, "t1"), ("r1", None)]
    pairs = spark.createDataFrame(made, "src string, dst string")
    kept = spark.createDataFrame([(f"{k}{i}",) for k in "rt" for i in range(60)], "id string")
    ahead, want = {}, set()
    for s, d in made:
        ahead.setdefault(s, set()).add(d)
    for root in (f"r{i}" for i in range(60)):
        met, level = set(), {root}
        while level:
            level = {d for v in level for d in ahead.get(v, ()) if d} - met
            met |= level
            level = {v for v in level if v[0] == "m"}
        want |= {(root, v) for v in met if v[0] != "m"}
    found = traverse.contract(pairs, kept)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(ends" in plan and plan.index("Generate explode(ends") < plan.index("Repartition")
    assert not any(line.strip(" +-:").startswith("Aggregate") for line in plan[: plan.index("Generate explode(ends")].split("\n"))


def test_reach_walks_and_cache_refresh(spark):
    pairs, made = random_edges(spark, 30, 50, 11)
    out = {}
    for s, d in made:
        out.setdefault(s, []).append(d)
    want, level = set(), {("n1", "n1")}
    for depth in range(1, 6):
        level = {(r, d) for r, n in level for d in out.get(n, [])}
        want |= {(r, n, depth) for r, n in level}
    start = spark.createDataFrame([("n1", "n1")], "root string, node string")
    assert {tuple(r) for r in traverse.reach(pairs, start, 5).collect()} == want
    stamp = F.lit("2024-01-01").cast("timestamp")
    edges = pairs.withColumn("relationship", F.lit("transforms"))
    new = stack(edges.where("src <> 'n2'"), spark.createDataFrame([("n4", "n29", "transforms")], "src string, dst string, relationship string"))
    fresh = {tuple(r)[:4] for r in traverse.path_cache(new, stamp).withColumn("path", F.array_join("path", ">")).collect()}
    refreshed = traverse.refresh_path_cache(traverse.path_cache(edges, stamp), edges, new, stamp)
    assert {tuple(r)[:4] for r in refreshed.withColumn("path", F.array_join("path", ">")).collect()} == fresh


def plain_paths(edges, hops):
    """(src, tgt) -> smallest path of the fewest edges, up to ``hops``."""
    out, best = {}, {}
    for s, d in edges:
        if s != d:
            out.setdefault(s, set()).add(d)
    for s in out:
        level = {s: (s,)}
        seen = {s}
        for _ in range(hops):
            step = {}
            for n, path in level.items():
                for m in out.get(n, ()):
                    if m not in seen:
                        step[m] = min(step.get(m, path + (m,)), path + (m,))
            seen |= set(step)
            best |= {(s, t): p for t, p in step.items()}
            level = step
    return best


def paths_of(rows, *names):
    return {(r[names[0]], r[names[1]]): tuple(r.path) for r in rows.collect()}


def test_cache_repair_equals_a_rebuild(spark):
    stamp = F.lit("2024-01-01").cast("timestamp")
    for seed in (1, 2):
        rng = random.Random(seed)
        pairs, made = random_edges(spark, 40, 90, seed)
        changed = set(rng.sample(made, 75)) | {(f"n{rng.randrange(45)}", f"n{rng.randrange(45)}") for _ in range(12)}
        before = pairs.withColumn("relationship", F.lit("x"))
        after = spark.createDataFrame(sorted(changed), "src string, dst string").withColumn("relationship", F.lit("x"))
        old = traverse.path_cache(before, stamp)
        assert paths_of(old, "src_node_id", "tgt_node_id") == plain_paths(made, 5)
        new = traverse.refresh_path_cache(old, before, after, stamp)
        assert paths_of(new, "src_node_id", "tgt_node_id") == plain_paths(changed, 5)
        assert new.where("min_hops <> size(path) - 1").count() == 0 and new.count() == len(plain_paths(changed, 5))


def plain_cycles(edges, hops):
    out, found = {}, {}
    for s, d in edges:
        out.setdefault(s, set()).add(d)
    for s in out:
        if s in out[s]:
            found[s] = (s, s)
            continue
        inner = plain_paths(edges, hops - 1)
        closing = [p + (s,) for (a, t), p in inner.items() if a == s and s in out.get(t, ())]
        if closing:
            found[s] = min(closing, key=lambda p: (len(p), p))
    return found


def test_cycles(spark):
    for seed, n, m in ((3, 30, 45), (4, 14, 40)):
        pairs, made = random_edges(spark, n, m, seed)
        got = {r.id: tuple(r.path) for r in traverse.find_cycles(pairs, 4).collect()}
        assert got == plain_cycles(made, 4)
    assert {r.id: tuple(r.path) for r in traverse.find_cycles(pairs, None).collect()} == plain_cycles(made, 20)


def test_strong_components(spark):
    ring = [(f"a{i}", f"a{(i + 1) % 9}") for i in range(9)]
    made = ring + [("a3", "b0"), ("b0", "b1"), ("b1", "b0"), ("b1", "c"), ("c", "d"), ("z", "a0"), ("e", "e")]
    got = {r.id: r.component for r in traverse.strong_components(spark.createDataFrame(made, "src string, dst string")).collect()}
    assert got == {f"a{i}": "a8" for i in range(9)} | {"b0": "b1", "b1": "b1"}


def test_cycles_of_a_hub_and_its_leaves(spark):
    leaves = spark.range(5000).select(F.format_string("l%04d", "id").alias("leaf"))
    pairs = stack(leaves.select(F.lit("hub").alias("src"), F.col("leaf").alias("dst")), leaves.select(F.col("leaf").alias("src"), F.lit("hub").alias("dst")))
    found = traverse.find_cycles(pairs)
    assert {(r.length, r.n) for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()} == {(2, 5001)}


def test_long_chains(spark):
    nodes = 31
    chain = spark.range(nodes - 1).select(F.format_string("n%05d", "id").alias("src"), F.format_string("n%05d", F.col("id") + 1).alias("dst"))
    one = lambda name: spark.createDataFrame([(name,)], "id string")
    met = traverse.bfs(chain, one("n00000"), one("n00030"), None).collect()
    assert [(r.min_hops, len(r.path)) for r in met] == [(30, 31)]
    assert traverse.shortest_paths(chain, one("n00030")).agg(F.count("*"), F.max("hops")).first()[:] == (31, 30)


def test_distances_of_many_landmarks(spark, monkeypatch):
    monkeypatch.setattr(traverse, "_ROOTS_A_ROW", 64)
    monkeypatch.setattr(traverse, "distances", None)
    pairs, made = random_edges(spark, 120, 190, 21)
    marks = [f"n{i}" for i in range(100)] + ["elsewhere"]
    before, want = {}, set()
    for s, d in made:
        before.setdefault(d, []).append(s)
    for mark in marks:
        met, level, hops = {mark}, {mark}, 0
        while level:
            want |= {(v, mark, hops) for v in level}
            level = {s for v in level for s in before.get(v, [])} - met
            met, hops = met | level, hops + 1
    got = [tuple(r) for r in traverse.shortest_paths(pairs, spark.createDataFrame([(m,) for m in marks + marks], "id string")).collect()]
    assert len(got) == len(want) and set(got) == want


def test_distances_of_many_landmarks_by_levels(spark, monkeypatch):
    monkeypatch.setattr(traverse, "EDGES_SHARED", 0)
    test_distances_of_many_landmarks(spark, monkeypatch)


def test_distances_of_many_landmarks_take_no_job_a_level(spark, monkeypatch):
    written = []
    kept = traverse.store
    monkeypatch.setattr(traverse, "store", lambda df, name: written.append(name) or kept(df, name))
    chain = [(f"n{i}", f"n{i + 1}") for i in range(300)] + [("n7", "n7"), (None, "n0"), ("n9", None)]
    marks = [f"n{i}" for i in range(0, 301, 2)] + [None, "elsewhere"]
    pairs = spark.createDataFrame(chain, "src string, dst string")
    found = traverse.shortest_paths(pairs, spark.createDataFrame([(m,) for m in marks], "id string"))
    want = {(f"n{i}", f"n{m}", m - i) for m in range(0, 301, 2) for i in range(m + 1)} | {(None, f"n{m}", m + 1) for m in range(0, 301, 2)}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want | {(None, None, 0), ("elsewhere", "elsewhere", 0)}
    assert len(written) <= 2
    none = traverse.shortest_paths(pairs.limit(0), spark.createDataFrame([(m,) for m in marks], "id string"))
    assert {tuple(r) for r in none.collect()} == {(m, m, 0) for m in marks}


def test_nearest_targets(spark):
    pairs, made = random_edges(spark, 40, 70, 9)
    sources, targets = [f"n{i}" for i in range(0, 40, 3)], [f"n{i}" for i in range(0, 40, 7)]
    ids = lambda names: spark.createDataFrame([(n,) for n in names], "id string")
    best = plain_paths(made, 5)
    want = {}
    for s in sources:
        near = {t: best[s, t] for t in targets if (s, t) in best}
        want |= {(s, t): p for t, p in near.items() if len(p) == min(map(len, near.values()))}
    assert paths_of(traverse.bfs(pairs, ids(sources), ids(targets)), "src", "tgt") == want


def test_descendants_of_deep_trees(spark, monkeypatch):
    rounds = []
    kept = traverse.materialize
    monkeypatch.setattr(traverse, "materialize", lambda df: rounds.append(1) or kept(df))
    chain = spark.range(10_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    start = spark.createDataFrame([(0, 0), (9_000, 9_000)], "root long, node long")
    found = traverse.descendants(chain, start)
    assert {(r.root, r.n) for r in found.groupBy("root").agg(F.countDistinct("node").alias("n")).collect()} == {(0, 10_000), (9_000, 1_000)}
    assert len(rounds) < 30


def test_descendants_of_any_graph(spark):
    pairs, made = random_edges(spark, 30, 34, 6)
    starts = [("r", "n1"), ("r", "n2"), ("q", "n2"), ("q", "n7"), ("p", "n9")]
    out = {}
    for s, d in made:
        out.setdefault(s, set()).add(d)
    want = set()
    for root in "rqp":
        begin = {n for r, n in starts if r == root}
        seen, todo = set(begin), list(begin)
        while todo:
            for m in out.get(todo.pop(), ()):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        want |= {(root, n) for n in seen - begin}
    got = traverse.descendants(pairs, spark.createDataFrame(starts, "root string, node string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_walk_counts_keep_the_bag(spark):
    edges = spark.createDataFrame([("a", "b", "x"), ("a", "b", "y"), ("b", "c", "x"), ("z", "a", "x")], "src string, dst string, relationship string")
    roots = spark.createDataFrame([("c",)], "root string")
    got = {(r.src, r.relationship, r.depth): r.n_walks for r in traverse.upstream_walks(edges, roots, 3).collect()}
    assert got == {("b", "x", 1): 1, ("a", "x", 2): 1, ("a", "y", 2): 1, ("z", "x", 3): 2}


def test_stacked_aggregates_stay_merged_under_reuse(spark):
    def part(n):
        return spark.range(n).selectExpr("id % 10 AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))

    merged = stack(part(100), part(200)).groupBy("k").agg(F.count("*").alias("n"))
    joined = merged.join(merged.withColumnRenamed("n", "m"), "k").join(merged.withColumnRenamed("n", "o"), "k")
    assert joined.count() == 10


def test_first_entity_wins(spark):
    rows = spark.createDataFrame(
        [("p2", 0, 0, "t", "a"), ("p1", 1, 0, "t", "b"), ("p1", 0, 5, "t", "c"), ("p1", 0, 1, "", "d")],
        "path string, cell_no int, ord int, id string, name string",
    )
    assert [(r.id, r.name) for r in graph.dedupe_entities(rows).collect()] == [("t", "c")]


def test_lineage_documents_one_per_file(spark, tmp_path):
    entities = spark.createDataFrame([("p", "var:a", "variable", "a"), ("q", "var:b", "variable", "b")], "path string, id string, type string, name string")
    links = spark.createDataFrame([("p", "var:a", "var:c", "derives_from")], "path string, src string, dst string, type string")
    folder = str(tmp_path / "docs")
    lineage_files.write_lineage_json(lineage_files.lineage_documents(entities, links), folder, file_per_document=True)
    found, linked = lineage_files.read_lineage_json(spark, folder)
    assert {r.id for r in found.collect()} == {"var:a", "var:b"} and linked.count() == 1


def test_corrupt_path_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "p.csv").write_text("entity_id,path,fechora_ultima_ejecucion_job\n1,/a,2024-01-01 00:00:00\n2,/b,never\n")
    rows = paths.read_with_corrupt_rows(spark, str(tmp_path)).cache()
    assert rows.where(F.col(paths.CORRUPT).isNotNull()).count() == 1
    assert paths.detect_path_column(rows.select("entity_id", "path")) == "path"


def test_stream_state_ignores_a_lower_sequence(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "id string, v string, seq int"
    spark.createDataFrame([("a", "new", 2), ("b", "x", 1)], schema).write.parquet(folder)
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "check")

    def run():
        keyed.start_scd1(spark.readStream.schema(schema).parquet(folder), ["id"], ["seq"], log, checkpoint).awaitTermination()
        return {r.id: r.v for r in keyed.current(spark, log, ["id"], ["seq"]).collect()}

    assert run() == {"a": "new", "b": "x"}
    spark.createDataFrame([("a", "old", 1), ("b", "y", 2)], schema).write.mode("append").parquet(folder)
    assert run() == {"a": "new", "b": "y"}
    stream = keyed.scd1_state(spark.readStream.schema(schema).parquet(folder), ["id"], ["seq"])
    query = stream.writeStream.format("memory").queryName("latest_rows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.id: r.v for r in spark.table("latest_rows").collect()} == {"a": "new", "b": "y"}


def test_log_folds_while_it_runs_and_survives_a_new_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FOLD", 3)
    monkeypatch.setattr(keyed, "KEPT_MANIFESTS", 2)
    log, want = str(tmp_path / "log"), {}
    for n in range(11):
        rows = [(f"k{(n * i) % 7}", f"v{n}-{i}", (n * 13 + i) % 40) for i in range(3)]
        for key, value, seq in rows:
            want[key] = max(want.get(key, (-1, "")), (seq, value))
        keyed.append_part(spark.createDataFrame(rows, "id string, v string, seq int"), ["id"], ["seq", "v"], log, f"run-{n}")
        keyed.append_part(spark.createDataFrame(rows, "id string, v string, seq int"), ["id"], ["seq", "v"], log, f"run-{n}")  # a batch run again
    number, parts = keyed.log_parts(spark, log)
    assert number == 22 and len(parts) <= 6 and max(parts.values()) >= 2
    assert {r.id: (r.seq, r.v) for r in keyed.current(spark, log, ["id"], ["seq", "v"]).collect()} == want
    folder, schema = str(tmp_path / "in"), "id string, v string, seq int"
    spark.createDataFrame([("new", "x", 1)], schema).write.parquet(folder)
    for checkpoint in ("one", "two"):
        keyed.start_scd1(spark.readStream.schema(schema).parquet(folder), ["id"], ["seq", "v"], log, str(tmp_path / checkpoint)).awaitTermination()
    assert {r.id for r in keyed.current(spark, log, ["id"], ["seq", "v"]).collect()} == set(want) | {"new"}


def test_overwritten_path_lists_and_new_columns(spark, tmp_path):
    folder, log = tmp_path / "lists", str(tmp_path / "log")
    folder.mkdir()
    (folder / "a.csv").write_text("entity_id,path\n1,/a\n2,/b\n")
    (folder / "b.csv").write_text("path,entity_id\n/c,3\n")
    rows = lambda: sorted((r.path, r.entity_id, getattr(r, "owner", None)) for r in paths.ingested_paths(spark, log).collect())
    assert paths.ingest_paths(spark, str(folder), log, {"entity_id": "long"}) == 2
    assert rows() == [("/a", 1, None), ("/b", 2, None), ("/c", 3, None)] and paths.ingest_paths(spark, str(folder), log) == 0
    (folder / "a.csv").write_text("entity_id,path,owner\n1,/a2,ana\n")
    os.utime(folder / "a.csv", (2_000_000_000, 2_000_000_000))
    assert paths.ingest_paths(spark, str(folder), log, {"entity_id": "long"}) == 1
    assert rows() == [("/a2", 1, "ana"), ("/c", 3, None)]


def test_keywords_by_blocks_equal_the_plain_formula(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(search, "BLOCK_WORDS", 40)
    monkeypatch.setattr(search, "WORD_SLICE", 3)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(15)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(1, 9))) for i in range(300)] + [(7, "w1 w2 other"), (None, "w1"), (None, "w1 w3"), (301, None), (302, "")]
    asked = [(f"q{i}", text(3)) for i in range(11)] + [("none", "nothing"), ("null", None)]
    docs, queries = spark.createDataFrame(rows, "id long, text string").repartition(5), spark.createDataFrame(asked, "query_id string, text string")
    held, lengths = {}, {}
    for i, t in rows:
        if t and i != 7 and i is not None:
            held[i], lengths[i] = {w: t.split().count(w) for w in t.split()}, len(t.split())
    both = [t.split() for i, t in rows if i == 7]
    got = {(r.query_id, r.id): r.score for r in search.keyword_scores(docs, queries).collect()}
    df = {w: sum(w in h for h in held.values()) + (w in both[0] + both[1]) + (w in ("w1", "w3")) for w in words}
    known = [len(t.split()) for _, t in rows if t is not None]
    mean = sum(known) / len(known)
    idf = {w: np.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    want = {
        (q, i): sum(idf[w] * h[w] * 2.2 / (h[w] + 1.2 * (0.25 + 0.75 * lengths[i] / mean)) for w in set(t.split()) if w in h)
        for q, t in asked if t for i, h in held.items() if set(t.split()) & set(h)
    }
    assert {k for k in got if k[1] not in (7, None)} == set(want) and all(abs(got[k] - v) < 1e-6 for k, v in want.items())
    order = {q: sorted((-s, -1 if i is None else i, i) for (p, i), s in got.items() if p == q) for q in {q for q, _ in got}}
    best = {(r.query_id, r["rank"]): r.id for r in search.keyword_search(docs, queries, 5).collect()}
    assert best == {(q, n + 1): i for q, found in order.items() for n, (_, _, i) in enumerate(found[:5])}
    wanted = [(q, i) for q in ("q0", "q5", "none") for i in (0, 7, 150, 299)]
    places = search.keyword_ranks(search.keyword_index(docs, queries), spark.createDataFrame(wanted, "query_id string, id long"))
    assert {(r.query_id, r.id): r["rank"] for r in places.collect()} == {
        (q, i): [x[2] for x in order[q]].index(i) + 1 for q, i in wanted if q in order and i in [x[2] for x in order[q]]
    }


def test_keyword_search_makes_no_row_for_every_pair(spark):
    docs = spark.range(3000).select("id", F.lit("every text the same").alias("text"))
    queries = spark.range(20).select(F.concat(F.lit("q"), "id").alias("query_id"), F.lit("same text").alias("text"))
    ids = {(r.query_id, r["rank"]): r.id for r in search.keyword_search(docs.coalesce(2), queries, 3).collect()}
    assert ids == {(f"q{q}", n + 1): n for q in range(20) for n in range(3)}
    kept = search._best_of(pa.array(range(3000)), np.ones((3000, 2)), pa.array(["a", "b"]), 3)
    assert kept.column("id").to_pylist() == [0, 1, 2] * 2


def test_upstream_walks_shuffle_no_level_twice(spark):
    edges = spark.createDataFrame([("a", "b", "t"), ("b", "c", "t"), ("a", "c", "t"), ("c", "a", "u")], "src string, dst string, relationship string")
    roots = spark.createDataFrame([("c",), ("c",), (None,)], "root string")
    found = traverse.upstream_walks(edges, roots, 4)
    assert found._jdf.queryExecution().executedPlan().toString().count("Join") <= 1  # what was walked is stored level by level
    walks, want = [("c", "c", 1)] * 2, {}
    while walks:
        ahead = []
        for root, node, depth in walks:
            for src, dst, kind in edges.collect() if depth <= 4 else []:
                if dst == node:
                    want[(root, src, dst, kind, depth)] = want.get((root, src, dst, kind, depth), 0) + 1
                    ahead.append((root, src, depth + 1))
        walks = ahead
    assert {tuple(r)[:5]: r.n_walks for r in found.collect()} == want


def test_files_of_line_items_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_changes, "LINES_A_FILE", 100)
    rows = spark.range(2000).selectExpr("id AS l_orderkey", "id % 50 AS l_partkey", "id % 7 AS l_suppkey", "1 AS l_linenumber", "double(id % 9) AS l_quantity",
                                        "'A' AS l_returnflag", "'F' AS l_linestatus", "timestamp'2024-01-01 00:00:00' + make_dt_interval(int(id * 37 % 300)) AS l_shipdate")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    folder = queries_changes._line_files(spark, str(tmp_path), [F.expr(queries_changes._TIE).alias("tie")])
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 1000 and len(sizes) >= 10
    got = {r.id: (r.entity_name, str(r.created_on)) for r in queries_changes.t2(spark, str(tmp_path)).collect()}
    last = {f"n:{r.l_partkey}": str(r.day) for r in rows.groupBy("l_partkey").agg(F.to_date(F.max("l_shipdate")).alias("day")).collect()}
    assert got == {i: ("AF", day) for i, day in last.items()}


def test_code_files_a_task_are_bounded(spark, monkeypatch, tmp_path):
    from threadline.plans import inputs

    spark.range(1000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(inputs, "FILES_A_TASK", 20)
    files = inputs.code_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() == 50 and files.count() == 1000


def test_rows_of_one_batch_of_files_are_handed_on_in_pieces(spark, monkeypatch):
    from threadline.operators import python_lineage

    monkeypatch.setattr(python_lineage, "_FLUSH_ROWS", 10)
    files = spark.range(30).coalesce(1).selectExpr("concat('f', id) AS path", "if(id = 7, 'x = (', 'x = 1') AS text")
    tree = python_lineage.ast_nodes(files)
    assert tree.where("error IS NULL").groupBy("file").count().distinct().count() == 29 and tree.where("error IS NOT NULL").count() == 1
