"""Near-duplicate documents by SimHash, found through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments. Of three differing bits at most one falls into one of the
segments, so that segment agrees in all bits but at most one: fingerprints that link share one of their
64 signatures, each a segment with one bit struck out. Rows of a signature are compared directly, and
only edges of a spanning forest leave a signature, never its pairs. Components come from star
contraction over fingerprints, so copies of a text are one vertex.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.llm.frames import each_text, stored, texts
from threadline.session import materialize

#: Distinct fingerprints of one signature above which the other segment's bytes divide them further.
LARGE_GROUP = 2048


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of every shingle; 0 without words; fewer words than a shingle are one."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    shingles = map(b" ".join, zip(*(words[k : k + n] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row."""

    def run(batches):
        for batch, values in each_text(batches):
            marks = np.fromiter((fingerprint(v, shingle) for v in values), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    return texts(docs, key, text).mapInArrow(run, "doc_id long, fp long")


def _forest(marks: np.ndarray, bits: int) -> list[np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints, breadth first."""
    edges, left = [], marks
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = np.bitwise_count(left ^ one) <= bits
            if near.any():
                found = left[near]
                edges.append(np.stack([np.full(len(found), one), found], axis=1))
                frontier.extend(found)
                left = left[~near]
    return edges


def _group_edges(marks: np.ndarray, other: int, bits: int) -> list[np.ndarray]:
    """Edges among one signature's fingerprints; ``other`` shifts the segment that is not in the signature."""
    if len(marks) <= LARGE_GROUP:
        return _forest(marks, bits)
    edges = []
    for byte in range(4):  # of at most three differing bits one of four bytes has none
        value = (marks >> np.uint64(other + 8 * byte)) & np.uint64(255)
        order = np.argsort(value, kind="stable")
        cuts = np.flatnonzero(np.diff(value[order])) + 1
        for part in np.split(marks[order], cuts):
            edges += _forest(part, bits)
    return edges


def links(marks: DataFrame, bits: int = 3) -> DataFrame:
    """``a, b``: edges that connect the same fingerprints as all links at ``bits`` or fewer differing bits do.

    ``marks`` has distinct ``fp``. A signature's rows are the distinct fingerprints that agree in 31 given
    bits; they stream through one task in order and are held once, as 8 bytes each.
    """
    if bits > 3:
        raise ValueError("two segments find links of at most three bits")
    k = F.col("k")
    segment = F.when(k < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    struck = F.element_at(F.array(*[F.lit(0xFFFFFFFF ^ (1 << b)).cast("long") for b in range(32)]), k % 32 + 1)
    signatures = (
        marks.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"))
        .select((k.cast("long") * F.lit(1 << 32) + segment.bitwiseAND(struck)).alias("key"), "fp")
        .repartition("key")
        .sortWithinPartitions("key", "fp")
    )

    def run(batches):
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        pending: list[np.ndarray] = []

        def compare(keys, fps):
            cuts = np.flatnonzero(np.diff(keys)) + 1
            begins = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([begins, [len(keys)]]))
            pairs = begins[sizes == 2]
            near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= bits
            out = [np.stack([fps[pairs[near]], fps[pairs[near] + 1]], axis=1)]
            for b, n in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                out += _group_edges(fps[b : b + n], 32 if keys[b] >> 32 < 32 else 0, bits)
            found = np.unique(np.concatenate(out).view(np.int64), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new_keys = batch.column("key").to_numpy()
            new_fps = batch.column("fp").to_numpy().view(np.uint64)
            pending.append((new_keys, new_fps))
            if new_keys[-1] == pending[0][0][0] and len(pending) > 1:
                continue  # still within one group
            keys = np.concatenate([p[0] for p in pending])
            fps = np.concatenate([p[1] for p in pending])
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield compare(keys[:last], fps[:last])
            pending = [(keys[last:], fps[last:])]
        if pending:
            yield compare(np.concatenate([p[0] for p in pending]), np.concatenate([p[1] for p in pending]))

    return signatures.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v, root``: the smallest vertex each vertex of an edge can reach, by large-star and small-star rounds.

    Each round ends in a reliable checkpoint; the driver sees one count and one sum.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("mark")).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = state
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # after a large-star round every edge points from a vertex to a smaller one
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct())


def simhash_components(docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id its fingerprint can reach.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows stay rows of their
    own and share a component. A null id is never the smallest unless a component has no other.
    """
    marks = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    smallest = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(smallest.select("fp"), bits)).withColumnRenamed("v", "fp")
    rooted = materialize(smallest.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marks.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _row_key(columns: list[str]) -> Column:
    """128 bits of a whole row, nulls told apart from other values."""
    parts = [c for name in columns for c in (F.col(f"`{name}`").cast("string"), F.col(f"`{name}`").isNull())]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def keep_first(docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id, of equal ids the smallest by a hash of the whole row.

    Null ids come after all others. Rows stand for themselves, so rows of different components never replace
    each other, whatever their ids; of wholly equal rows one stays.
    """
    columns = docs.columns
    read = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), _row_key(columns).alias("row"))

    def run(batches):
        for batch, values in each_text(batches):
            marks = np.fromiter((fingerprint(v, shingle) for v in values), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64)), batch.column("row")], ["doc_id", "fp", "row"])

    marks = stored(read.mapInArrow(run, "doc_id long, fp long, row struct<a: long, b: long>"), "fingerprints")
    roots = components(links(marks.select("fp").distinct(), bits)).withColumnRenamed("v", "fp")
    rooted = marks.groupBy("fp", "doc_id", "row").agg(F.count("*").alias("n")).join(roots, "fp", "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min_by(F.struct("doc_id", "row", "n"), order).alias("first"))
    firsts = stored(first.select("first.*"), "survivors")
    known = docs.withColumn("__row", _row_key(columns))
    kept = lambda several: known.join(firsts.where(F.col("n") > 1 if several else F.col("n") == 1).select(F.col("row").alias("__row")), "__row", "left_semi")
    once = kept(False).select(*columns)
    if firsts.where("n > 1").isEmpty():
        return once
    again = kept(True).groupBy("__row").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("__first")).select("__first.*")
    return once.unionByName(again)
