"""Packing of documents into sequences of equal length by non-negative least squares.

Documents are cut into whole windows and a rest. How many rests there are of each length is one small
histogram. Shallow combinations of two or three lengths that fill a window exactly are enumerated, and
non-negative least squares finds how often to repeat each so that together they use the histogram up.
The counts are rounded down; what they leave is packed greedily, largest first, each next piece filling
the open sequence and running over into the next one, so only the last sequence has room left.

Where a piece goes follows from its length and its rank among the pieces of that length, so pieces are
never gathered: ranks are counted where a piece is made and shifted by sums per (partition, length).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadline.llm import bpe
from threadline.llm.frames import each_text, stored, texts

_PIECES = "part int, doc_id long, start long, length int, local_rank long, doc_tokens long, crc long, ids binary"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Second lengths tried for each first length of a triple, and gradient steps of the least squares.
SECONDS, STEPS = 12, 400


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to the window, of lengths that occur."""
    present = np.flatnonzero(counts[:window])
    present = present[present > 0]
    has = np.zeros(window + 1, bool)
    has[present] = True
    pairs = present[(present * 2 <= window) & has[window - present]]
    rows = [np.stack([window - pairs, pairs, 0 * pairs], axis=1)]
    for first in present[(present * 3 >= window) & (present < window - 1)]:
        left = window - first
        seconds = present[(present * 2 >= left) & (present <= min(first, left - 1))]
        seconds = seconds[has[left - seconds]]
        # the commonest lengths, so that what is left over is spread thin
        weight = np.minimum(counts[seconds], counts[left - seconds])
        seconds = seconds[np.argsort(-weight, kind="stable")[:SECONDS]]
        rows.append(np.stack([0 * seconds + first, seconds, left - seconds], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def repeat_counts(counts: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """Whole numbers of repeats near the non-negative least squares solution that use no length up twice."""
    if not len(combos):
        return np.zeros(0, np.int64)
    target = counts.astype(np.float64).copy()
    target[0] = 0
    size = len(counts)
    flat = combos.ravel()
    real = (flat > 0).astype(np.float64)
    degree = np.bincount(flat, real, size)
    bound = 3.0 * max(degree[1:].max(), 1.0)  # of the largest eigenvalue of A'A, by its row and column sums
    x = np.zeros(len(combos))
    y, speed = x, 1.0
    for _ in range(STEPS):
        rest = np.bincount(flat, real * np.repeat(y, 3), size) - target
        rest[0] = 0
        gradient = rest[combos].sum(axis=1)
        following = np.maximum(0, y - gradient / bound)
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        y = following + (speed - 1) / faster * (following - x)
        x, speed = following, faster
    left = counts.astype(np.int64).copy()
    repeats = np.zeros(len(combos), np.int64)
    for j in np.argsort(-x, kind="stable"):
        wanted = int(x[j] + 0.5)
        if not wanted:
            break
        lengths, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
        repeats[j] = min(wanted, int((left[lengths] // times).min()))
        left[lengths] -= times * repeats[j]
    return repeats


class Plan:
    """Where the piece of each (length, rank) goes; its size depends on the window alone."""

    def __init__(self, counts: np.ndarray, window: int):
        self.window = window
        whole = int(counts[window])
        combos = combinations(counts, window)
        repeats = repeat_counts(counts, combos)
        used = np.flatnonzero(repeats)
        taken = np.zeros(window + 1, np.int64)
        taken[window] = whole
        rows = [(window, 0, whole, 0, 0)] if whole else []
        sequence = whole
        for j in used.tolist():
            offset, n = 0, int(repeats[j])
            for length in combos[j][combos[j] > 0].tolist():
                rows.append((length, int(taken[length]), n, sequence, offset))
                taken[length] += n
                offset += length
            sequence += n
        rows.sort()
        slots = np.array(rows, np.int64).reshape(-1, 5)
        self.length, self.first, self.repeats, self.sequence, self.offset = slots.T
        # a slot's key: length and first rank, for one search over all slots
        self.taken = taken
        self.rest = counts.astype(np.int64) - taken
        tokens = self.rest * np.arange(window + 1)
        self.rest_at = np.cumsum(tokens[::-1])[::-1] - tokens
        self.sequences = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece's beginning; a left-over piece may run over into the next sequence."""
        rest = rank >= self.taken[length]
        at = self.rest_at[length] + (rank - self.taken[length]) * length
        sequence, offset = self.sequences + at // self.window, at % self.window
        if len(self.length):
            scale = int(max(self.first.max(), rank.max(initial=0))) + 1
            keys = self.length.astype(object) * scale + self.first if scale * (self.window + 1) >= 1 << 62 else self.length * scale + self.first
            slot = np.maximum(np.searchsorted(keys, length * scale + rank, "right") - 1, 0)
            sequence = np.where(rest, sequence, self.sequence[slot] + rank - self.first[slot])
            offset = np.where(rest, offset, self.offset[slot])
        return sequence, offset


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, gapless from offset 0.

    Every document ends with ``end_id``, so null and empty texts are one token long. Repeated rows and null
    ids are documents of their own. An empty table gives no pieces. No sequence but the last has padding.
    """
    return _placed(docs, path, window, end_id, key, text).drop("ids")


def packed_ids(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """The pieces of ``pack`` with ``ids``, little-endian unsigned 32-bit."""
    return _placed(docs, path, window, end_id, "doc_id", "text", keep_ids=True)


def _placed(docs, path, window, end_id, key, text, keep_ids=False):
    def cut(batches):
        part = TaskContext.get().partitionId()
        ranks = np.zeros(window + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("local_rank", pa.int64()), ("doc_tokens", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
        rows, held = [], 0
        for batch, values in each_text(batches):
            for doc, value in zip(batch.column("doc_id"), values, strict=True):
                raw = bpe.token_bytes(path, value) + end
                n = len(raw) // 4
                for start in range(0, n, window):
                    piece = raw[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    ids = np.frombuffer(piece, "<u4")
                    narrow = ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else piece
                    rows.append((part, doc.as_py(), start, length, int(ranks[length]), n, zlib.crc32(piece), narrow))
                    ranks[length] += 1
                    held += len(narrow)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    spark = docs.sparkSession
    pieces = stored(texts(docs, key, text).mapInArrow(cut, _PIECES), "pieces")
    made = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # at most one row per length
    counts = np.zeros(window + 1, np.int64)
    for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    plan = Plan(counts, window)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = made.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), "n")
    # the part in which each length begins to be left over: before it no piece of that length is cut
    taken = {length: int(n) for length, n in enumerate(plan.taken) if plan.rest[length] > 0}
    left = {
        r["length"]: r["part"]
        for r in bases.join(_by_length(spark, taken, "taken"), "length").where("taken < base + n").groupBy("length").agg(F.min("part").alias("part")).collect()
    }

    columns = ["part", "doc_id", "start", "length", "local_rank", "doc_tokens", "crc", "base"]

    def place(batches):
        for batch in batches:
            length, rank, base, start, crc = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "local_rank", "base", "start", "crc"))
            sequence, offset = plan.place(length, base + rank)
            fits = np.minimum(length, window - offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), pa.array(start), pa.array(length, pa.int32()), batch.column("local_rank"), batch.column("doc_tokens"), pa.array(crc), pa.array(sequence), pa.array(offset), pa.array(fits)],
                ["part", "doc_id", "start", "length", "local_rank", "doc_tokens", "crc", "sequence_id", "offset", "fits"],
            )

    where = stored(
        pieces.drop("ids").join(bases.drop("n"), ["part", "length"]).select(*columns).mapInArrow(
            place, "part int, doc_id long, start long, length int, local_rank long, doc_tokens long, crc long, sequence_id long, offset long, fits long"
        ),
        "placed",
    )
    is_cut = F.col("fits") < F.col("length")
    uncut = where.where(~is_cut)
    narrow = F.length("ids") == 2 * F.col("length")

    def split(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<u2" if r["narrow"] else "<u4").astype("<u4")
                sequence, offset = r["sequence_id"], r["offset"]
                for a, b in ((0, r["fits"]), (r["fits"], r["length"])) if r["fits"] < r["length"] else ((0, r["length"]),):
                    raw = ids[a:b].tobytes()
                    rows.append((r["doc_id"], r["start"] + a, b - a, zlib.crc32(raw), r["doc_tokens"], sequence, offset, raw if keep_ids else b""))
                    sequence, offset = sequence + 1, 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 7 + [pa.binary()], strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    named = uncut.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", F.lit(b"").alias("ids"))
    with_ids = pieces.select("part", "length", "local_rank", "ids", narrow.alias("narrow"))
    keys = ["part", "length", "local_rank"]
    if keep_ids:
        return where.drop("crc").join(with_ids, keys).mapInArrow(split, _PLACED + ", ids binary")
    if not left:
        return named
    late = with_ids.join(_by_length(spark, left, "since"), "length").where("part >= since").drop("since")
    cut_rows = where.where(is_cut).drop("crc").join(late, keys)
    return named.unionByName(cut_rows.mapInArrow(split, _PLACED + ", ids binary"))


def _by_length(spark, values: dict[int, int], name: str) -> DataFrame:
    """At most one row per length, so its size is bounded by the window."""
    return F.broadcast(spark.createDataFrame(list(values.items()), f"length int, {name} long"))
