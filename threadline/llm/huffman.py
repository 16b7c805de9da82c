"""Token ids in files: canonical length-limited Huffman codes from global counts.

A stored table is a folder with two Parquet tables. ``codebook`` holds a code length per id; canonical
codes follow from the lengths. ``blocks`` has a folder per range of documents, in ascending
order, with rows that decode on their own: whole documents, their ids as one bit string, and the bit offset of every ``STEP``-th id, so that all
stretches between checkpoints are decoded side by side through one table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.llm import bpe
from threadline.llm.frames import each_text, stored, texts
from threadline.session import scratch_path

#: Ids between checkpoints; ids after which a block is closed; longest code in bits.
STEP, BLOCK_IDS, MAX_BITS = 256, 1 << 19, 20

_BLOCK = "part int, start long, doc_ids array<long>, lengths array<long>, bits long, checkpoints binary, payload binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Best code lengths of at most ``max_bits`` by package-merge; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need codes of more than {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    leaves, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        leaves.append(np.cumsum(order < len(weights)))
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * len(used) - 2
    for seen in reversed(leaves):
        if not taken:
            break
        n = int(seen[taken - 1])
        lengths[used[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each the one before plus one, widened to its length."""
    codes = np.zeros(len(lengths), np.uint64)
    code, width = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[np.count_nonzero(lengths == 0):].tolist():
        code <<= int(lengths[i]) - width
        width = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """Number of bits, checkpoints and big-endian 32-bit words of the bit string."""
    wide = lengths.astype(np.int64)
    left = codes << (64 - wide).astype(np.uint64)
    width = wide[ids]
    ends = np.cumsum(width)
    begins = ends - width
    bits = int(ends[-1]) if len(ids) else 0
    packed = np.zeros((bits >> 5) + 2, np.uint64)
    if len(ids):
        value = left[ids] >> (begins & 31).astype(np.uint64)
        word = begins >> 5
        # codes fill disjoint bits; no code is longer than a word, so one begins in every word and words follow each other
        value = np.bitwise_or.reduceat(value, np.flatnonzero(np.diff(word, prepend=-1)))
        packed[: len(value)] = value >> np.uint64(32)
        packed[1 : len(value) + 1] |= value & np.uint64(0xFFFFFFFF)
    return bits, begins[::STEP], packed.astype(">u4").tobytes()


class Decoder:
    """Looks every id up by the next ``max_bits`` bits."""

    def __init__(self, lengths: np.ndarray):
        self.max_bits = max(int(lengths.max(initial=0)), 1)
        codes = canonical_codes(lengths)
        self.ids = np.zeros(1 << self.max_bits, np.uint32)
        self.widths = np.zeros(1 << self.max_bits, np.uint8)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = 1 << (self.max_bits - lengths[order].astype(np.int64))
        filled = int(spans.sum())
        self.ids[:filled] = np.repeat(order, spans)
        self.widths[:filled] = np.repeat(lengths[order], spans)
        assert not len(order) or int(codes[order[0]]) == 0

    def decode(self, n: int, checkpoints: np.ndarray, payload: bytes) -> np.ndarray:
        words = np.frombuffer(payload, ">u4").astype(np.uint64)
        # the last stretch may end early and then reads on behind the payload
        pairs = np.zeros(len(words) + STEP * self.max_bits // 32 + 1, np.uint64)
        pairs[: len(words) - 1] = (words[:-1] << np.uint64(32)) | words[1:]
        out = np.zeros((STEP, len(checkpoints)), np.uint32)
        at = checkpoints.astype(np.int64)
        top, mask = 64 - self.max_bits, np.uint64((1 << self.max_bits) - 1)
        for k in range(STEP):
            window = ((pairs[at >> 5] >> (top - (at & 31)).view(np.uint64)) & mask).view(np.int64)
            out[k] = self.ids[window]
            at += self.widths[window]
        return out.T.reshape(-1)[:n]


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of ``doc_id``.

    Null and empty texts hold the end id alone. Rows with the same id follow each other in the order of
    their texts' hashes; null ids come first. An empty table gives an empty codebook and no blocks. Texts
    are dealt by range of (id, hash), so neither a frequent text nor one long document decides the size of
    a task beyond its own.
    """
    ordered = (
        texts(docs, key, text)
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def tokenize(batches):
        part, at = TaskContext.get().partitionId(), 0
        counts, waiting, uncounted = np.zeros(1, np.int64), [], 0

        def counted():
            seen = np.bincount(np.concatenate(waiting), minlength=len(counts))
            seen[: len(counts)] += counts
            return seen

        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
        rows, held = [], 0
        for batch, values in each_text(batches):
            for doc, value in zip(batch.column("doc_id").to_pylist(), values, strict=True):
                ids = np.frombuffer(bpe.token_bytes(path, value) + end, "<u4")
                narrow = ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else ids.tobytes()
                rows.append((part, doc, at, len(ids), narrow))
                at += len(ids)
                waiting.append(ids)
                uncounted += len(ids)
                if uncounted >= BLOCK_IDS:  # an array as long as the vocabulary for each document would cost more than its ids
                    counts, waiting, uncounted = counted(), [], 0
                held += len(narrow)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
        if waiting:
            counts = counted()
        if at:  # the last row of a part: how often it has each id
            rows.append((part, None, -1, at, counts.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    written = stored(ordered.mapInArrow(tokenize, "part int, doc_id long, at long, n long, ids binary"), "token-ids")
    tokens, totals = written.where("at >= 0"), written.where("at < 0")

    def histogram(batches):
        for batch in batches:
            for each in batch.column("ids"):
                counts = np.frombuffer(each.as_py(), "<i8")
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["id", "n"])

    spark = docs.sparkSession
    # at most one row per id of the vocabulary, and one per partition
    counted = totals.select("ids").mapInArrow(histogram, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    sizes = totals.select("part", "n").orderBy("part").collect()
    counts = np.zeros(max((r["id"] for r in counted), default=-1) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    bases, total = {}, 0
    for r in sizes:
        bases[r["part"]] = total
        total += r["n"]

    def pack(batches):
        bpe.forget()
        codes = canonical_codes(lengths)
        rows, ids, part = [], [], None

        def block():
            everything = np.concatenate(ids)
            bits, checkpoints, payload = encode_ids(everything, codes, lengths)
            return {"part": part, "start": bases[part] + rows[0][1], "doc_ids": [r[0] for r in rows], "lengths": [len(x) for x in ids], "bits": bits, "checkpoints": checkpoints.astype("<u8").tobytes(), "payload": payload}

        schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bits", pa.int64()), ("checkpoints", pa.binary()), ("payload", pa.binary())])
        held = 0
        for batch in batches:
            for p, doc, at, n, packed in zip(*(batch.column(c) for c in ("part", "doc_id", "at", "n", "ids")), strict=True):
                follows = rows and p.as_py() == part and at.as_py() == rows[-1][1] + len(ids[-1])
                if rows and (not follows or held >= BLOCK_IDS):
                    yield pa.RecordBatch.from_pylist([block()], schema)
                    rows, ids, held = [], [], 0
                part = p.as_py()
                rows.append((doc.as_py(), at.as_py()))
                ids.append(_wide(packed.as_py(), n.as_py()))
                held += len(ids[-1])
        if rows:
            yield pa.RecordBatch.from_pylist([block()], schema)

    tokens.mapInArrow(pack, _BLOCK).write.option("compression", "none").partitionBy("part").parquet(f"{folder}/blocks")
    used = np.flatnonzero(lengths)
    rows = [(int(i), int(lengths[i])) for i in used]
    spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: every document's ids as little-endian 32-bit integers, decoded from the files."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in book), default=-1) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["bits"]

    def unpack(batches):
        bpe.forget()
        decoder = Decoder(lengths)
        for batch in batches:
            for start, docs, sizes, checkpoints, payload in zip(*(batch.column(c).to_pylist() if c in ("doc_ids", "lengths") else (v.as_py() for v in batch.column(c)) for c in ("start", "doc_ids", "lengths", "checkpoints", "payload")), strict=True):
                sizes = np.array(sizes, np.int64)
                ends = np.cumsum(sizes)
                ids = decoder.decode(int(ends[-1]), np.frombuffer(checkpoints, "<u8"), payload).astype("<u4")
                raw = memoryview(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()), pa.array(start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([bytes(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return spark.read.schema(_BLOCK).parquet(f"{folder}/blocks").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def token_files_digest(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write the files to the shared store, read them back, and give start, length and crc32 of each document."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, folder, end_id)
    spark = docs.sparkSession
    back = read_token_files(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _wide(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4").astype(np.int64)
