"""Phrases whose words keep company, per language, from whole texts.

The first pass counts the n-grams of a stretch of text and sends their hashes and counts to hash partitions.
A partition merges them in a Misra-Gries summary whose capacity exceeds its mass divided by the threshold,
so that every n-gram frequent enough survives. The second pass counts the n-grams that survived exactly, as
text. What follows (cuts, scores, contained phrases, ranks) are joins and aggregates over the frequent
phrases.
"""

from __future__ import annotations

from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadline.llm.frames import stored

#: Bytes of text whose n-grams are counted together before they leave a task.
CHUNK_BYTES = 8 << 20
#: Words a task remembers between chunks.
KNOWN_WORDS = 1 << 20
#: Hash partitions at least, and bytes of text for which there is one.
LEAST_PARTS, PART_BYTES = 256, 64 << 20
#: Capacity of a summary as a multiple of mass / threshold; what exceeds 1 leaves fewer n-grams that only seem frequent.
MARGIN = 4
#: Bits of the filter that carries the survivors to the second pass, whatever their number.
FILTER_BITS = 1 << 27
#: Groups a language's phrases are ranked in before its best are ranked together.
RANK_GROUPS = 256

_TEXT = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """Numbers of words in the order they are met, with their hashes; 0 is the end of a piece."""

    def __init__(self):
        self.known, self.hashes = {b".": 0}, array("Q", [0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        for word in set(words).difference(self.known):
            self.known[word] = len(self.known)
            self.hashes.append(xxhash.xxh64_intdigest(word))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


class Chunk:
    """The words of some texts of one language, piece after piece, with numbers and hashes of their n-grams."""

    def __init__(self, lang: str, text: bytes, known: _Words, longest: int):
        import xxhash

        self.lang = lang
        self.words = text.translate(_TEXT).replace(b".", b" . ").split()  # of bytes: ASCII white space only
        self.numbers = known.numbers(self.words)
        self.n = int(np.count_nonzero(self.numbers))
        hashes = np.frombuffer(known.hashes, np.uint64)[self.numbers]
        start = np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))
        #: by length: places where an n-gram starts that stays within its piece, and the n-grams' hashes
        self.places, self.keys = [], []
        whole, rolled = np.ones(len(self.words), bool), np.full(len(self.words), start, np.uint64)
        for k in range(longest):
            end = max(len(self.words) - k, 0)
            whole = whole[:end] & (self.numbers[k:] != 0)
            rolled = _mixed((rolled[:end] + hashes[k:]) * _ODD + np.uint64(k))
            places = np.flatnonzero(whole)
            self.places.append(places)
            self.keys.append(rolled[places])


def _chunks(batches, longest: int):
    """Chunks of about CHUNK_BYTES of lang, text rows, each of one language; all of a round share word numbers."""
    waiting: dict[str, list[bytes]] = {}
    size, known = 0, _Words()

    def flush():
        nonlocal size, known
        for lang, texts in waiting.items():
            yield Chunk(lang, b".".join(texts), known, longest)
        waiting.clear()
        size = 0
        if len(known.known) > KNOWN_WORDS:
            known = _Words()

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            value = text.as_buffer()
            value = value.to_pybytes() if value is not None else b""
            waiting.setdefault(lang.as_py(), []).append(value)
            size += len(value) + 1
            if size >= CHUNK_BYTES:
                for chunk in flush():
                    yield chunk, known
    for chunk in flush():
        yield chunk, known


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


class Summary:
    """Misra-Gries counters of 32-bit keys; ``lost`` bounds how far any counter is below its key's count."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge another summary, or plain counts. Mass and order of the merges do not matter for the bound."""
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)]).astype(np.int64)
        self.waiting, self.size = [], 0
        if not len(keys):
            return
        packed = np.sort(keys.astype(np.uint64) << np.uint64(32) | np.arange(len(keys), dtype=np.uint64))
        keys = (packed >> np.uint64(32)).astype(np.uint32)
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[begins], np.add.reduceat(counts[(packed & np.uint64(0xFFFFFFFF)).astype(np.int64)], begins)
        if len(keys) > self.capacity:
            at = len(counts) - self.capacity - 1
            cut = int(np.partition(counts, at)[at])  # the largest counter beyond the capacity
            self.lost += cut
            left = counts > cut
            keys, counts = keys[left], counts[left] - cut
        self.keys, self.counts = keys, counts

    def reaching(self, least: int) -> np.ndarray:
        """Keys whose count may be ``least`` or more: all that are, while ``lost`` is below ``least``."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


class Filter:
    """Which n-gram hashes survived: two bits a key in a slice of bits for each hash partition."""

    def __init__(self, parts: int):
        self.shift = np.uint64(64 - (parts.bit_length() - 1))
        self.bits = max(64, FILTER_BITS // parts)
        self.parts, self.slices = parts, None

    def _at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two places of 32-bit keys within a slice."""
        k = keys.astype(np.uint64)
        width = np.uint64(64 - (self.bits.bit_length() - 1))
        return (k * _ODD) >> width, (k * np.uint64(0xD6E8FEB86659FD93)) >> width

    def slice_of(self, keys: np.ndarray) -> bytes:
        marks = np.zeros(self.bits, bool)
        for at in self._at(keys):
            marks[at.astype(np.int64)] = True
        return np.packbits(marks, bitorder="little").tobytes()

    def put(self, part: int, marks: bytes) -> None:
        size = self.bits // 8
        if self.slices is None:
            self.slices = np.zeros(self.parts * size, np.uint8)
        self.slices[part * size : (part + 1) * size] = np.frombuffer(marks, np.uint8)

    def passing(self, keys: np.ndarray) -> np.ndarray:
        part, rest = split_key(keys, self.shift)
        found = np.full(len(keys), self.slices is not None)
        for at in self._at(rest) if len(keys) and found[0] else ():
            place = (part * np.uint64(self.bits) + at).astype(np.int64)
            found &= (self.slices[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return found


def split_key(keys: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition of a 64-bit key, its top bits, and the 32 bits below those."""
    return keys >> shift, (keys >> (shift - np.uint64(32))).astype(np.uint32)


def parts_of(n_bytes: int) -> int:
    """Hash partitions for so much text: a power of two, so that a partition's mass stays bounded."""
    return 1 << max(LEAST_PARTS - 1, n_bytes // PART_BYTES).bit_length()


def survivors(docs: DataFrame, least: int, longest: int) -> Filter:
    """First pass over ``lang, text``: all n-grams that occur ``least`` times or more, and few others.

    A chunk's n-grams go to their partition as 32-bit keys with counts, after a row with their mass; a task
    reads the masses of a partition first and then knows the capacity. It holds one summary at a time. The
    driver gets the filter alone, of fixed size.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_of(n_bytes)
    found = Filter(parts)
    shift = found.shift

    def count(batches):
        for chunk, _ in _chunks(batches, longest):
            keys = np.sort(np.concatenate(chunk.keys))
            if not len(keys):
                continue
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(begins, len(keys))).astype(np.uint32)
            part, rest = split_key(keys[begins], shift)
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            names = part[cuts].astype(np.int32)
            mass = np.add.reduceat(counts.astype(np.int64), cuts)
            ends = np.append(cuts[1:], len(part))
            for a in range(0, len(cuts), 4096):
                own = slice(a, a + 4096)
                spans = list(zip(cuts[own].tolist(), ends[own].tolist(), strict=True))
                n = len(spans)
                nothing = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(mass[own]), nothing, nothing], _NAMES)
                keyed = pa.array([rest[b:e].tobytes() for b, e in spans], pa.binary())
                counted = pa.array([counts[b:e].tobytes() for b, e in spans], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.nulls(n, pa.int64()), keyed, counted], _NAMES)

    def merge(batches):
        part, mass, summary = None, 0, None

        def ended():
            keys = summary.reaching(least) if summary else np.empty(0, np.uint32)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([found.slice_of(keys)], pa.binary())], ["part", "marks"])

        for batch in batches:
            for name, own, keys, counts in zip(*batch.columns, strict=True):
                if name.as_py() != part:
                    if part is not None:
                        yield ended()
                    part, mass, summary = name.as_py(), 0, None
                if own.is_valid:
                    mass += own.as_py()
                    continue
                summary = summary or Summary(MARGIN * mass // least + 1)
                summary.add(np.frombuffer(keys.as_buffer(), np.uint32), np.frombuffer(counts.as_buffer(), np.uint32))
        if part is not None:
            yield ended()

    counted = docs.mapInArrow(count, "part int, mass long, keys binary, counts binary")
    sorted_parts = counted.repartition("part").sortWithinPartitions("part", F.col("mass").isNull())
    for row in sorted_parts.mapInArrow(merge, "part int, marks binary").collect():
        found.put(row["part"], row["marks"])
    return found


_NAMES = ["part", "mass", "keys", "counts"]


def phrase_counts(docs: DataFrame, found: Filter, longest: int) -> DataFrame:
    """Second pass: ``lang, phrase, size, f`` of all n-grams in the filter, counted by their words.

    A chunk numbers its n-grams by the number of the n-gram without its last word and that word, so equal
    numbers are equal words. One row with a null phrase has the number of words of the language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def count(batches):
        marks = shared.value
        for chunk, known in _chunks(batches, longest):
            phrases, sizes, counts = [None], [0], [chunk.n]
            names = np.full(len(chunk.words), -1, np.int64)  # of the n-gram that starts here, where it passes
            names[chunk.places[0]] = 0
            for k in range(longest):
                places = chunk.places[k]
                at = places[(names[places] >= 0) & marks.passing(chunk.keys[k])]
                codes, first, name, times = np.unique(
                    names[at] << 32 | chunk.numbers[at + k], return_index=True, return_inverse=True, return_counts=True
                )
                names = np.full(len(chunk.words), -1, np.int64)
                names[at] = name
                phrases += [b" ".join(chunk.words[p : p + k + 1]) for p in at[first].tolist()]
                sizes += repeat(k + 1, len(codes))
                counts += times.tolist()
            for a in range(0, len(phrases), 1 << 16):
                own = slice(a, a + (1 << 16))
                text = pa.array(phrases[own], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk.lang] * len(text)), text, pa.array(sizes[own], pa.int32()), pa.array(counts[own], pa.int64())],
                    ["lang", "phrase", "size", "f"],
                )

    counted = docs.mapInArrow(count, "lang string, phrase string, size int, f long")
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, phrase, size, f``: phrases of up to ``longest`` words that occur ``least`` times or more, and each language's words under a null phrase."""
    rows = _texts(docs, text, lang)
    return phrase_counts(rows, survivors(rows, least, longest), longest).where(F.col("phrase").isNull() | (F.col("f") >= least))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, within: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two to ``longest`` words.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends, and into words at spaces and
    tabs. A phrase that occurs ``a >= least`` times scores ``floor(2000000 * a / (l + r))`` at the cut into
    two parts, occurring ``l`` and ``r`` times, that gives least; of equal ones the first. A phrase goes if a
    longer one that holds it occurs at least ``within`` percent as often. ``n`` is the language's words.

    Null texts are empty and null languages ``und``; repeated rows count each time; tables without a frequent
    phrase give no row. Other columns of ``docs`` are not looked at.
    """
    known = stored(frequent_phrases(docs, least, longest, text, lang), "phrases")
    words = known.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    found = known.where(F.col("phrase").isNotNull())
    phrases = found.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    part = lambda of, name: found.select("lang", F.col("phrase").alias(of), F.col("f").alias(name))
    pieces = F.split("phrase", " ")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(pieces, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(pieces, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    # frequent phrases have frequent parts, so the joins lose nothing; div is exact, on decimals of 38 digits
    scored = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).withColumn(
        "score", F.expr("cast((cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r) as bigint)")
    )
    least_cut = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    # a longer phrase that holds this one holds one that is a word longer, and occurs no more often than that
    holder = phrases.where("size > 2").select(
        "lang", "a",
        F.explode(F.array(*[F.array_join(F.slice(pieces, F.lit(b), F.col("size") - 1), " ") for b in (1, 2)])).alias("phrase"),
    )
    most = holder.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    fewer = F.expr(f"held is not null and 100 * cast(held as decimal(20, 0)) >= {int(within)} * cast(a as decimal(20, 0))")
    left = least_cut.join(most, ["lang", "phrase"], "left").where(~fewer).select("lang", "phrase", "a", "at.l", "at.r", "at.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    first = left.withColumn("_group", group).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))).where(F.col("_place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB: all n-grams spelled out and counted.
ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), spans AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size
), f AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f FROM spans GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT * FROM f WHERE f >= 30),
cuts AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM frequent WHERE size > 1
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ')
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scored
), longer AS (
  SELECT lang, f, string_split(phrase, ' ') AS w, size, unnest(range(2, size)) AS part FROM frequent WHERE size > 2
), inside AS (
  SELECT lang, f, array_to_string(w[b : b + part - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS b FROM longer)
), held AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE b.cut = 1 AND (h.f IS NULL OR 100 * h.f < 80 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""
