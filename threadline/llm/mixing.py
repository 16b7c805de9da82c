"""Sources mixed to target weights, by thresholds on a hash of each document.

Targets come from weights, a share of all words and a limit of repeats. A source takes its documents whole
times, and once more those whose hash lies below a threshold, so that a larger budget takes what a smaller one
takes and more. The threshold comes from histograms: words by source and hash bucket, the bucket in which the
budget ends, and again by the next bits of the hash within that bucket alone. Documents are never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.llm.frames import stored
from threadline.operators.versions import number_sorted_rows
from threadline.session import stack

#: Bits of a document's hash, and those of them that a histogram resolves.
HASH_BITS, LEVEL_BITS = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def _big(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("decimal(38,0)")


def words(text: str) -> Column:
    """Number of words of a text; of a null text none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def place(key: str, text: str) -> Column:
    """Where a document lies among all: 60 bits of the MD5 of its id and text."""
    content = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(content), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] | DataFrame = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2) -> DataFrame:
    """``source, source_size, weight, level, per, closed`` of a table of ``source, source_size``.

    All targets together are ``share`` of all sizes, dealt out by weight; none exceeds ``most`` times its
    source, and what would is dealt to the others. A source that is not ``closed`` gets ``weight * level / per``,
    a closed one ``most`` times its size. Weights are a table of ``source, weight`` (0 where a source is not in
    it), or repeat over the sources by code point, null last. Only sums reach the driver, one pair a round.
    """
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("long").alias("weight"))
        weighed = sources.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn("weight", F.coalesce("weight", F.lit(0)))
    else:
        numbered = number_sorted_rows(sources.orderBy(F.col("source").asc_nulls_last()), "_position")
        cycle = F.array(*[F.lit(int(w)) for w in weights])
        weighed = numbered.withColumn("weight", F.get(cycle, ((F.col("_position") - 1) % len(weights)).cast("int")).cast("long")).drop("_position")
    weighed = stored(weighed, "sources")
    cap = _big(F.col("source_size")) * most
    total = int(weighed.agg(F.sum(_big(F.col("source_size")))).first()[0] or 0)
    level, per = share.numerator * total, 0
    closed = F.lit(False)
    while True:
        over = weighed.select("*", closed.alias("_closed")).agg(
            F.sum(F.when(F.col("_closed"), cap)).alias("full"), F.sum(F.when(~F.col("_closed"), _big(F.col("weight")))).alias("weights")
        ).first()
        now = (share.numerator * total - share.denominator * int(over["full"] or 0), share.denominator * int(over["weights"] or 0))
        if now == (level, per) or now[1] == 0:
            return weighed.select("source", "source_size", "weight", _big(level).alias("level"), _big(max(per, 1)).alias("per"), closed.alias("closed"))
        level, per = now
        closed = cap * _big(per) < _big(F.col("weight")) * _big(level)


def thresholds(sized: DataFrame, aims: DataFrame, most: int = 2) -> DataFrame:
    """``aims`` with ``target, whole`` (times that every document is taken) and ``edge, before, many, budget``.

    Documents of the source below ``edge`` are taken once more; ``before`` is their sizes' sum, ``many`` the
    number of rows at the edge. ``sized`` has ``source, size, place``. Each round reads the rows of the boundary
    buckets alone and ends in a table with one row per source.
    """
    share = _big(F.col("weight")) * F.col("level")
    asked = F.when(F.col("closed"), F.lit(0).cast("decimal(38,0)")).otherwise(share - F.col("whole") * _big(F.col("source_size")) * F.col("per"))
    state = aims.withColumn(
        "whole", F.when(F.col("source_size") == 0, 0).when(F.col("closed"), most).otherwise(F.floor(share / (_big(F.nullif("source_size", F.lit(0))) * F.col("per")))).cast("long")
    )
    # the quotient of decimals is rounded, so the whole part is set right by exact products
    size_per = _big(F.col("source_size")) * F.col("per")
    state = state.withColumn("whole", F.col("whole") - F.when(~F.col("closed") & (F.col("whole") * size_per > share), 1).otherwise(0))
    state = state.withColumn("whole", F.col("whole") + F.when(~F.col("closed") & (F.col("source_size") > 0) & ((F.col("whole") + 1) * size_per <= share), 1).otherwise(0))
    target = F.when(F.col("closed"), (F.col("source_size") * most).cast("double")).otherwise(share.cast("double") / F.col("per").cast("double"))
    state = state.withColumn("target", target).withColumn("budget", _big(asked))
    nothing = {"_bucket": 0, "before": 0, "_low": -1, "_high": -1, "many": 0}
    state = stored(state.withColumns({c: F.lit(v).cast("long") for c, v in nothing.items()}), "aims")
    kept = [c for c in state.columns if c not in nothing]
    asking = state.where("budget > 0").withColumns({"_low": F.lit(0).cast("long"), "_high": F.lit(1).cast("long")})
    settled = state.where("budget <= 0")
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        mine = asking.withColumnRenamed("source", "_source")
        inside = F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("place", bits + LEVEL_BITS) == F.col("_bucket"))
        buckets = (
            sized.join(mine.select("_source", "_bucket"), inside)
            .groupBy("_source", F.shiftright("place", bits).alias("_next"))
            .agg(F.sum("size").alias("_sum"), F.min("place").alias("_first"), F.max("place").alias("_last"), F.count("*").alias("_rows"))
        )
        along = Window.partitionBy("_source").orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = mine.select(*[c for c in mine.columns if c not in ("_low", "_high", "many")]).withColumnRenamed("_source", "source").join(
            buckets.withColumn("_upto", F.sum("_sum").over(along)), F.col("source").eqNullSafe(F.col("_source"))
        )
        crossed = running.withColumn("_upto", F.col("before") + F.col("_upto")).where(_big(F.col("_upto")) * F.col("per") > F.col("budget"))
        ended = crossed.groupBy("source").agg(F.min_by(F.struct(*kept[1:], "_next", "_upto", "_sum", "_first", "_last", "_rows"), "_next").alias("_at"))
        found = ended.select(
            "source", *[F.col(f"_at.{c}") for c in kept[1:]], F.col("_at._next").alias("_bucket"), (F.col("_at._upto") - F.col("_at._sum")).alias("before"),
            F.col("_at._first").alias("_low"), F.col("_at._last").alias("_high"), F.col("_at._rows").alias("many"),
        )
        found = stored(found, "boundaries")
        settled = stack(settled, found.where("_low = _high" if bits else "true"))
        asking = found.where("_low < _high")
        if bits == 0 or asking.isEmpty():
            break
    return settled.withColumn("edge", F.col("_low")).drop("_bucket", "_low", "_high")


def _decided(rows: DataFrame, aims: DataFrame, source: str, size: str, spot: str) -> DataFrame:
    """``rows`` with ``source_size, target, copies``; rows at an edge that many share are numbered."""
    aims = stored(aims.withColumnRenamed("source", "_source"), "thresholds")
    met = rows.join(aims, F.col(source).eqNullSafe(F.col("_source")))
    at_edge = (F.col(spot) == F.col("edge")) & (F.col("many") > 1)

    def more(earlier):
        """Whether the sum of what is taken comes nearer to the budget with this row, after ``earlier`` rows like it."""
        upto = 2 * (_big(F.col("before")) + _big(earlier) * F.col(size)) + F.col(size)
        return (F.col(spot) < F.col("edge")) | ((F.col(spot) == F.col("edge")) & (_big(upto) * F.col("per") < 2 * F.col("budget")))

    kept = [*rows.columns, "source_size", "target"]
    out = met.where(~at_edge).select(*kept, (F.col("whole") + more(F.lit(0)).cast("long")).alias("copies"))
    if aims.where("many > 1").isEmpty():
        return out
    tied = number_sorted_rows(met.where(at_edge).withColumn("_any", F.rand(7)).orderBy("_source", size, "_any"), "_position")
    firsts = tied.groupBy(F.col("_source").alias("_of")).agg(F.min("_position").alias("_least"))
    numbered = tied.join(firsts, F.col("_source").eqNullSafe(F.col("_of")))
    ends = numbered.select(*kept, (F.col("whole") + more(F.col("_position") - F.col("_least")).cast("long")).alias("copies"))
    return stack(out, ends)


def _edges(sized: DataFrame, weights, share, most) -> DataFrame:
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, targets(sources, weights, share, most), most)


def mix(docs: DataFrame, weights: Sequence[int] | DataFrame = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row: how often the mix takes it.

    A source's taken words are those of the prefix of its documents, in order of their hash, that comes nearest
    to its target. Null texts have size 0, a source of such alone is not taken, a null source is one of its own, null ids are like any other. Rows with
    the same id and text share a hash; where the target ends among them, so many are taken as come nearest, no
    matter which. An empty table gives no row; other columns of ``docs`` are not looked at.
    """
    sized = stored(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), words(text).alias("size"), place(key, text).alias("place")), "sizes")
    out = _decided(sized, _edges(sized, weights, share, most), "source", "size", "place")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[int] | DataFrame = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as ``mix`` takes it."""
    named = docs.select(F.struct("*").alias("_row"), F.col(source).cast("string").alias("source"), words(text).alias("size"), place(key, text).alias("place"))
    aims = _edges(stored(named.select("source", "size", "place"), "sizes"), weights, share, most)
    taken = _decided(named, aims, "source", "size", "place").where("copies > 0")
    return taken.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_time"), "_row").select("_row.*")


#: The same in DuckDB: running sums over all documents in order of their hash.
ORACLE = r"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, sum(size)::HUGEINT AS z, row_number() OVER (ORDER BY source NULLS LAST) AS position FROM sized GROUP BY source
), weighed AS (SELECT *, ([3, 1, 2])[(position - 1) % 3 + 1]::HUGEINT AS w, 2 * z AS cap FROM sources),
steps AS (
  SELECT *, row_number() OVER r AS step, (sum(z) OVER ())::HUGEINT AS total,
    coalesce(sum(cap) OVER (ORDER BY cap * (6 // w), position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS closed,
    (sum(w) OVER (ORDER BY cap * (6 // w), position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS open
  FROM weighed WINDOW r AS (ORDER BY cap * (6 // w), position)
), level AS (
  SELECT 3 * total - 2 * closed AS num, 2 * open AS den FROM steps WHERE cap * 2 * open >= (3 * total - 2 * closed) * w ORDER BY step LIMIT 1
), aims AS (
  SELECT source, z, w, num, den, cap * den < num * w AS capped FROM weighed, level
), budgets AS (
  SELECT *, CASE WHEN z = 0 THEN 0 WHEN capped THEN 2 ELSE (num * w) // (den * nullif(z, 0)) END AS whole,
    CASE WHEN capped THEN (2 * z)::DOUBLE ELSE (num * w)::DOUBLE / den::DOUBLE END AS target
  FROM aims
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before FROM sized
)
SELECT p.doc_id, p.source, p.size, b.z::BIGINT AS source_size, b.target,
  (b.whole + CASE WHEN NOT b.capped AND (2 * p.before + p.size) * b.den < 2 * (b.num * b.w - b.whole * b.z * b.den) THEN 1 ELSE 0 END)::BIGINT AS copies,
  (p.size * (b.whole + CASE WHEN NOT b.capped AND (2 * p.before + p.size) * b.den < 2 * (b.num * b.w - b.whole * b.z * b.den) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""
