"""Not-modified revisits of a web archive, resolved against earlier captures.

A revisit takes the latest earlier full response of its canonical URL, if their validators agree, and the
headers that such an answer may change. The as-of join runs over ranges of (URL, time) rather than over URLs,
so that a URL with a third of all captures is spread: within a range the last response is carried forward,
and the first rows of a range take the last response of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.session import materialize

#: Header fields that a not-modified answer does not change.
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without default port, fragment or tracking parameters; root path added.

    Values that are no http URL stay as they are; null stays null.
    """
    whole = F.regexp_extract(url, r"^\s*([A-Za-z]+)://([^/?#\s]+)([^?#]*)(\?[^#]*)?", 0)
    part = [F.regexp_extract(url, r"^\s*([A-Za-z]+)://([^/?#\s]+)([^?#]*)(\?[^#]*)?", k) for k in (1, 2, 3, 4)]
    scheme, host = F.lower(part[0]), F.lower(part[1])
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(part[2] == "", "/").otherwise(part[2])
    query = F.regexp_replace(F.regexp_replace(F.regexp_replace(part[3], r"(?<=[?&])utm_[a-z]+=[^&]*&?", ""), r"&$", ""), r"^\?$", "")
    return F.when((whole != "") & scheme.isin("http", "https"), F.concat(scheme, F.lit("://"), host, path, query)).otherwise(url)


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Each not-modified capture with what it stands for.

    ``captures``: ``record_id, url, ts, status, headers`` (a map with field names in lower case). Full responses
    have status 200, revisits 304; others are left out. Earlier means a smaller ``ts``; of responses at one
    time the one with the largest ``record_id`` is latest. Entity tags are compared weakly; without one on both
    sides ``last-modified`` is. Result: ``record_id, url_key, resolved_id, verdict, merged`` with a verdict of
    ``resolved``, ``changed`` (validators differ), ``unvalidated`` (none to compare) or ``missing`` (no earlier
    response, or a null URL or time). Repeated rows stay rows of their own.
    """
    rows = captures.where(F.col("status").isin(200, 304)).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").alias("at"), (F.col("status") == 200).alias("full"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers")
    )
    # revisits sort before responses of their own time, so that they see earlier ones only
    placed = rows.repartitionByRange("url_key", "at", "full", "record_id").withColumn("part", F.spark_partition_id())
    placed = materialize(placed)
    # a response without a time is earlier than none
    response = F.when(F.col("full") & F.col("at").isNotNull() & F.col("url_key").isNotNull(), F.struct("at", "record_id", "headers"))
    ends = placed.withColumn("r", response).where("r IS NOT NULL").groupBy("url_key", "part").agg(F.max_by("r", F.struct("at", "record_id")).alias("end"))
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a URL has a row here per range it spans; ranges without a response of it need one too
    spans = placed.groupBy("url_key", "part").agg(F.count("*").alias("n")).join(ends, ["url_key", "part"], "left")
    carried = spans.select("url_key", "part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("url_key", "part").orderBy("at", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    last = placed.withColumn("own", F.last(response, ignorenulls=True).over(within)).where(~F.col("full"))
    found = last.join(carried, ["url_key", "part"], "left").withColumn("base", F.when(F.col("at").isNotNull() & F.col("url_key").isNotNull(), F.coalesce("own", "carried")))
    tag = lambda h: F.regexp_replace(F.try_element_at(h, F.lit("etag")), "^W/", "")
    modified = lambda h: F.try_element_at(h, F.lit("last-modified"))
    mine, theirs = F.col("headers"), F.col("base")["headers"]
    agrees = F.coalesce(tag(mine) == tag(theirs), modified(mine) == modified(theirs))
    verdict = F.when(F.col("base").isNull(), "missing").when(agrees, "resolved").when(~agrees, "changed").otherwise("unvalidated")
    may = F.map_filter(mine, lambda k, v: ~k.isin(*KEPT_FIELDS))
    kept = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(may, k))
    return found.select(
        "record_id", "url_key", F.when(verdict == "resolved", F.col("base")["record_id"]).alias("resolved_id"), verdict.alias("verdict"),
        F.when(verdict == "resolved", F.map_concat(kept, may)).alias("merged"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Archive records made from the pages table: a full response per page, and two later not-modified visits.

    Every third page's second visit carries another entity tag, every fifth page has no validator, every
    seventh page's response comes after its visits.
    """
    n = F.col("page_id")
    tag = F.md5(F.coalesce("html", F.lit("")))
    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    at = F.when(n % 7 == 0, n * 10 + 100).otherwise(n * 10)
    has = n % 5 != 0

    def fields(tagged, *more):
        return F.map_filter(F.create_map(F.lit("etag"), F.when(has, tagged), *more), lambda k, v: v.isNotNull())

    visit = F.concat_ws("", "url", F.when(n % 2 == 0, F.lit("")))
    return pages.select(
        F.explode(
            F.array(
                F.struct((n * 3).alias("record_id"), F.col("url").alias("url"), at.alias("ts"), F.lit(200).alias("status"), fields(tag, F.lit("content-length"), size, F.lit("date"), at.cast("string")).alias("headers")),
                F.struct((n * 3 + 1).alias("record_id"), visit.alias("url"), (n * 10 + 20).alias("ts"), F.lit(304).alias("status"), fields(F.concat(F.lit("W/"), tag), F.lit("date"), (n * 10 + 20).cast("string"), F.lit("content-length"), F.lit("0")).alias("headers")),
                F.struct((n * 3 + 2).alias("record_id"), F.regexp_replace("url", "#.*$", "").alias("url"), (n * 10 + 50).alias("ts"), F.lit(304).alias("status"), fields(F.when(n % 3 == 0, F.md5(tag)).otherwise(tag), F.lit("x-cache"), F.lit("hit")).alias("headers")),
            )
        ).alias("r")
    ).select("r.*")


def resolved_pages(pages: DataFrame) -> DataFrame:
    """``resolve_revisits`` of ``captures_of`` with the merged headers as text in order of their names."""
    text = F.array_join(F.transform(F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return resolve_revisits(captures_of(pages)).select("record_id", "url_key", "resolved_id", "verdict", text.alias("merged"))


ORACLE = r"""
WITH p AS (
    SELECT page_id AS n, url, md5(coalesce(html, '')) AS tag, CAST(length(coalesce(html, '')) AS VARCHAR) AS size,
           CASE WHEN page_id % 7 = 0 THEN page_id * 10 + 100 ELSE page_id * 10 END AS ts, page_id % 5 <> 0 AS has FROM pages),
canon AS (
    SELECT *, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1)) AS host,
           regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '(\?[^#]*)', 1) AS query FROM p),
keyed AS (
    SELECT *, scheme || '://' || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') ELSE regexp_replace(host, ':443$', '') END
           || CASE path WHEN '' THEN '/' ELSE path END
           || regexp_replace(regexp_replace(regexp_replace(query, '([?&])utm_[a-z]+=[^&]*&?', '\1', 'g'), '&$', ''), '^\?$', '') AS url_key FROM canon),
full_ AS (
    SELECT n * 3 AS record_id, url_key, ts, CASE WHEN has THEN tag END AS tag, size FROM keyed),
visits AS (
    SELECT n * 3 + 1 AS record_id, url_key, n * 10 + 20 AS ts, CASE WHEN has THEN tag END AS tag, 'W/' || tag AS shown, CAST(n * 10 + 20 AS VARCHAR) AS seen, 1 AS kind FROM keyed
    UNION ALL
    SELECT n * 3 + 2, url_key, n * 10 + 50, CASE WHEN has THEN CASE WHEN n % 3 = 0 THEN md5(tag) ELSE tag END END,
           CASE WHEN n % 3 = 0 THEN md5(tag) ELSE tag END, NULL, 2 FROM keyed),
ranked AS (
    SELECT v.*, f.record_id AS base_id, f.tag AS base_tag, f.size, f.ts AS base_ts,
           row_number() OVER (PARTITION BY v.record_id ORDER BY f.ts DESC, f.record_id DESC) AS rank_
    FROM visits v LEFT JOIN full_ f ON f.url_key = v.url_key AND f.ts < v.ts)
SELECT record_id, url_key, CASE WHEN tag = base_tag THEN base_id END AS resolved_id,
       CASE WHEN base_id IS NULL THEN 'missing' WHEN tag = base_tag THEN 'resolved' WHEN tag <> base_tag THEN 'changed' ELSE 'unvalidated' END AS verdict,
       CASE WHEN tag = base_tag THEN 'content-length=' || size || ';date=' || CASE kind WHEN 1 THEN seen ELSE CAST(base_ts AS VARCHAR) END
            || ';etag=' || shown || CASE kind WHEN 2 THEN ';x-cache=hit' ELSE '' END END AS merged
FROM ranked WHERE rank_ = 1
"""
