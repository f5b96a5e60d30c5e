"""WARC not-modified revisits resolved to the responses they stand for.

A revisit with the server-not-modified profile holds headers only. It is joined as of its time to the latest earlier
full response with the same canonical URL; its validators are checked against that response; and the
response's headers are merged with those that a 304 may update. Bodies are never moved: a resolved revisit refers
to the record and digest that hold it.

Canonical URLs: scheme and host in lower case, http as https, no ``www.``, default port, fragment, tracking parameters or
trailing slash; other parameters sorted.

Validators: with entity tags on both sides, the tags decide (weak comparison: without ``W/``); else with modification dates on
both sides, the dates; else the revisit has no usable validator. Status: resolved, mismatch, no_validator, orphan (no earlier
response; also where URL or time is null). Only resolved revisits get refers_to, digest and headers.

Responses and revisits at the same time are in order of their record ids. Repeated records are resolved once each;
null header maps are empty; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexrev.llm.asof import last_before

#: Seconds of a stretch of the as-of join.
STRETCH = 6 * 3600
#: Headers that a 304 response updates.
UPDATED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[a-z]*|gclid|fbclid|ref)="


def canonical_url(url: Column) -> Column:
    parts = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(parts, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(parts, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(parts, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(parts, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.concat_ws("&", kept))).otherwise("")
    return F.when(host != "", F.concat(F.when(scheme == "http", "https").otherwise(scheme), F.lit("://"), host, path, tail))


def resolve_revisits(records: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Resolve the revisits among ``records(record_id long, url, time long, kind, digest, headers map)``.

    ``kind`` is response or revisit; header names are in lower case. Returns one row per revisit: record_id, canonical_url, time,
    status, refers_to, digest, headers.
    """
    none = F.create_map().cast("map<string,string>")
    slim = records.select("record_id", "time", "kind", "digest", F.coalesce("headers", none).alias("headers"),
                          canonical_url(F.col("url")).alias("canonical_url"))
    full = F.when(F.col("kind") == "response", F.struct("record_id", "digest", "headers"))
    joined = last_before(slim, "canonical_url", "time", "record_id", full, stretch, "response").where("kind = 'revisit'")

    def tag(h: str) -> Column:
        return F.regexp_replace(F.col(h)["etag"], "^W/", "")

    by_tag = tag("headers") == tag("response.headers")
    by_date = F.col("headers")["last-modified"] == F.col("response.headers")["last-modified"]
    match = F.coalesce(by_tag, by_date)
    status = (F.when(F.col("response").isNull(), "orphan").when(match.isNull(), "no_validator")
              .when(match, "resolved").otherwise("mismatch"))
    permitted = F.map_filter("headers", lambda k, v: k.isin(*UPDATED) & v.isNotNull())
    kept = F.map_filter(F.col("response.headers"), lambda k, _: ~F.array_contains(F.map_keys(permitted), k))
    ok = F.col("status") == "resolved"
    return joined.withColumn("status", status).select(
        "record_id", "canonical_url", "time", "status", F.when(ok, F.col("response.record_id")).alias("refers_to"),
        F.when(ok, F.col("response.digest")).alias("digest"), F.when(ok, F.map_concat(kept, permitted)).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl derived from ``pages(page_id, url, html)``: each page as a response and a revisit.

    Pages are captured a minute apart and asked for again a day later, except that every sixth revisit comes before its page. The
    revisit carries the page's entity tag, its weak form, its date, a stale tag or nothing, by turns.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    turn = F.pmod("page_id", F.lit(6))
    at = F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    modified = (F.col("time0") - F.pmod("page_id", F.lit(5)) * 3600).cast("string")
    base = pages.select("page_id", "url", digest.alias("digest"), at.alias("time0"), turn.alias("turn"))
    response = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("time0").alias("time"), F.lit("response").alias("kind"), "digest",
        F.map_from_arrays(F.array(*map(F.lit, ("content-type", "etag", "last-modified", "date", "server"))),
                          F.array(F.lit("text/html"), tag, modified, F.col("time0").cast("string"), F.lit("origin"))).alias("headers"))
    later = F.when(F.col("turn") == 5, F.col("time0") - 1).otherwise(F.col("time0") + 86_400)
    revisit = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", later.alias("time"), F.lit("revisit").alias("kind"),
        F.lit(None).cast("string").alias("digest"),
        F.map_filter(F.map_from_arrays(
            F.array(*map(F.lit, ("etag", "last-modified", "date", "expires", "content-length", "server"))),
            F.array(F.when(F.col("turn").isin(0, 5), tag).when(F.col("turn") == 1, F.concat(F.lit("W/"), tag)).when(F.col("turn") == 3, F.lit('"stale"')),
                    F.when(F.col("turn") == 2, modified), later.cast("string"), (later + 600).cast("string"), F.lit("0"), F.lit("cache"))),
            lambda _, v: v.isNotNull()).alias("headers"))
    return response.unionByName(revisit)
