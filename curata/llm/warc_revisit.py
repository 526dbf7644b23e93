"""Resolving WARC revisits of unmodified pages (operator 4).

A revisit record (HTTP 304) stores no payload: it refers to what an earlier
request of the same URL brought. Every revisit is joined as-of, by canonical
URL, to the latest full response before it; its validators are checked
against that response's, and the headers that a 304 may renew are merged over
the stored ones.

The as-of join is a union and "last response so far" windows. One URL may
hold a third of all records, so a URL's records are windowed in spans of time
(``span_seconds``), not together: inside a span the window runs over its
records only; a second window over one row per (URL, span) carries the last
response into the spans after it. Payloads don't take part: records carry
their digest and length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_SECONDS = 86_400

#: Header fields of a 304 that update a stored response (RFC 9110, section 15.4.5, and RFC 9111, section 3.2); fixed values.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "vary"]
#: Query parameters that only track where a visitor came from.
TRACKING = r"^(?:utm_[a-z]+|ref|fbclid|gclid)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Scheme dropped, host in lower case without ``www.`` and default port, no fragment or tracking parameters, sorted query, no slash at the path's end.

    Null stays null; text without ``://`` is kept as it is.
    """
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1)), r":(?:80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING)))
    asked = F.array_join(kept, "&")
    full = F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))
    return F.when(url.contains("://"), full).otherwise(url)


def weak(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, r"^W/", "")


def merged_headers(stored: Column, renewed: Column, permitted: list[str] = PERMITTED) -> Column:
    """``stored`` (map, lower-case names) with the permitted fields of ``renewed`` put over it; null maps count as empty."""
    empty = F.create_map().cast("map<string,string>")
    stored, renewed = F.coalesce(stored, empty), F.coalesce(renewed, empty)
    new = F.map_filter(renewed, lambda k, v: k.isin(permitted) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def resolve(records: DataFrame, span_seconds: int = SPAN_SECONDS, permitted: list[str] = PERMITTED) -> DataFrame:
    """Every revisit with what it stands for.

    ``records``: record_id, url, at (timestamp), status (int; 200 is a full
    response, 304 a revisit, others are left out), headers (map, lower-case
    names), payload_digest, payload_length. Returns one row per revisit row:
    record_id, canonical, at, verdict, response_id, headers, payload_digest,
    payload_length. Verdicts:

    * ``resolved``: the revisit's etag (weakly compared) or else its
      last-modified equals the response's; headers are merged;
    * ``mismatch``: it doesn't, or the response has no such validator;
      ``response_id`` says which response was looked at;
    * ``unvalidated``: the revisit has neither validator;
    * ``no response``: there is no earlier response of that URL (or the
      revisit's URL or time is null).

    "Earlier" is by time; records of one moment are ordered responses first,
    then by id. Only ``resolved`` rows have a payload. Repeated rows give
    repeated rows; other columns are ignored.
    """
    full = F.when(F.col("status") == 200, F.struct("record_id", "headers", "payload_digest", "payload_length"))
    r = records.where(F.col("status").isin(200, 304)).select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "at", "status", "headers", full.alias("full"),
        F.floor(F.unix_micros("at") / (span_seconds * 1_000_000)).alias("span"))
    r = r.where("status = 304 or (canonical is not null and at is not null)")
    inside = Window.partitionBy("canonical", "span").orderBy("at", "status", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("found", F.last("full", ignorenulls=True).over(inside))
    # the last response of every (URL, span), carried into later spans that begin with revisits
    order = F.struct("at", "record_id")
    spans = r.where("canonical is not null and at is not null").groupBy("canonical", "span").agg(
        F.max_by("full", F.when(F.col("status") == 200, order)).alias("last"))
    before = Window.partitionBy("canonical").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(F.col("canonical").alias("c"), F.col("span").alias("s"), F.last("last", ignorenulls=True).over(before).alias("carried"))
    revisits = r.where("status = 304")
    known = revisits.where("found is not null or canonical is null or at is null").withColumn("hit", F.when(F.expr("canonical is not null and at is not null"), F.col("found")))
    open_ = revisits.where("found is null and canonical is not null and at is not null")
    late = open_.join(carried, (F.col("canonical") == F.col("c")) & (F.col("span") == F.col("s")), "left").withColumn("hit", F.col("carried")).drop("c", "s", "carried")
    j = known.unionByName(late)
    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    theirs = F.col("hit.headers")
    same = F.when(etag.isNotNull(), weak(etag) == weak(theirs["etag"])).otherwise(modified == theirs["last-modified"])
    verdict = (F.when(F.col("hit").isNull(), "no response").when(etag.isNull() & modified.isNull(), "unvalidated")
               .when(F.coalesce(same, F.lit(False)), "resolved").otherwise("mismatch"))
    j = j.withColumn("verdict", verdict)
    ok = F.col("verdict") == "resolved"
    return j.select("record_id", "canonical", "at", "verdict", F.col("hit.record_id").alias("response_id"),
                    F.when(ok, merged_headers(F.col("hit.headers"), F.col("headers"), permitted)).otherwise(F.col("headers")).alias("headers"),
                    F.when(ok, F.col("hit.payload_digest")).alias("payload_digest"), F.when(ok, F.col("hit.payload_length")).alias("payload_length"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """WARC-like records derived from ``pages``, for the registered query.

    Every page gives a full response, a revisit a day and a bit later, and,
    by the page's number, a revisit with an outdated tag, one before any
    response, and one that only tells last-modified.
    """
    n = F.col("page_id")
    hour = lambda h: F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(n, F.lit(500)) * 3600 + h * 3600)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    modified = F.concat(F.lit("day "), F.pmod(n, F.lit(365)).cast("string"))
    none = F.lit(None).cast("string")

    def record(k, status, at, etag, last, more):
        pairs = [(F.lit(a), b) for a, b in (("etag", etag), ("last-modified", last), *more) if b is not None]
        every = F.map_from_arrays(F.array(*[a for a, _ in pairs]), F.array(*[b for _, b in pairs]))
        return F.struct((n * 8 + k).alias("record_id"), F.lit(status).alias("status"), at.alias("at"),
                        F.map_filter(every, lambda _, v: v.isNotNull()).alias("headers"),
                        (F.sha2(F.coalesce("html", F.lit("")), 256) if status == 200 else none).alias("payload_digest"),
                        (F.length(F.coalesce("html", F.lit(""))).cast("long") if status == 200 else F.lit(None).cast("long")).alias("payload_length"))

    text = F.lit
    records = F.array(
        record(0, 200, hour(F.lit(0)), tag, modified, [("content-type", text("text/html")), ("content-length", F.length(F.coalesce("html", F.lit(""))).cast("string")),
                                                     ("cache-control", text("max-age=60"))]),
        record(1, 304, hour(F.lit(30)), F.concat(F.lit("W/"), tag), modified, [("cache-control", text("max-age=3600")), ("content-length", text("0"))]),
        F.when(n % 5 == 0, record(2, 304, hour(F.lit(31)), text('"old"'), modified, [("date", text("later"))])),
        F.when(n % 7 == 0, record(3, 304, hour(F.lit(-900)), tag, none, [("date", text("before"))])),
        F.when(n % 3 == 0, record(4, 304, hour(F.lit(200)), none, modified, [("expires", text("soon"))])),
        F.when(n % 11 == 0, record(5, 304, hour(F.lit(1)), none, none, [("date", text("bare"))])))
    r = pages.select("url", F.explode(F.filter(records, lambda x: x.isNotNull())).alias("r"))
    return r.select("r.record_id", "url", "r.at", "r.status", "r.headers", "r.payload_digest", "r.payload_length")
