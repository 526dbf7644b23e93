"""Revisits against a loop over each URL's records in time order."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from curata.llm import warc_revisit as W

SCHEMA = "record_id long, url string, at timestamp, status int, headers map<string,string>, payload_digest string, payload_length long"


def brute(rows):
    out = []
    for rid, url, at, status, headers, _, _ in rows:
        if status != 304:
            continue
        before = [x for x in rows if x[3] == 200 and url is not None and at is not None and x[1] == url and x[2] is not None
                  and (x[2], 200, x[0]) < (at, 304, rid if rid is not None else -1)]
        hit = max(before, key=lambda x: (x[2], x[0]), default=None)
        own = headers or {}
        if hit is None:
            out.append((rid, "no response", None, headers, None))
        elif not own.get("etag") and not own.get("last-modified"):
            out.append((rid, "unvalidated", hit[0], headers, None))
        else:
            theirs = hit[4] or {}
            strip = lambda t: t and t.removeprefix("W/")
            same = strip(own["etag"]) == strip(theirs.get("etag")) if own.get("etag") else own["last-modified"] == theirs.get("last-modified")
            if same:
                merged = {**theirs, **{k: v for k, v in own.items() if k in W.PERMITTED}}
                out.append((rid, "resolved", hit[0], merged, hit[5]))
            else:
                out.append((rid, "mismatch", hit[0], headers, None))
    return out


def made(n=400):
    r = random.Random(6)
    base = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(n):
        url = r.choice(["hot.com"] * 6 + ["a.org/x", "b.org", "c.org/y?p=1", None])
        at = base + timedelta(hours=r.randint(0, 400)) if r.random() > 0.03 else None
        tags = r.choice([{"etag": '"1"'}, {"etag": 'W/"1"'}, {"etag": '"2"'}, {"last-modified": "m"}, {}, {"etag": '"1"', "last-modified": "m"}, None])
        status = r.choice([200, 304, 304, 404])
        headers = None if tags is None else {**tags, "content-length": str(i), "date": f"d{i}"}
        rows.append((i, url, at, status, headers, f"p{i}" if status == 200 else None, i if status == 200 else None))
    return rows


@pytest.mark.parametrize("span", [86_400, 3600, 10**9])
def test_matches_loop(spark, span):
    rows = made()
    rows.append(rows[[x[3] for x in rows].index(304)])
    df = spark.createDataFrame(rows, SCHEMA).withColumn("found", F.lit(1)).withColumn("span", F.lit("clash"))
    got = [(r.record_id, r.verdict, r.response_id, r.headers, r.payload_digest) for r in W.resolve(df, span_seconds=span).collect()]
    assert sorted(map(str, [(a, b, c, d and sorted(d.items()), e) for a, b, c, d, e in got])) == \
        sorted(map(str, [(a, b, c, d and sorted(d.items()), e) for a, b, c, d, e in brute(rows)]))


def test_canonical_url(spark):
    urls = {"HTTP://WWW.A.com:80/X/?b=2&utm_source=q&a=1#f": "a.com/X?a=1&b=2", "https://a.com": "a.com", "https://a.com/?ref=x": "a.com", "plain": "plain",
            "https://m.a.com/p.html?": "m.a.com/p.html", "https://a.com/?referrer=x": "a.com?referrer=x", "": ""}
    df = spark.createDataFrame([(u,) for u in [*urls, None]], "u string")
    got = {r.u: r.c for r in df.select("u", W.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == {**urls, None: None}


def test_empty(spark):
    assert W.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
