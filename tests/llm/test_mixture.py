"""Targets against the plain process (cap, reshare the excess, repeat) and the cut against a loop."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from curata.llm.mixture import mix, targets


def process(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, money = {}, set(order), share * sum(sizes.values())
    while open_:
        rate = money / sum(w[s] for s in open_)
        over = {s for s in open_ if rate * w[s] > most * sizes[s] + 1e-12}
        if not over:
            return {**out, **{s: rate * w[s] for s in open_}}
        for s in over:
            out[s] = most * sizes[s]
            money -= out[s]
        open_ -= over
    return out


def made():
    r = random.Random(1)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", "é", "Z", None]), " ".join(["w"] * r.randint(0, 40))) for i in range(400)]
    rows += [(None, "a", "x y"), (None, "a", "x y z"), (7, "a", "x"), (7, "a", "x"), (900, "b", None), (901, "empty", " \n"), (902, "c", "long " * 30000)]
    return rows


CLASH = ["_key", "key", "row", "of", "id", "range", "before", "offset", "s", "r", "a b.c"]


@pytest.mark.parametrize("range_rows", [10_000, 20])
def test_mix(spark, range_rows):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    docs = docs.select("*", *[F.lit(c).alias(c) for c in CLASH])
    got = mix(docs, range_rows=range_rows).collect()
    assert all(r[c] == c for r in got for c in CLASH)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = process(sizes)
    taken = {}
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target) and 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(want[s] + 1e-9) for s in sizes}
    # one document of a source is cut at most; all others are taken a whole number of times, in key order
    by = {}
    for r in got:
        text = hashlib.md5((r.text or "").encode()).hexdigest()
        key = hashlib.md5(f"mix-1:{'' if r.doc_id is None else r.doc_id}:{text}".encode()).hexdigest()
        by.setdefault(r.source, []).append((key, -1 if r.doc_id is None else r.doc_id, r.size, r.taken))
    for s, x in by.items():
        times = [t / n for _, _, n, t in sorted(x, key=lambda v: (*v[:3], -v[3])) if n]
        assert times == sorted(times, reverse=True) and sum(t != int(t) for t in times) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mix(docs, range_rows=range_rows).collect()))


def test_targets_many_sources(spark):
    r = random.Random(2)
    sizes = {f"s{i}": r.choice([0, 1, 10, 1000, 100000]) for i in range(60)}
    got = {x.source: x.target for x in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = process(sizes)
    assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes)


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
